"""The registered queries over the supplied tables and the SQL that checks them."""
