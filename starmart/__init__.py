"""Layered sales analytics on Spark: clean, relate and report on a star schema."""
