"""Declared schemas.

Nothing is inferred: inference costs a pass over the files and makes a column's type
depend on its worst value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starmart.functions import quoted


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


USERS = _table(
    user_id=T.LongType(),
    name=T.StringType(),
    email=T.StringType(),
    country=T.StringType(),
    address=T.StringType(),
    signup_date=T.DateType(),
)

PRODUCTS = _table(
    product_id=T.LongType(),
    name=T.StringType(),
    category=T.StringType(),
    description=T.StringType(),
    price=T.DoubleType(),
)

TRANSACTIONS = _table(
    transaction_id=T.LongType(),
    user_id=T.LongType(),
    product_id=T.LongType(),
    quantity=T.IntegerType(),
    transaction_date=T.DateType(),
)

# One row per timed step of a run: a table in the silver stage, a report in the gold stage.
RUNS = _table(
    experiment=T.StringType(),
    run=T.LongType(),
    stage=T.StringType(),
    item=T.StringType(),
    transform_s=T.DoubleType(),
    write_s=T.DoubleType(),
    rows=T.LongType(),
    status=T.StringType(),
    description=T.StringType(),
)

# Dimensions come before the fact that refers to them.
TABLES = {"users": USERS, "products": PRODUCTS, "transactions": TRANSACTIONS}


def with_date_as(schema: T.StructType, dtype: T.DataType) -> T.StructType:
    """The schema with every date column declared as ``dtype`` instead."""
    return T.StructType(
        [
            T.StructField(f.name, dtype if isinstance(f.dataType, T.DateType) else f.dataType)
            for f in schema.fields
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in order and with their types; a value that does not fit raises."""
    return df.selectExpr(
        *[f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) {quoted(f.name)}" for f in schema]
    )
