"""Row quality: named rules, the filter that applies them and the report that counts them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import all_of, known, parsed_date, positive, present, quoted

# Dates must be later than this day, keys are named with this part.
EARLIEST_EXCLUSIVE = "2000-01-01"
KEY_MARK = "_id"

Check = Callable[[str, T.DataType], str]


@dataclass(frozen=True)
class Rule:
    """A row passes when ``check``, SQL text for a column and its type, is true."""

    name: str
    column: str
    check: Check

    def condition(self, schema: T.StructType) -> str:
        return self.check(self.column, schema[self.column].dataType)


def _is_known(name: str, dtype: T.DataType) -> str:
    return known(name)


def _is_present(name: str, dtype: T.DataType) -> str:
    return present(name)


def _is_address(name: str, dtype: T.DataType) -> str:
    return f"{present(name)} AND contains({quoted(name)}, '@')"


def _is_recent(name: str, dtype: T.DataType) -> str:
    return f"{parsed_date(name, dtype)} > DATE '{EARLIEST_EXCLUSIVE}'"


def _rules(check: Check, suffix: str, *columns: str) -> tuple[Rule, ...]:
    return tuple(Rule(f"{column}_{suffix}", column, check) for column in columns)


TABLE_RULES: dict[str, tuple[Rule, ...]] = {
    "users": (
        *_rules(_is_present, "present", "name", "country", "address"),
        *_rules(_is_address, "valid", "email"),
        *_rules(_is_recent, "recent", "signup_date"),
    ),
    "products": (
        *_rules(positive, "positive", "price"),
        *_rules(_is_present, "present", "name", "category", "description"),
    ),
    "transactions": (
        *_rules(positive, "positive", "quantity"),
        *_rules(_is_recent, "recent", "transaction_date"),
    ),
}


def key_columns(df: DataFrame) -> list[str]:
    """Primary and foreign keys alike, found by name."""
    return [name for name in df.columns if KEY_MARK in name]


def known_keys(df: DataFrame) -> tuple[Rule, ...]:
    return _rules(_is_known, "known", *key_columns(df))


def positive_keys(df: DataFrame) -> tuple[Rule, ...]:
    return _rules(positive, "positive", *key_columns(df))


def rules_for(df: DataFrame, table: str) -> tuple[Rule, ...]:
    """The key rules, then the table's own; an unknown table has none of its own."""
    return known_keys(df) + positive_keys(df) + TABLE_RULES.get(table, ())


def _conditions(df: DataFrame, rules: str | Iterable[Rule]) -> dict[str, str]:
    if isinstance(rules, str):
        rules = rules_for(df, rules)
    schema = df.schema
    return {rule.name: rule.condition(schema) for rule in rules}


def clean(df: DataFrame, rules: str | Iterable[Rule]) -> DataFrame:
    """Rows that pass every rule, given as rules or as a table name. One filter, no shuffle."""
    return df.where(all_of(_conditions(df, rules).values()))


def clean_and_count(
    df: DataFrame, rules: str | Iterable[Rule], counts: Observation
) -> DataFrame:
    """``clean``, with what ``quality_report`` counts observed on the way; no pass of its own.

    ``counts`` holds them after the first action. Rows of a shuffle that is computed again after
    an executor was lost may count twice; the report by itself never does.
    """
    conditions = _conditions(df, rules)
    failing = [
        F.expr(f"count_if(({condition}) IS NOT TRUE)").alias(name)
        for name, condition in conditions.items()
    ]
    passing = F.expr(f"count_if({all_of(conditions.values())})").alias("rows_after")
    observed = df.observe(counts, F.count(F.lit(1)).alias("rows_before"), passing, *failing)
    return observed.where(all_of(conditions.values()))


def observed_report(spark: SparkSession, observed: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The rows of ``quality_report`` per ``table_name``, from observed counts; a row per rule.

    ``rows_written``, which is counted later (after references, say), stands beside them.
    """
    rows = []
    for table, counts in observed.items():
        before, after = counts["rows_before"], counts["rows_after"]
        totals = (before, after, before - after, counts.get("rows_written"))
        names = [n for n in counts if n not in ("rows_before", "rows_after", "rows_written")]
        rows += [(table, name, counts[name], *totals) for name in names]
    return spark.createDataFrame(
        rows,
        "table_name string, rule string, rows_failing long, rows_before long, rows_after long,"
        " rows_removed long, rows_written long",
    )


def quality_report(df: DataFrame, rules: str | Iterable[Rule]) -> DataFrame:
    """Per rule, the rows that fail it, beside the table's row counts; one pass over ``df``.

    A row that fails several rules is counted under each of them but removed once.
    """
    conditions = _conditions(df, rules)
    counters = ", ".join(
        f"named_struct('rule', '{name}', 'rows_failing', count_if(({condition}) IS NOT TRUE))"
        for name, condition in conditions.items()
    )
    counts = df.agg(
        F.count("*").alias("rows_before"),
        F.expr(f"count_if({all_of(conditions.values())})").alias("rows_after"),
        F.expr(f"array({counters})").alias("rules"),
    )
    return counts.select(
        F.inline("rules"),
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``rows`` per ``table_name``; each table is counted where it lies."""
    counts = [
        table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
