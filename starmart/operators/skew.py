"""Hot keys: found in one bounded count, then split by salt in every join on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import quoted

# A sketch of this many keys overestimates no count by more than a fraction of a piece.
_TRACKED, _MOST_PIECES = 8192, 512


@dataclass(frozen=True)
class HotKeys:
    """The hot values of a table's key columns and into how many pieces each is cut.

    ``spread_by`` are columns that tell the rows of one key apart. Without hot values every
    join is a plain one.
    """

    fans: Mapping[str, Mapping[object, int]] = field(default_factory=dict)
    spread_by: tuple[str, ...] = ()

    def salt(self, key: str) -> Column:
        """The piece of a row: 0 for rows of keys that are not hot."""
        piece = F.xxhash64(*[F.col(quoted(c)) for c in self.spread_by if c != key])
        return F.pmod(piece, self._fan(F.col(quoted(key)), key)).cast("int")

    def salts(self, key: str, dim_key: str) -> Column:
        """All pieces of a dimension's key, to be exploded."""
        return F.sequence(F.lit(0), (self._fan(F.col(quoted(dim_key)), key) - 1).cast("int"))

    def _fan(self, value: Column, key: str) -> Column:
        fan = F.lit(1)
        for hot, pieces in self.fans[key].items():
            fan = F.when(value == F.lit(hot), F.lit(pieces)).otherwise(fan)
        return fan

    def join(self, fact: DataFrame, dim: DataFrame, key: str, dim_key: str, how: str) -> DataFrame:
        """``fact`` joined to ``dim`` on ``key = dim_key``, hot keys in pieces.

        The dimension's rows of hot keys are copied once per piece, all others stay single. Joins
        on the same key salt alike, so the second one finds its rows where the first left them.
        """
        same = F.col(quoted(key)) == F.col(quoted(dim_key))
        if not self.fans.get(key):
            return fact.join(dim, same, how)
        copies = dim.withColumn("_salt", F.explode(self.salts(key, dim_key)))
        joined = fact.join(copies, same & (self.salt(key) == F.col("_salt")), how)
        return joined.drop("_salt")


def find_hot_keys(
    fact: DataFrame, keys: Sequence[str], spread_by: Sequence[str], pieces: int = 64
) -> HotKeys:
    """The values that hold more than one in ``pieces`` of the rows, for each of ``keys``.

    One pass over the key columns: every task keeps a frequent-items sketch of fixed size, and a
    row per task is shuffled. A value is cut into as many pieces as it holds shares of one in
    ``pieces``, so at most ``2 * pieces`` copies of dimension rows arise. Values the sketch
    overestimates are cut needlessly; results never depend on it.

    Rows whose key and ``spread_by`` columns are all equal stay together. NULL keys join nothing
    and are left where they are.
    """
    if not 1 < pieces <= _MOST_PIECES:
        raise ValueError(f"pieces must be between 2 and {_MOST_PIECES}")
    known = {f.name: f.dataType for f in fact.schema.fields}
    for key in keys:
        if not isinstance(known[key], (T.IntegralType, T.StringType, T.DateType)):
            raise TypeError(f"{key}: hot keys are whole numbers, texts or dates")
    counted = fact.agg(
        F.count("*").alias("_rows"),
        *[F.expr(f"approx_top_k({quoted(key)}, {pieces}, {_TRACKED})").alias(key) for key in keys],
    ).first()
    fans = {}
    for key in keys:
        hot = {}
        for value, rows in counted[key] or []:
            fan = -(-rows * pieces // counted["_rows"])
            if value is not None and fan > 1:
                hot[value] = fan
        fans[key] = hot
    return HotKeys(fans, tuple(spread_by))
