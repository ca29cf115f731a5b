"""Repeatable pseudo-random draws computed from a row's key; as SQL text.

Plain BIGINT arithmetic modulo a prime: a row gets the same draw on every attempt of a
task, whatever the partitioning, and any SQL engine can reproduce it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from starmart.functions.predicates import quoted

DRAW_RANGE = 2**31 - 1

# Below 2**30: products stay below 2**62.
_FOLD = 1_000_003_391
_SEED = 69_621
_STRETCH = 48271


def row_draw(keys: Sequence[str], seed: int = 0, null_digit: str = "0L") -> str:
    """A draw in ``[0, DRAW_RANGE)`` from integral key columns.

    A NULL key counts as ``null_digit``, SQL text of a whole number. Neighbouring keys are far
    apart, and seeds bend the draws rather than shift them.
    """

    def fold(hashed: str, key: str) -> str:
        digit = f"pmod(coalesce(CAST({quoted(key)} AS BIGINT), {null_digit}), {DRAW_RANGE}L)"
        return f"({hashed} * {_FOLD}L + {digit}) % {DRAW_RANGE}L"

    folded = reduce(lambda hashed, key: f"({fold(hashed, key)})", keys, "0L")
    stretched = f"({folded} * {_STRETCH}L % {DRAW_RANGE}L)"
    bend = 1 + seed * _SEED % DRAW_RANGE
    return f"{stretched} * ({stretched} + {bend}L) % {DRAW_RANGE}L"
