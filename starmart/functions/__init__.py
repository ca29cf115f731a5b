"""Expressions shared by the operators; all of them run inside the JVM."""

from starmart.functions.dates import parsed_date
from starmart.functions.hashing import DRAW_RANGE, row_draw
from starmart.functions.numbers import (
    MONEY,
    SECONDS,
    both_parts,
    exact_total,
    split_exact,
    whole_number,
)
from starmart.functions.predicates import all_of, known, positive, present, quoted
from starmart.functions.windows import over

__all__ = [
    "DRAW_RANGE",
    "MONEY",
    "SECONDS",
    "all_of",
    "both_parts",
    "exact_total",
    "known",
    "over",
    "parsed_date",
    "positive",
    "present",
    "quoted",
    "row_draw",
    "split_exact",
    "whole_number",
]
