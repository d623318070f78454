"""Predicates folded over lists of column names."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(conditions: Iterable[Column]) -> Column:
    """AND over the conditions; true when there is none."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    """OR over the conditions; false when there is none."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_present(columns: Sequence[str]) -> Column:
    return all_of(F.col(c).isNotNull() for c in columns)


def any_missing(columns: Sequence[str]) -> Column:
    return any_of(F.col(c).isNull() for c in columns)


def attrs_differ(pairs: Iterable[tuple[str, str]]) -> Column:
    """True when at least one pair of columns differs; null equals null."""
    return any_of(~F.col(a).eqNullSafe(F.col(b)) for a, b in pairs)
