"""Reconciliation of two tables by key, column and row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.predicates import attrs_differ
from rowloom.operators.joins import LEFT, RIGHT, join_unique, pair_by_key, rows_without_partner


def _shared_columns(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in left.columns if c in right.columns and c not in keys]


def reconcile_presence(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner: ``left_only``, ``right_only``, or ``repeated_key``.

    The last are rows whose key is on both sides and more than once on one of them; the
    column comparisons leave them out, since they have no one partner. Columns that only
    the other side has are null.
    """
    alone = rows_without_partner(left, right, keys)
    presence = (
        F.when(F.col("pairing") == "left", "left_only")
        .when(F.col("pairing") == "right", "right_only")
        .otherwise("repeated_key")
    )
    columns = [c for c in dict.fromkeys([*left.columns, *right.columns]) if c not in keys]

    def value(name: str) -> Column:
        if name not in right.columns:
            return F.col(LEFT + name).alias(name)
        if name not in left.columns:
            return F.col(RIGHT + name).alias(name)
        return F.when(F.col("has_left"), F.col(LEFT + name)).otherwise(F.col(RIGHT + name)).alias(name)

    return alone.select(
        *keys,
        *(value(c) for c in columns),
        F.when(F.col("has_left"), "left").otherwise("right").alias("side"),
        presence.alias("presence"),
    )


def reconcile_wide(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """One row per differing key, with ``"a vs b"`` in ``<column>_mismatch`` where a column differs."""
    compare = list(compare or _shared_columns(left, right, keys))
    pairs = _comparable(left, right, keys, compare, unique_keys)

    def mismatch(name: str) -> Column:
        a, b = F.col(LEFT + name), F.col(RIGHT + name)
        text = F.concat(_shown(a), F.lit(" vs "), _shown(b))
        return F.when(~a.eqNullSafe(b), text).alias(f"{name}_mismatch")

    return pairs.where(attrs_differ((LEFT + c, RIGHT + c) for c in compare)).select(
        *keys, *(mismatch(c) for c in compare)
    )


def _shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def reconcile_long(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """One row per differing key and column, both values as text.

    Columns are compared in their own type. One join, then one pass that unfolds the columns.
    """
    compare = list(compare or _shared_columns(left, right, keys))
    pairs = _comparable(left, right, keys, compare, unique_keys)
    cells = []
    for name in compare:
        a, b = F.col(LEFT + name), F.col(RIGHT + name)
        cells += [F.lit(name), a.cast("string"), b.cast("string"), ~a.eqNullSafe(b)]
    unfolded = pairs.select(
        *keys,
        F.stack(F.lit(len(compare)), *cells).alias("mismatched_col_name", "value_from_t1", "value_from_t2", "differs"),
    )
    return unfolded.where(F.col("differs")).drop("differs")


def _comparable(left, right, keys, compare, unique_keys) -> DataFrame:
    return pair_by_key(
        left.select(*keys, *compare), right.select(*keys, *compare), keys, unique_keys, matched_only=True
    )


def active_rows(df: DataFrame, flag: str, active: str = "Y") -> DataFrame:
    """Rows whose flag has the active value."""
    return df.where(F.col(flag) == active)


def _presence_by_row(source: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct rows of both tables and where they occur: one shuffle, combined before it."""
    columns = source.columns
    tagged = source.select(*columns, F.lit(1).alias("in_source"), F.lit(0).alias("in_target")).unionByName(
        target.select(*columns, F.lit(0).alias("in_source"), F.lit(1).alias("in_target"))
    )
    return tagged.groupBy(*columns).agg(F.max("in_source").alias("in_source"), F.max("in_target").alias("in_target"))


def missing_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct rows of ``source`` that ``target`` lacks; null equals null."""
    return (
        _presence_by_row(source, target)
        .where((F.col("in_source") == 1) & (F.col("in_target") == 0))
        .drop("in_source", "in_target")
    )


def reconcile_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct rows that one table lacks, with the table they are ``MISSING_FROM``."""
    rows = _presence_by_row(source, target)
    return (
        rows.where(F.col("in_source") != F.col("in_target"))
        .withColumn("MISSING_FROM", F.when(F.col("in_source") == 1, "TARGET").otherwise("SOURCE"))
        .drop("in_source", "in_target")
    )


def rows_without_equal(source: DataFrame, target: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``source``, duplicates included, for which no row of ``target`` equals them on ``on``.

    The columns are compared as one struct, in which null equals null.
    """
    on = list(on or source.columns)
    row_key = F.struct(*on).alias("row_key")
    rows = source.select(row_key, *(c for c in source.columns if c not in on))
    unequal = join_unique(rows, target.select(row_key).distinct(), ["row_key"], "left_anti")
    return unequal.select(*(F.col(f"row_key.{c}") if c in on else F.col(c) for c in source.columns))
