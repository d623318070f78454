"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.operators.changes import COMMON, DELETED, NEW, REJECTED, UPDATED, classify_flat
from rowloom.operators.joins import LEFT, RIGHT

HIGH_DATE = "9999-12-31"  # Fixed value: end of an open version.


@dataclass(frozen=True)
class Versioning:
    """The three audit columns of a dimension and the two values of the last one."""

    start: str = "eff_dt"
    end: str = "end_dt"
    flag: str = "act_in"
    active: str = "Y"
    inactive: str = "N"

    @property
    def columns(self) -> tuple[str, str, str]:
        return self.start, self.end, self.flag


def open_versions(rows: DataFrame, run_date: date, audit: Versioning = Versioning()) -> DataFrame:
    """First load of a dimension: every row becomes an open version."""
    return rows.withColumns(
        {
            audit.start: F.lit(run_date).cast("date"),
            audit.end: F.lit(HIGH_DATE).cast("date"),
            audit.flag: F.lit(audit.active),
        }
    )


def scd2_merge(
    master: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    run_date: date,
    audit: Versioning = Versioning(),
    missing: str = "keep",
    unique_keys: bool = False,
) -> DataFrame:
    """The dimension after applying a full extract.

    Only active versions are compared, so a replay changes nothing. An updated row closes
    its version and opens a new one; a new key opens one; closed versions pass through.
    ``missing`` says what becomes of active keys the extract lacks: ``keep`` them or
    ``expire`` them. Rows that ``classify_changes`` rejects change nothing: those of the
    master stay as they are, those of the delta are left to ``rejected_rows``.

    A version that started after ``run_date`` is newer than the extract: a late extract neither
    closes nor replaces it, so no version ends before it starts. ``late_rows`` returns what such an
    extract would have changed.
    """
    if missing not in ("keep", "expire"):
        raise ValueError(f"missing must be 'keep' or 'expire', not {missing!r}")
    attributes = [c for c in master.columns if c not in audit.columns]
    if set(attributes) != set(delta.columns):
        raise ValueError(f"delta must have the columns {attributes}, it has {delta.columns}")

    is_active = F.col(audit.flag).eqNullSafe(F.lit(audit.active))
    flat = classify_flat(master.where(is_active), delta, keys, compare, unique_keys)

    types = {f.name: f.dataType for f in master.schema.fields}

    def version(prefix: str, **audit_values: Column) -> Column:
        def value(name: str) -> Column:
            default = F.col(name if name in keys else prefix + name)
            return audit_values.get(name, default).cast(types[name]).alias(name)

        return F.struct(*(value(c) for c in master.columns))

    today = F.lit(run_date).cast("date")
    kept = version(LEFT)
    expired = version(LEFT, **{audit.end: today, audit.flag: F.lit(audit.inactive)})
    opened = version(
        RIGHT,
        **{audit.start: today, audit.end: F.lit(HIGH_DATE).cast("date"), audit.flag: F.lit(audit.active)},
    )
    status = F.col("status")
    stays = (status == COMMON) | ((status == REJECTED) & F.col("has_left")) | _is_late(audit, run_date)
    versions = (
        F.when(stays, F.array(kept))
        .when(status == UPDATED, F.array(expired, opened))
        .when(status == NEW, F.array(opened))
        .when(status == DELETED, F.array(expired if missing == "expire" else kept))
    )
    return flat.select(F.inline(versions)).unionByName(master.where(~is_active))


def _is_late(audit: Versioning, run_date: date) -> Column:
    """Whether the active version of a classified row started after the run date."""
    started = F.col(LEFT + audit.start).cast("date")
    return F.col("has_left") & F.coalesce(started > F.lit(run_date).cast("date"), F.lit(False))


def late_rows(
    master: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    run_date: date,
    audit: Versioning = Versioning(),
) -> DataFrame:
    """The delta rows that a merge leaves out because the active version of their key is newer."""
    is_active = F.col(audit.flag).eqNullSafe(F.lit(audit.active))
    flat = classify_flat(master.where(is_active), delta, keys, compare)
    return flat.where((F.col("status") == UPDATED) & _is_late(audit, run_date)).select(
        *(F.col(c if c in keys else RIGHT + c).alias(c) for c in delta.columns)
    )


def rejected_rows(
    master: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    audit: Versioning | None = None,
) -> DataFrame:
    """Rows of either side that a merge cannot apply, with the side they come from."""
    if audit is not None:
        master = master.where(F.col(audit.flag).eqNullSafe(F.lit(audit.active))).drop(*audit.columns)
    shared = [c for c in delta.columns if c in master.columns]
    flat = classify_flat(master.select(*shared), delta.select(*shared), keys, [])
    value = lambda c: F.when(F.col("has_left"), F.col(LEFT + c)).otherwise(F.col(RIGHT + c)).alias(c)
    return flat.where(F.col("status") == REJECTED).select(
        *(F.col(c) if c in keys else value(c) for c in shared),
        F.when(F.col("has_left"), "master").otherwise("delta").alias("side"),
    )


def latest_version(dimension: DataFrame, by: Sequence[str], newest: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest row of each group; ``ties`` (descending) decide between equal dates."""
    order = [F.col(c).desc() for c in (newest, *ties)]
    return (
        dimension.withColumn("row_num", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        .where(F.col("row_num") == 1)
        .drop("row_num")
    )


def scd2_as_of(dimension: DataFrame, day: date, audit: Versioning = Versioning()) -> DataFrame:
    """The versions valid on ``day``."""
    on = F.lit(day).cast("date")
    return dimension.where((F.col(audit.start).cast("date") <= on) & (on < F.col(audit.end).cast("date")))
