"""Change data capture: keep a master equal to the newest full extract."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.parsing import timestamp_literal
from rowloom.operators.changes import COMMON, DELETED, NEW, REJECTED, UPDATED, classify_flat
from rowloom.operators.joins import LEFT, RIGHT, keep_matching, keep_missing

HIGH_TIMESTAMP = "9999-12-31 23:59:00"  # Fixed value: end of an open record.
STAMPS = ("eff_start_date", "eff_end_date")


class CdcResult(NamedTuple):
    """The new master, the records that left it, and the delta records that could not be applied."""

    current: DataFrame
    deleted: DataFrame
    rejected: DataFrame


def cdc_initial(rows: DataFrame, run_ts: datetime) -> DataFrame:
    """First load: every record is open from ``run_ts`` on."""
    return rows.withColumns(
        {
            STAMPS[0]: timestamp_literal(run_ts),
            STAMPS[1]: timestamp_literal(HIGH_TIMESTAMP),
        }
    )


def cdc_outcome(
    master: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    run_ts: datetime,
    unique_keys: bool = False,
) -> DataFrame:
    """All records with an ``outcome``: current, deleted or rejected.

    New and updated records get fresh stamps, common ones keep theirs. Of the rows that
    ``classify_changes`` rejects, those of the master stay current as they are and those of
    the delta are rejected. One plan, so a write partitioned by ``outcome`` feeds all
    targets in one pass.
    """
    flat = classify_flat(master, delta, keys, compare, unique_keys)
    status = F.col("status")
    fresh = status.isin(NEW, UPDATED)
    from_delta = fresh | ((status == REJECTED) & F.col("has_right"))
    outcome = (
        F.when(fresh | (status == COMMON), "current")
        .when(status == DELETED, "deleted")
        .when(F.col("has_left"), "current")
        .otherwise("rejected")
    )
    types = {f.name: f.dataType for f in master.schema.fields}
    stamps = {STAMPS[0]: timestamp_literal(run_ts), STAMPS[1]: timestamp_literal(HIGH_TIMESTAMP)}

    def value(name: str):
        if name in keys:
            return F.col(name)
        if name in stamps:
            opened = F.when(fresh, stamps[name].cast(types[name]))
            return F.coalesce(opened, F.col(LEFT + name)).alias(name)
        new = F.col(RIGHT + name).cast(types[name])
        return F.when(from_delta, new).otherwise(F.col(LEFT + name)).alias(name)

    return flat.select(*(value(c) for c in master.columns), outcome.alias("outcome"))


def cdc_outcome_checked(
    master: DataFrame, delta: DataFrame, keys: Sequence[str], problem: str, run_ts: datetime
) -> DataFrame:
    """``cdc_outcome`` of an extract in which some lines could not be read, with the column ``problem``.

    ``problem`` is null for the delta's good rows and holds the line otherwise. Such lines are rejected. If
    the key of one can be read, nothing is known of what the source holds for it: the master's record
    stays current, and good delta rows of that key are rejected too.
    """
    good = delta.where(F.col(problem).isNull()).drop(problem)
    bad = delta.where(F.col(problem).isNotNull())
    compare = [c for c in good.columns if c not in keys]
    unknown = bad.select(*keys).distinct()
    known_master, known_delta = keep_missing(master, unknown, keys), keep_missing(good, unknown, keys)
    none = F.lit(None).cast("string")
    types = {f.name: f.dataType for f in master.schema.fields}

    def like_master(rows: DataFrame, outcome: str, text: Column) -> DataFrame:
        value = lambda c: (F.col(c) if c in rows.columns else F.lit(None)).cast(types[c]).alias(c)
        return rows.select(*(value(c) for c in master.columns), F.lit(outcome).alias("outcome"), text.alias(problem))

    merged = cdc_outcome(known_master, known_delta, keys, compare, run_ts).withColumn(problem, none)
    return (
        merged.unionByName(like_master(keep_matching(master, unknown, keys), "current", none))
        .unionByName(like_master(keep_matching(good, unknown, keys), "rejected", none))
        .unionByName(like_master(bad, "rejected", F.col(problem)))
    )


def cdc_merge(
    master: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    run_ts: datetime,
    unique_keys: bool = False,
) -> CdcResult:
    """The outcome split by target. Write each to its own new location, never over the master."""
    return split_outcome(cdc_outcome(master, delta, keys, compare, run_ts, unique_keys))


def split_outcome(outcome: DataFrame) -> CdcResult:
    """Split rows that carry an ``outcome``; give it a written table when several parts are used."""
    part = lambda name: outcome.where(F.col("outcome") == name).drop("outcome")
    return CdcResult(part("current"), part("deleted").drop(*STAMPS), part("rejected").drop(*STAMPS))
