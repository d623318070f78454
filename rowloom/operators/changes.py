"""Classification of a full extract (delta) against the current rows (master)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.predicates import any_missing, attrs_differ
from rowloom.operators.joins import LEFT, RIGHT, pair_by_key

NEW, UPDATED, COMMON, DELETED, REJECTED = "N", "U", "C", "D", "R"


def classify_flat(
    master: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    unique_keys: bool = False,
) -> DataFrame:
    """As ``classify_changes``, with prefixed flat columns, so that unused ones are never read."""
    pairs = pair_by_key(master, delta, keys, unique_keys)
    unusable = any_missing(keys) | (F.col("pairing") == "ambiguous") | (F.col("right_copies") > 1)
    changed = attrs_differ((LEFT + c, RIGHT + c) for c in compare)
    status = (
        F.when(unusable, REJECTED)
        .when(F.col("pairing") == "right", NEW)
        .when(F.col("pairing") == "left", DELETED)
        .when(changed, UPDATED)
        .otherwise(COMMON)
    )
    return pairs.withColumn("status", status)


def classify_changes(
    master: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    unique_keys: bool = False,
) -> DataFrame:
    """The keys, a ``status``, and the two rows as structs ``m`` and ``d``.

    N new, U updated, C common, D deleted; null equals null. R marks rows that have no
    well-defined partner: a null key, a key repeated in the delta, or a key on both sides
    that the master repeats. They are returned one by one, so every input row is in
    exactly one output row.
    """
    flat = classify_flat(master, delta, keys, compare, unique_keys)
    side = lambda df, prefix: F.struct(*(F.col(c if c in keys else prefix + c).alias(c) for c in df.columns))
    return flat.select(
        *keys,
        "status",
        F.when(F.col("has_left"), side(master, LEFT)).alias("m"),
        F.when(F.col("has_right"), side(delta, RIGHT)).alias("d"),
    )


def change_summary(classified: DataFrame) -> DataFrame:
    """Rows per status."""
    return classified.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


def control_total(
    master: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    unique_keys: bool = False,
) -> DataFrame:
    """One row of counts, and whether they add up to independent counts of both inputs.

    master = common + updated + deleted + rejected from the master,
    delta = common + updated + new + rejected from the delta.
    """
    flat = classify_flat(master, delta, keys, compare, unique_keys)
    rejected_side = F.when(F.col("has_left"), "rejected_master").otherwise("rejected_delta")
    measure = F.when(F.col("status") == REJECTED, rejected_side).otherwise(F.col("status"))
    counted = (
        flat.select(measure.alias("measure"))
        .unionByName(master.select(F.lit("master").alias("measure")))
        .unionByName(delta.select(F.lit("delta").alias("measure")))
        .groupBy("measure")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Output column per measure.
    names = {
        "master": "master_rows",
        "delta": "delta_rows",
        COMMON: "common_rows",
        NEW: "new_rows",
        UPDATED: "updated_rows",
        DELETED: "deleted_rows",
        "rejected_master": "rejected_master_rows",
        "rejected_delta": "rejected_delta_rows",
    }
    totals = counted.agg(
        *(
            F.coalesce(F.sum(F.when(F.col("measure") == m, F.col("n"))), F.lit(0)).cast("long").alias(name)
            for m, name in names.items()
        )
    )
    kept = F.col("common_rows") + F.col("updated_rows")
    return totals.withColumn(
        "balanced",
        (F.col("master_rows") == kept + F.col("deleted_rows") + F.col("rejected_master_rows"))
        & (F.col("delta_rows") == kept + F.col("new_rows") + F.col("rejected_delta_rows")),
    )
