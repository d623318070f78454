"""Column comparison of tables whose keys repeat: rows of a key are paired one to one, never all with all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.predicates import all_present
from rowloom.operators.joins import LEFT, RIGHT, join_unique
from rowloom.workspace import materialize


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with each row's place, from 0, in the order of ``order``. Equal rows get adjacent places.

    Rows are dealt out by range and written once; only one row per partition takes part in the running
    total, so no task sees more than its range, however many rows share a key.
    """
    ranged = df.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    placed = materialize(
        ranged.select(
            "*",
            F.spark_partition_id().alias("part__"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("local__"),
        )
    )
    sizes = placed.groupBy("part__").agg(F.count(F.lit(1)).alias("size__"))
    before = Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part__", F.coalesce(F.sum("size__").over(before), F.lit(0)).alias("start__"))
    return placed.join(F.broadcast(starts), "part__").select(
        *df.columns, (F.col("start__") + F.col("local__")).alias(name)
    )


def pair_repeated(left: DataFrame, right: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Rows of each key, paired: the keys, ``pair``, the compared columns of both sides, ``has_left`` and ``has_right``.

    Rows that are equal on both sides cancel, as multisets. Of what is left of a key, the first row of one side in the
    order of ``compare`` is paired with the first of the other, and so on; the longer side's last rows stay
    alone. Rows with a null key have no partner and are left out, as in the other column comparisons.

    Equal rows are counted before the shuffle, places come from ``numbered``, and pairs meet by key and place, so no
    key, however many rows it owns, is worked on by one task.
    """
    keys, compare = list(keys), list(compare)
    columns = [*keys, *compare]
    tagged = left.select(*columns, F.lit(1).alias("sign")).unionByName(right.select(*columns, F.lit(-1).alias("sign")))
    rest = (
        tagged.where(all_present(keys))
        .groupBy(*columns)
        .agg(F.sum("sign").alias("surplus"))
        .where(F.col("surplus") != 0)
        .select(
            *columns,
            (F.col("surplus") > 0).alias("of_left"),
            F.explode(F.sequence(F.lit(1), F.abs("surplus"))).alias("copy"),
        )
        .drop("copy")
    )
    placed = numbered(rest, [*keys, "of_left", *compare], "place")
    first = placed.groupBy(*keys, "of_left").agg(F.min("place").alias("first_place"))
    ranked = join_unique(placed, first, [*keys, "of_left"], "inner").withColumn("pair", F.col("place") - F.col("first_place") + 1)
    side = lambda flag, prefix, name: ranked.where(F.col("of_left") == flag).select(
        *keys, "pair", *(F.col(c).alias(prefix + c) for c in compare), F.lit(True).alias(name)
    )
    both = side(True, LEFT, "has_left").join(side(False, RIGHT, "has_right"), [*keys, "pair"], "full_outer")
    return both.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("has_left", "has_right")})


def reconcile_repeated(left: DataFrame, right: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """One row per pair of rows and differing column, both values as text, and one per row without a partner.

    ``presence`` is both, left_only or right_only; for the last two ``mismatched_col_name`` is null and each
    value is the row's compared columns, comma-joined, nulls as ``null``.
    """
    pairs = pair_repeated(left, right, keys, compare)
    cells = [
        F.struct(
            F.lit(c).alias("mismatched_col_name"),
            F.col(LEFT + c).cast("string").alias("value_from_t1"),
            F.col(RIGHT + c).cast("string").alias("value_from_t2"),
            (~F.col(LEFT + c).eqNullSafe(F.col(RIGHT + c))).alias("differs"),
        )
        for c in compare
    ]
    shown = lambda prefix: F.concat_ws(",", *(F.coalesce(F.col(prefix + c).cast("string"), F.lit("null")) for c in compare))
    alone = F.array(
        F.struct(
            F.lit(None).cast("string").alias("mismatched_col_name"),
            F.when(F.col("has_left"), shown(LEFT)).alias("value_from_t1"),
            F.when(F.col("has_right"), shown(RIGHT)).alias("value_from_t2"),
            F.lit(True).alias("differs"),
        )
    )
    both = F.col("has_left") & F.col("has_right")
    presence = F.when(both, "both").when(F.col("has_left"), "left_only").otherwise("right_only")
    rows = F.inline(F.when(both, F.filter(F.array(*cells), lambda c: c["differs"])).otherwise(alone))
    return pairs.select(*keys, "pair", presence.alias("presence"), rows).drop("differs")
