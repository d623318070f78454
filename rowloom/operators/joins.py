"""Joins that never multiply rows and hold up when one key owns a large share of them.

Everything here is a lazy plan: nothing runs before the result is used. How often a key occurs is
counted inside the plan, combined before the shuffle, so a hot key is one row per task there. Rows that
have to be joined whole are joined by plain sort-merge joins whose two sides are both fresh shuffles;
where a key fills a partition, Spark splits that partition by its size in bytes
(``spark.sql.adaptive.skewJoin``). Rows with a null key match nothing and never enter a shuffle.

A side is broadcast only if Spark's estimate of it is within ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.predicates import all_present, any_missing

LEFT, RIGHT = "left__", "right__"
HOT_ROWS = 10_000  # Fixed value: rows of a key beyond which they are not brought together in one task.


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark estimates ``df`` to be within its own broadcast limit.

    The estimate is read from the JVM's plan, which a Spark Connect session does not offer.
    """
    return _estimate(df) <= _broadcast_limit(df)


def _estimate(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _broadcast_limit(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def join_unique(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``rows`` to a ``lookup`` that holds each key at most once.

    ``how`` is inner, left, left_semi or left_anti. All of them let Spark split the partition of a
    hot key on the side of ``rows``, provided both sides are fresh shuffles; so the lookup, usually an
    aggregate by the keys, is joined by a struct of them. Null keys bypass the shuffle.
    """
    keys = list(keys)
    if fits_broadcast(lookup):
        return rows.join(F.broadcast(lookup), keys, how)
    details = [c for c in lookup.columns if c not in keys]
    fresh = lookup.where(all_present(keys)).select(F.struct(*keys).alias("lookup__key"), *details)
    joined = rows.where(all_present(keys)).join(fresh, F.struct(*keys) == F.col("lookup__key"), how)
    joined = joined.drop("lookup__key") if how in ("inner", "left") else joined
    return union_all([joined, rows.where(any_missing(keys))]) if how in ("left", "left_anti") else joined


def keep_matching(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``other``; duplicates stay, none are added."""
    return _filter_by(rows, other, list(keys), "left_semi")


def keep_missing(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``other``; rows with a null key are among them."""
    return _filter_by(rows, other, list(keys), "left_anti")


def _filter_by(rows: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    other_keys = other.select(*keys)
    if fits_broadcast(other_keys):
        return rows.join(F.broadcast(other_keys), keys, how)
    if fits_broadcast(rows):
        shared = other_keys.join(F.broadcast(rows.select(*keys)), keys, "left_semi").distinct()
        return rows.join(F.broadcast(shared), keys, how)  # no more keys than ``rows`` holds
    return join_unique(rows, other_keys.distinct(), keys, how)


def pair_by_key(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    unique_keys: bool = False,
    matched_only: bool = False,
) -> DataFrame:
    """Bring the two rows of each key together, without ever multiplying rows.

    Columns: the keys, the other columns of each side under the prefixes ``LEFT`` and
    ``RIGHT``, ``has_left``, ``has_right``, ``right_copies`` (rows of the key on the right)
    and ``pairing``:

    * ``both``: the key occurs once on each side and the row holds both;
    * ``left`` / ``right``: the key, or a null key, occurs on that side only;
    * ``ambiguous``: the key occurs on both sides and more than once on one of them. Each
      such row is returned alone.

    So every input row is in exactly one output row. ``unique_keys=True`` skips the look at
    the keys, for keys that are known to be unique. ``matched_only=True`` returns the
    ``both`` rows only.
    """
    keys = list(keys)
    lrows, rrows = _prefixed(left, keys, LEFT), _prefixed(right, keys, RIGHT)
    if fits_broadcast(right):
        return _pair_by_lookup(lrows, rrows, keys, unique_keys, matched_only)
    if not unique_keys:
        return _pair_by_count(lrows, rrows, keys, matched_only)
    present_left, present_right = lrows.where(all_present(keys)), rrows.where(all_present(keys))
    if matched_only:
        return present_left.join(present_right, keys, "inner").withColumns(_pair(True, True, F.lit(1), F.lit("both")))
    return union_all([_pair_by_shuffle(present_left, present_right, keys), *_null_keys(lrows, rrows, keys)])


def rows_without_partner(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``pair_by_key`` other than ``both``."""
    return pair_by_key(left, right, keys).where(F.col("pairing") != "both")


def _prefixed(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.select(*keys, *(F.col(c).alias(prefix + c) for c in df.columns if c not in keys))


def _pair(has_left: bool, has_right: bool, right_copies: Column, pairing: Column) -> dict[str, Column]:
    return {
        "has_left": F.lit(has_left),
        "has_right": F.lit(has_right),
        "right_copies": right_copies.cast("long"),
        "pairing": pairing,
    }


def _null_keys(lrows: DataFrame, rrows: DataFrame, keys: list[str]) -> list[DataFrame]:
    return [
        lrows.where(any_missing(keys)).withColumns(_pair(True, False, F.lit(0), F.lit("left"))),
        rrows.where(any_missing(keys)).withColumns(_pair(False, True, F.lit(1), F.lit("right"))),
    ]


def _pair_by_count(lrows: DataFrame, rrows: DataFrame, keys: list[str], matched_only: bool) -> DataFrame:
    """Both sides are large. ``_pair_in_order``, unless the keys of over ``HOT_ROWS`` rows may be too many to be broadcast.

    Then one aggregate over both counts each key and keeps the values of a row of each side. For keys that occur at most once on each side that is the result; a row with a null key is a group of
    its own, so such rows spread over all tasks. Only the rows of the other keys are read again: they meet
    the counts of their keys, counted from the key columns alone, in a join of two fresh shuffles.
    """
    tagged = union_all([lrows.withColumn("has_left", F.lit(True)), rrows.withColumn("has_left", F.lit(False))])
    values = [c for c in tagged.columns if c not in keys and c != "has_left"]
    counts = [F.count_if("has_left").alias("n_left"), F.count_if(~F.col("has_left")).alias("n_right")]
    n_left, n_right = F.col("n_left"), F.col("n_right")
    one_sided = F.when(n_left == 0, "right").when(n_right == 0, "left")
    columns = [*keys, *values, "has_left", "has_right", "right_copies", "pairing"]

    def named(rows: DataFrame, has_left: Column, has_right: Column, both_sides: str | Column) -> DataFrame:
        state = {"has_left": has_left, "has_right": has_right, "right_copies": n_right.cast("long")}
        return rows.withColumns(state | {"pairing": one_sided.otherwise(both_sides)}).select(columns)

    if (_estimate(lrows) + _estimate(rrows)) // HOT_ROWS <= _broadcast_limit(lrows):
        return _pair_in_order(tagged, keys, values, counts, named, matched_only)
    one_of = [F.first(c, ignorenulls=True).alias(c) for c in values]
    if matched_only:
        grouped = tagged.where(all_present(keys)).groupBy(*keys).agg(*counts, *one_of)
        return named(grouped.where((n_left == 1) & (n_right == 1)), n_left > 0, n_right > 0, "both")
    alone = F.when(any_missing(keys), F.monotonically_increasing_id()).alias("alone")
    grouped = tagged.groupBy(*keys, alone).agg(*counts, *one_of)
    pairs = named(grouped.where((n_left <= 1) & (n_right <= 1)), n_left > 0, n_right > 0, "both")
    # as a struct the keys are shuffled anew, so that a partition of a hot key can be split
    present = tagged.where(all_present(keys))
    repeated = (
        present.groupBy(*keys)
        .agg(*counts)
        .where((n_left > 1) | (n_right > 1))
        .select(F.struct(*keys).alias("repeated"), "n_left", "n_right")
    )
    again = present.join(repeated, F.struct(*keys) == F.col("repeated"))
    return pairs.unionByName(named(again, F.col("has_left"), ~F.col("has_left"), "ambiguous"))


def _pair_in_order(tagged: DataFrame, keys: list[str], values: list[str], counts: list[Column], named, matched_only: bool) -> DataFrame:
    """The rows of both sides are shuffled and sorted once, by key, and a left row takes the values of the row after it.

    Keys of over ``HOT_ROWS`` rows, counted before from the key columns alone, are no pairs; their number is broadcast, and
    their rows are not shuffled, nor are those with a null key.
    """
    n_left, n_right, has_left = F.col("n_left"), F.col("n_right"), F.col("has_left")
    present = tagged.where(all_present(keys))
    # joined as a struct: Spark would carry each side's filters on the keys into the counts, and count once for each
    counted = present.groupBy(*keys).agg(*counts).where(n_left + n_right > HOT_ROWS)
    hot, is_hot = F.broadcast(counted.select(F.struct(*keys).alias("hot"), "n_left", "n_right")), F.struct(*keys) == F.col("hot")
    by_key = Window.partitionBy(*keys).orderBy(has_left.desc())
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_right = [c for c in values if c.startswith(RIGHT)]
    in_order = present.join(hot, is_hot, "left_anti").select(
        "*",
        F.count_if("has_left").over(whole).alias("n_left"),
        F.count_if(~has_left).over(whole).alias("n_right"),
        *(F.lead(c).over(by_key).alias(f"next__{c}") for c in of_right),
    )
    is_pair = (n_left == 1) & (n_right == 1)
    joined = in_order.where(has_left | ~is_pair).withColumns(
        {c: F.when(is_pair, F.col(f"next__{c}")).otherwise(F.col(c)) for c in of_right}
    )
    if matched_only:
        return named(joined.where(is_pair), F.lit(True), F.lit(True), "both")
    alone = tagged.where(any_missing(keys)).withColumns({"n_left": has_left.cast("long"), "n_right": (~has_left).cast("long")})
    parts = [
        named(joined, has_left, ~has_left | is_pair, F.when(is_pair, "both").otherwise("ambiguous")),
        named(present.join(hot, is_hot), has_left, ~has_left, "ambiguous"),
        named(alone, has_left, ~has_left, "both"),
    ]
    return union_all(parts)


def _pair_by_lookup(
    lrows: DataFrame, rrows: DataFrame, keys: list[str], unique_keys: bool, matched_only: bool
) -> DataFrame:
    """The right side is small, and so are the keys both sides share: the left side is not shuffled."""
    present = rrows.where(all_present(keys))
    others = [c for c in rrows.columns if c not in keys]
    shared = lrows.select(*keys).join(F.broadcast(present.select(*keys)), keys, "left_semi")
    on_left = shared.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_left"))  # no more keys than the right side has
    if unique_keys:
        looked_up = present.withColumns({"n_left": F.lit(1), "n_right": F.lit(1)})
    else:
        looked_up = (
            present.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_right"), *(F.first(c, ignorenulls=True).alias(c) for c in others))
            .join(F.broadcast(on_left), keys, "left")
        )
    n_left, n_right = F.col("n_left"), F.col("n_right")
    is_pair = F.coalesce((n_left == 1) & (n_right == 1), F.lit(False))
    found = lrows.join(F.broadcast(looked_up), keys, "inner" if matched_only else "left")
    from_left = found.select(
        *lrows.columns,
        *(F.when(is_pair, F.col(c)).alias(c) for c in others),
        F.lit(True).alias("has_left"),
        is_pair.alias("has_right"),
        F.coalesce(n_right, F.lit(0)).cast("long").alias("right_copies"),
        F.when(is_pair, "both").when(n_right.isNotNull(), "ambiguous").otherwise("left").alias("pairing"),
    )
    if matched_only:
        return from_left.where(F.col("pairing") == "both")
    if unique_keys:
        alone = rrows.join(F.broadcast(on_left), keys, "left_anti")
        return union_all([from_left, alone.withColumns(_pair(False, True, F.lit(1), F.lit("right")))])
    counts = F.broadcast(looked_up.select(*keys, "n_left", "n_right"))
    pairing = F.when(n_left.isNull(), "right").otherwise("ambiguous")
    from_right = (
        rrows.join(counts, keys, "left")
        .where(~is_pair)
        .withColumns(_pair(False, True, F.coalesce(n_right, F.lit(1)), pairing))
        .drop("n_left", "n_right")
    )
    return union_all([from_left, from_right])


def _pair_by_shuffle(lrows: DataFrame, rrows: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides are large and their keys unique: one shuffle of each, on the keys."""
    no_left, no_right = F.col("has_left").isNull(), F.col("has_right").isNull()
    return (
        lrows.withColumn("has_left", F.lit(True))
        .join(rrows.withColumn("has_right", F.lit(True)), keys, "full_outer")
        .withColumns(
            {
                "has_left": ~no_left,
                "has_right": ~no_right,
                "right_copies": F.when(no_right, 0).otherwise(1).cast("long"),
                "pairing": F.when(no_left, "right").when(no_right, "left").otherwise("both"),
            }
        )
    )
