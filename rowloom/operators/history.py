"""Full extracts of any day, and many at once, merged into a dimension of type 2.

A dimension says what each key looked like on each day. A full extract of day D says it anew from D until the next day
of which an extract is known; so a late extract changes the middle of the history, and what later extracts
said stays. All extracts of one call go through one plan: versions and extract rows meet once per key, ordered by day,
neighbouring spans that agree become one version (gaps and islands), and nothing is merged extract by extract.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.predicates import all_present, any_missing
from rowloom.operators.joins import join_unique, keep_matching, union_all
from rowloom.operators.scd2 import HIGH_DATE, Versioning

DAY = "extract_day"


def merge_extracts(
    dimension: DataFrame,
    extracts: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    days: Sequence[date],
    known_days: Sequence[date] = (),
    day: str = DAY,
    audit: Versioning = Versioning(),
    missing: str = "expire",
    unique_keys: bool = False,
) -> DataFrame:
    """The dimension after full extracts of ``days``, in whatever order they came.

    ``extracts`` holds their rows with the column ``day``; an extract without rows is known by its day alone.
    ``known_days`` are the days of the extracts that the dimension was made of; a day among them is replaced by its
    new extract. Applying extracts one by one, in any order, in groups, or all at once gives the same versions as
    ``scd2_merge`` in the order of days, with the columns in ``compare``; the other columns of a version are
    those of the row that opened it, as far as the dimension still holds that row.

    ``missing`` says what a key's absence from an extract means: it ends the version (``expire``) or says
    nothing (``keep``; then a late row lasts until the next known day, which is taken to have held the key).

    Keys that occur twice on one day, or of which two versions start on one day, have no one history: all their
    versions stay as they are and ``unmerged_rows`` lists their extract rows, as it does those with a null key.
    ``unique_keys=True`` skips the look at them.

    Versions that ended before the first of ``days`` are read and passed on; the others and the extract rows are
    shuffled and sorted once, on the keys, in ``spark.sql.shuffle.partitions`` parts. A key has no more rows there than there
    are versions and days.
    """
    if missing not in ("expire", "keep"):
        raise ValueError(f"missing must be 'expire' or 'keep', not {missing!r}")
    attributes = [c for c in dimension.columns if c not in audit.columns]
    if set(extracts.columns) != {*attributes, day}:
        raise ValueError(f"extracts must have the columns {[*attributes, day]}, they have {extracts.columns}")
    if not days:
        return dimension
    keys, new, old = list(keys), sorted(set(days)), sorted(set(known_days) - set(days))
    start, end = (F.col(c).cast("date") for c in (audit.start, audit.end))
    settled = end < F.lit(new[0])
    untouched = [dimension.where(F.coalesce(settled, F.lit(True)) | start.isNull() | any_missing(keys))]
    versions = dimension.where(~settled & start.isNotNull() & all_present(keys))
    rows = extracts.where(all_present(keys) & F.col(day).isin(new))
    if not unique_keys:
        unclear = _unclear_keys(versions, rows, keys, start, day, new)
        untouched.append(join_unique(versions, unclear, keys, "left_semi"))
        versions, rows = (join_unique(side, unclear, keys, "left_anti") for side in (versions, rows))

    later = sorted({*old, *new}) if missing == "expire" else old
    spans = _spans(versions, rows, keys, attributes, later, new if missing == "expire" else [], day, start, end)
    types = {f.name: f.dataType for f in dimension.schema.fields}
    merged = _islands(spans, keys, compare)
    is_open = F.col("until") == F.lit(HIGH_DATE).cast("date")
    values = {
        audit.start: F.col("since"),
        audit.end: F.col("until"),
        audit.flag: F.when(is_open, audit.active).otherwise(audit.inactive),
    }
    result = merged.select(
        *((values[c] if c in values else F.col(c if c in keys else f"row.{c}")).cast(types[c]).alias(c) for c in dimension.columns)
    )
    return union_all([result, *untouched])


def unmerged_rows(
    dimension: DataFrame, extracts: DataFrame, keys: Sequence[str], day: str = DAY, audit: Versioning = Versioning()
) -> DataFrame:
    """The extract rows that ``merge_extracts`` leaves out: those with a null key or a key without one history."""
    keys = list(keys)
    unclear = _unclear_keys(dimension.where(all_present(keys)), extracts.where(all_present(keys)), keys, F.col(audit.start), day)
    return extracts.where(any_missing(keys)).unionByName(keep_matching(extracts.where(all_present(keys)), unclear, keys))


def _unclear_keys(
    versions: DataFrame, rows: DataFrame, keys: list[str], start: Column, day: str, days: Sequence[date] | None = None
) -> DataFrame:
    """Keys with two rows of one day on a side; counted before the shuffle, so a hot key is one row per task.

    If all days of the extract rows are among ``days``, a key's rows are counted against the set of their days, a bit
    for each, so that a task holds one entry per key and not one per key and day.
    """
    starts = versions.select(*keys, start.cast("date").alias("on"))
    said = rows.select(*keys, F.col(day).cast("date").alias("on"))
    if days is None:
        return _twice(starts, keys).unionByName(_twice(said, keys)).distinct()
    place = F.array_position(F.array(*(F.lit(d) for d in days)), F.col("on")) - 1
    words = range(math.ceil(len(days) / 64))
    seen = [F.bit_or(F.expr(f"if(place div 64 = {w}, shiftleft(1L, cast(place % 64 as int)), 0L)")).alias(f"seen_{w}") for w in words]
    n_days = reduce(add, (F.bit_count(f"seen_{w}") for w in words))
    counted = said.withColumn("place", place).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *seen)
    return _twice(starts, keys).unionByName(counted.where(F.col("n") > n_days).select(*keys)).distinct()


def _twice(dated: DataFrame, keys: list[str]) -> DataFrame:
    return dated.groupBy(*keys, "on").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(*keys)


def _next(days: Sequence[date], on: Column) -> Column:
    """The first of ``days`` (ascending) after a day; the end of time if there is none."""
    if not days:
        return F.lit(HIGH_DATE).cast("date")
    listed = F.array(*(F.lit(d) for d in days))
    return F.coalesce(F.array_min(F.filter(listed, lambda d: d > on)), F.lit(HIGH_DATE).cast("date"))


def stretches_of(new: Sequence[date], later: Sequence[date]) -> list[tuple[date, date]]:
    """Spans [from, to) of time about which the extracts of ``new`` speak, neighbouring ones as one."""
    out: list[tuple[date, date]] = []
    for d in new:
        at = bisect_right(later, d)
        to = later[at] if at < len(later) else date.fromisoformat(HIGH_DATE)
        if out and out[-1][1] == d:
            out[-1] = (out[-1][0], to)
        else:
            out.append((d, to))
    return out


def _spans(versions, rows, keys, attributes, later, expiring, day, start, end) -> DataFrame:
    """Per key, the time between neighbouring changes of versions or extracts: ``since``, ``until``, ``row``, ``origin``.

    ``origin`` is the start of the version that a span is part of, null if an extract says what it holds.
    """
    row = F.struct(*(c for c in attributes if c not in keys))
    version = F.struct(row.alias("row"), start.alias("since"), end.alias("until"))
    said = F.struct(row.alias("row"), _next(later, F.col(day)).alias("until"))
    blocks = stretches_of(expiring, later)
    bounds = F.array(*(F.lit(d) for d in sorted({d for b in blocks for d in b}))) if blocks else F.array().cast("array<date>")
    within = F.filter(bounds, lambda d: (d > start) & (d < end))
    empty = F.lit(None)
    points = F.concat(
        F.array(F.struct(start.alias("at"), version.alias("version"))),
        F.transform(F.array_append(within, end), lambda d: F.struct(d.alias("at"), empty.cast(_type(versions, version)).alias("version"))),
    )
    from_versions = versions.select(*keys, F.inline(points))
    from_rows = rows.select(*keys, F.col(day).cast("date").alias("at"), said.alias("said"))
    both = from_versions.unionByName(from_rows, allowMissingColumns=True)
    if not blocks:  # else a version that lasts longer than what is said begins anew there, at the end of a block
        ends = from_rows.select(*keys, F.col("said.until").alias("at"))
        both = both.unionByName(ends, allowMissingColumns=True)

    # rows of one key look alike and shrink in the shuffle, so that Spark, which joins partitions by their size there,
    # would give a task many times what it sorts; a fixed number of partitions stays as it is
    both = both.repartition(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)

    by_key = Window.partitionBy(*keys).orderBy("at")
    so_far = by_key.rangeBetween(Window.unboundedPreceding, Window.currentRow)  # all rows of a day see the same
    state = both.select(
        *keys,
        "at",
        F.last("version", ignorenulls=True).over(so_far).alias("version"),
        F.last("said", ignorenulls=True).over(so_far).alias("said"),
        F.lead("at").over(by_key).alias("next"),
    )
    silent = F.exists(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in blocks)),
                      lambda s: (s["a"] <= F.col("at")) & (F.col("at") < s["b"])) if blocks else F.lit(False)
    is_said = F.coalesce(F.col("at") < F.col("said.until"), F.lit(False))
    is_kept = F.coalesce(F.col("at") < F.col("version.until"), F.lit(False)) & ~silent
    until = F.least("next", F.when(is_said, F.col("said.until")))  # the lesser, or the one there is
    return state.select(
        *keys,
        F.col("at").alias("since"),
        until.alias("until"),
        F.when(is_said, F.col("said.row")).when(is_kept, F.col("version.row")).alias("row"),
        F.when(~is_said, F.col("version.since")).alias("origin"),
        (is_said | is_kept).alias("holds"),
    ).where("holds and until > since")  # of several rows of a day, the last has the next day after it


def _type(df: DataFrame, value: Column):
    return df.select(value.alias("value")).schema["value"].dataType


def _islands(spans: DataFrame, keys: list[str], compare: Sequence[str]) -> DataFrame:
    """Neighbouring spans that agree on ``compare`` as one; two versions of the dimension stay two."""
    by_key = Window.partitionBy(*keys).orderBy("since")
    before = F.lag(F.struct("until", "origin", *(F.col(f"row.{c}").alias(f"old_{c}") for c in compare if c not in keys))).over(by_key)
    agree = F.col("before.until") == F.col("since")
    for c in compare:
        if c not in keys:
            agree &= F.col(f"before.old_{c}").eqNullSafe(F.col(f"row.{c}"))
    two_versions = F.col("before.origin") != F.col("origin")
    starts = ~F.coalesce(agree, F.lit(False)) | F.coalesce(two_versions, F.lit(False))
    marked = spans.withColumn("before", before).withColumn("starts", starts).drop("before")
    marked = marked.withColumn("ends", F.lead("starts", 1, True).over(by_key))
    # an island's first and last span are neighbours then; all windows share the order of the first
    edges = marked.where("starts or ends").withColumn("until", F.when(F.col("ends"), F.col("until")).otherwise(F.lead("until").over(by_key)))
    return edges.where("starts").select(*keys, "since", "until", "row")
