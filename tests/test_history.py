"""Extracts of many days merged at once and in any order, against one merge a day in the order of days."""

import random
import re
from datetime import date, timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from rowloom.operators import history, scd2
from tests.helpers import frame, plan_of, rows_of

DAYS = [date(2024, 3, 1) + timedelta(days=3 * i) for i in range(6)]
OPENED = date(2024, 1, 1)
SCHEMA = "id int, city string, rank int"


def random_extract(rng: random.Random) -> list[tuple]:
    return [(i, rng.choice(["a", "b", None]), rng.choice([1, 2])) for i in range(12) if rng.random() < 0.7]


def by_day(spark, extracts: dict[date, list[tuple]]):
    rows = [(*r, d) for d, own in extracts.items() for r in own]
    return frame(spark, SCHEMA + ", extract_day date", *rows)


def one_by_one(spark, first, extracts: dict[date, list[tuple]], missing: str):
    """The versions after a merge a day, in the order of days."""
    dimension = scd2.open_versions(frame(spark, SCHEMA, *first), OPENED)
    for d in sorted(extracts):
        dimension = scd2.scd2_merge(dimension, frame(spark, SCHEMA, *extracts[d]), ["id"], ["city", "rank"], d, missing=missing)
        dimension = frame(spark, SCHEMA + ", eff_dt date, end_dt date, act_in string", *map(tuple, dimension.collect()))
    return dimension


@pytest.mark.parametrize("missing", ["expire", "keep"])
@pytest.mark.parametrize("unique_keys", [True, False])
def test_many_days_in_one_plan(spark, missing, unique_keys, join_path):
    rng = random.Random(3)
    first, extracts = random_extract(rng), {d: random_extract(rng) for d in DAYS}
    start = scd2.open_versions(frame(spark, SCHEMA, *first), OPENED)
    merged = history.merge_extracts(
        start, by_day(spark, extracts), ["id"], ["city", "rank"], DAYS, [OPENED], missing=missing, unique_keys=unique_keys
    )
    assert merged.columns == start.columns and merged.schema.simpleString() == start.schema.simpleString()
    assert rows_of(merged) == rows_of(one_by_one(spark, first, extracts, missing))


def test_any_order_gives_the_same_dimension(spark):
    rng = random.Random(4)
    first, extracts = random_extract(rng), {d: random_extract(rng) for d in DAYS[:4]}
    extracts[DAYS[2]] = []  # an extract without rows ends every version
    expected = rows_of(one_by_one(spark, first, extracts, "expire"))
    for order in rng.sample(list(permutations(DAYS[:4])), 5):
        dimension, known = scd2.open_versions(frame(spark, SCHEMA, *first), OPENED), [OPENED]
        for d in order:
            merged = history.merge_extracts(dimension, by_day(spark, {d: extracts[d]}), ["id"], ["city", "rank"], [d], known)
            dimension = frame(spark, SCHEMA + ", eff_dt date, end_dt date, act_in string", *map(tuple, merged.collect()))
            known.append(d)
        assert rows_of(dimension) == expected, order


def test_groups_of_days_out_of_order_and_a_day_again(spark):
    rng = random.Random(5)
    first, extracts = random_extract(rng), {d: random_extract(rng) for d in DAYS}
    dimension, known = scd2.open_versions(frame(spark, SCHEMA, *first), OPENED), [OPENED]
    wrong = {DAYS[3]: random_extract(rng)}
    for group in ({DAYS[5]: extracts[DAYS[5]]}, wrong, {d: extracts[d] for d in DAYS[1:4]}, {d: extracts[d] for d in (DAYS[0], DAYS[4])}):
        merged = history.merge_extracts(dimension, by_day(spark, group), ["id"], ["city", "rank"], list(group), known)
        dimension = frame(spark, SCHEMA + ", eff_dt date, end_dt date, act_in string", *map(tuple, merged.collect()))
        known += group
    assert rows_of(dimension) == rows_of(one_by_one(spark, first, extracts, "expire"))


def test_a_late_row_splits_the_version_around_it(spark):
    start = scd2.open_versions(frame(spark, SCHEMA, (1, "a", 1), (2, "b", 1)), OPENED)
    late = frame(spark, SCHEMA + ", extract_day date", (1, "x", 1, DAYS[0]), (2, "b", 1, DAYS[0]), (3, "c", 1, DAYS[0]))
    merged = history.merge_extracts(start, late, ["id"], ["city"], [DAYS[0]], [OPENED, DAYS[3]])
    high = date(9999, 12, 31)
    assert sorted(rows_of(merged, "id", "city", "eff_dt", "end_dt", "act_in")) == [
        (1, "a", OPENED, DAYS[0], "N"),
        (1, "a", DAYS[3], high, "Y"),
        (1, "x", DAYS[0], DAYS[3], "N"),
        (2, "b", OPENED, high, "Y"),
        (3, "c", DAYS[0], DAYS[3], "N"),
    ]


def test_keys_without_one_history_stay_as_they_are(spark, join_path):
    start = scd2.open_versions(frame(spark, SCHEMA, (1, "a", 1), (1, "b", 1), (2, "c", 1), (3, "d", 1), (None, "e", 1)), OPENED)
    rows = [(1, "z", 1, DAYS[0]), (2, "y", 1, DAYS[0]), (2, "x", 1, DAYS[0]), (3, "w", 1, DAYS[0]), (None, "v", 1, DAYS[0])]
    extracts = frame(spark, SCHEMA + ", extract_day date", *rows)
    merged = history.merge_extracts(start, extracts, ["id"], ["city"], [DAYS[0]])
    kept = {(i, c) for i, c, flag in rows_of(merged, "id", "city", "act_in") if flag == "Y"}
    assert kept == {(1, "a"), (1, "b"), (2, "c"), (3, "w"), (None, "e")}
    assert rows_of(history.unmerged_rows(start, extracts, ["id"])).keys() == {r for r in rows if r[0] != 3}


def test_empty_sides(spark):
    start = scd2.open_versions(frame(spark, SCHEMA, (1, "a", 1)), OPENED)
    none = frame(spark, SCHEMA + ", extract_day date")
    assert rows_of(history.merge_extracts(start, none, ["id"], ["city"], [])) == rows_of(start)
    ended = history.merge_extracts(start, none, ["id"], ["city"], [DAYS[0]])
    assert [(r.end_dt, r.act_in) for r in ended.collect()] == [(DAYS[0], "N")]
    kept = history.merge_extracts(start, none, ["id"], ["city"], [DAYS[0]], missing="keep")
    assert rows_of(kept) == rows_of(start)
    opened = history.merge_extracts(start.limit(0), by_day(spark, {DAYS[0]: [(5, "q", 1)]}), ["id"], ["city"], [DAYS[0]])
    assert [(r.id, r.eff_dt, r.act_in) for r in opened.collect()] == [(5, DAYS[0], "Y")]
    with pytest.raises(ValueError, match="extracts must have"):
        history.merge_extracts(start, none.drop("rank"), ["id"], ["city"], DAYS)
    with pytest.raises(ValueError, match="missing"):
        history.merge_extracts(start, none, ["id"], ["city"], DAYS, missing="other")


def test_the_master_is_scanned_once_and_shuffled_once(spark, tmp_path):
    """However many the days: one scan of the versions to merge, one of those that ended before, which is not shuffled."""
    scd2.open_versions(frame(spark, SCHEMA, (1, "a", 1)), OPENED).write.parquet(f"{tmp_path}/dimension")
    many = [date(2024, 5, 1) + timedelta(days=i) for i in range(30)]
    by_day(spark, {d: [(1, "b", 1)] for d in many}).write.parquet(f"{tmp_path}/extracts")
    dimension, extracts = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("dimension", "extracts"))
    merged = history.merge_extracts(dimension, extracts, ["id"], ["city"], many, [OPENED], unique_keys=True)
    plan = plan_of(merged)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and sum("extract_day" in s for s in scans) == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_the_merge_sorts_once_and_counts_a_key_once(spark, tmp_path):
    """A task holds neither an entry per key and day nor several sorted copies of its rows."""
    spark.range(500).selectExpr("cast(id as int) as id", "'a' as city", "1 as rank").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    many = [date(2024, 5, 1) + timedelta(days=i) for i in range(70)]  # more than a word has bits
    extracts = rows.select("*", F.explode(F.array(*(F.lit(d) for d in many))).alias("extract_day"))
    twice = extracts.where((F.col("id") == 7) & (F.col("extract_day") == many[66]))
    merged = history.merge_extracts(scd2.open_versions(rows, OPENED), extracts.unionByName(twice), ["id"], ["city"], many, [OPENED])
    assert rows_of(merged.where("id = 7"), "eff_dt", "end_dt") == {(OPENED, date(9999, 12, 31)): 1}  # it has no one history
    assert merged.where("id <> 7 and eff_dt = '2024-01-01' and act_in = 'Y'").count() == merged.count() - 1 == 499
    plan = plan_of(merged).split("== Initial Plan ==")[-1]
    assert len(re.findall(r"(?<!Merge)Sort \[", plan)) == 1 and "SortAggregate" not in plan and "REPARTITION_BY_NUM" in plan
