"""Classification, dimension merge and change data capture on small fixed inputs."""

import random
import re
from collections import Counter
from datetime import date, datetime

import pytest

from rowloom.operators import cdc, changes, joins, scd2
from rowloom.operators.joins import LEFT, RIGHT, pair_by_key
from tests.helpers import frame, plan_of, rows_of, same

RUN = date(2024, 12, 1)
UPPER = scd2.Versioning("EFF_DT", "END_DT", "ACT_IN")
STATUS = scd2.Versioning("start_date", "end_date", "status", "Active", "InActive")


@pytest.fixture
def cities(spark):
    """Ships and their home ports: one moves, two stay, one is new."""
    master = frame(
        spark,
        "ID int, NAME string, CITY string, EFF_DT string, END_DT string, ACT_IN string",
        (7, "Petrel", "Bergen", "2023-05-02", "9999-12-31", "Y"),
        (8, "Heron", "Porto", "2023-05-02", "9999-12-31", "Y"),
        (9, "Gannet", "Cork", "2024-02-20", "9999-12-31", "Y"),
    )
    delta = frame(
        spark,
        "ID int, NAME string, CITY string",
        (9, "Gannet", "Cork"),
        (8, "Heron", "Vigo"),
        (7, "Petrel", "Bergen"),
        (12, "Skua", "Leith"),
    )
    return master, delta


CITY_RESULT = [
    (7, "Petrel", "Bergen", "2023-05-02", "9999-12-31", "Y"),
    (8, "Heron", "Porto", "2023-05-02", "2024-12-01", "N"),
    (8, "Heron", "Vigo", "2024-12-01", "9999-12-31", "Y"),
    (9, "Gannet", "Cork", "2024-02-20", "9999-12-31", "Y"),
    (12, "Skua", "Leith", "2024-12-01", "9999-12-31", "Y"),
]


def test_dimension_with_one_key(cities, join_path):
    master, delta = cities
    merged = scd2.scd2_merge(master, delta, ["ID"], ["CITY"], RUN, audit=UPPER)
    assert merged.columns == master.columns
    assert merged.schema.simpleString() == master.schema.simpleString()
    same(merged, CITY_RESULT)


def test_replay_changes_nothing(cities, join_path):
    master, delta = cities
    merged = scd2.scd2_merge(master, delta, ["ID"], ["CITY"], RUN, audit=UPPER)
    again = scd2.scd2_merge(merged, delta, ["ID"], ["CITY"], date(2025, 1, 1), audit=UPPER)
    same(again, CITY_RESULT)


@pytest.fixture
def berths(spark):
    """Key of two columns: a berth known to both sides, one only to the master, one only to the delta."""
    master = frame(
        spark,
        "id int, name string, category string, start_date string, end_date string, status string",
        (40, "north", "deep", "2022-07-15", "9999-12-31", "Active"),
        (40, "south", "dry", "2022-07-15", "9999-12-31", "Active"),
    )
    delta = frame(spark, "id int, name string, category string", (40, "north", "deep"), (41, "north", "tidal"))
    return master, delta


@pytest.mark.parametrize(
    "missing, last",
    [("keep", ("9999-12-31", "Active")), ("expire", ("2024-12-01", "InActive"))],
)
def test_dimension_with_composite_key(berths, join_path, missing, last):
    merged = scd2.scd2_merge(*berths, ["id", "name"], ["category"], RUN, audit=STATUS, missing=missing)
    same(
        merged,
        [
            (40, "north", "deep", "2022-07-15", "9999-12-31", "Active"),
            (40, "south", "dry", "2022-07-15", *last),
            (41, "north", "tidal", "2024-12-01", "9999-12-31", "Active"),
        ],
    )


@pytest.mark.parametrize("missing", ["keep", "expire"])
def test_a_late_extract_leaves_newer_versions_alone(cities, join_path, missing):
    master, delta = cities
    late = date(2023, 12, 31)  # after the first two versions began, before the third
    merged = scd2.scd2_merge(master, delta.where("ID <> 9"), ["ID"], ["CITY"], late, audit=UPPER, missing=missing)
    same(merged.where("EFF_DT > END_DT"), [])
    same(merged.where("ID = 9"), [(9, "Gannet", "Cork", "2024-02-20", "9999-12-31", "Y")])
    moved = delta.selectExpr("ID", "NAME", "'Oban' as CITY")
    same(scd2.late_rows(master, moved, ["ID"], ["CITY"], late, UPPER), [(9, "Gannet", "Oban")])


def test_merge_checks_its_arguments(cities):
    master, delta = cities
    with pytest.raises(ValueError, match="missing"):
        scd2.scd2_merge(master, delta, ["ID"], ["CITY"], RUN, audit=UPPER, missing="drop")
    with pytest.raises(ValueError, match="columns"):
        scd2.scd2_merge(master, delta.drop("NAME"), ["ID"], ["CITY"], RUN, audit=UPPER)


@pytest.fixture
def cases(spark):
    schema = "id int, p string, q string"
    master = frame(spark, schema, (1, "a", "x"), (2, None, "x"), (3, "a", "x"), (4, "a", "x"))
    delta = frame(spark, schema, (1, "a", "y"), (2, None, None), (3, "a", "x"), (5, "b", "z"))
    return master, delta


def test_classes_and_control_total(cases, join_path):
    classified = changes.classify_changes(*cases, ["id"], ["p", "q"])
    same(classified, [(1, "U"), (2, "U"), (3, "C"), (4, "D"), (5, "N")], "id", "status")
    same(changes.change_summary(classified), [("U", 2), ("C", 1), ("D", 1), ("N", 1)])
    assert changes.control_total(*cases, ["id"], ["p", "q"]).first().asDict() == {
        "master_rows": 4,
        "delta_rows": 4,
        "common_rows": 1,
        "new_rows": 1,
        "updated_rows": 2,
        "deleted_rows": 1,
        "rejected_master_rows": 0,
        "rejected_delta_rows": 0,
        "balanced": True,
    }


def test_both_rows_are_kept(cases, join_path):
    classified = changes.classify_changes(*cases, ["id"], ["p", "q"])
    got = {r.id: (tuple(r.m) if r.m else None, tuple(r.d) if r.d else None) for r in classified.collect()}
    assert got[2] == ((2, None, "x"), (2, None, None))
    assert got[4] == ((4, "a", "x"), None)
    assert got[5] == (None, (5, "b", "z"))


@pytest.fixture
def dirty(spark):
    schema = "id int, p string"
    master = frame(spark, schema, (1, "a"), (1, "b"), (2, "a"), (None, "n"), (3, "a"), (3, "b"), (6, "a"))
    delta = frame(spark, schema, (1, "a"), (2, "a"), (2, "c"), (None, "n"), (4, "a"), (4, "a"), (5, "a"), (6, "z"))
    return master, delta


def test_every_row_is_in_one_class(dirty, join_path):
    classified = changes.classify_changes(*dirty, ["id"], ["p"])
    same(
        classified.selectExpr("id", "status", "m.p", "d.p"),
        [
            (1, "R", "a", None),
            (1, "R", "b", None),
            (1, "R", None, "a"),
            (2, "R", "a", None),
            (2, "R", None, "a"),
            (2, "R", None, "c"),
            (None, "R", "n", None),
            (None, "R", None, "n"),
            (3, "D", "a", None),
            (3, "D", "b", None),
            (4, "R", None, "a"),
            (4, "R", None, "a"),
            (5, "N", None, "a"),
            (6, "U", "a", "z"),
        ],
    )
    assert changes.control_total(*dirty, ["id"], ["p"]).first().balanced


def brute_force(master, delta):
    """Classes by definition: (key, status, old value, new value)."""
    n_master, n_delta = Counter(k for k, _ in master), Counter(k for k, _ in delta)
    expected = []
    for k, old in master:
        if k is None or n_delta[k] > 1 or (n_delta[k] and n_master[k] > 1):
            expected.append((k, "R", old, None))
        elif not n_delta[k]:
            expected.append((k, "D", old, None))
        else:
            new = next(v for key, v in delta if key == k)
            expected.append((k, "C" if old == new else "U", old, new))
    for k, new in delta:
        if k is None or n_delta[k] > 1 or n_master[k] > 1:
            expected.append((k, "R", None, new))
        elif not n_master[k]:
            expected.append((k, "N", None, new))
    return expected


@pytest.mark.parametrize("seed", range(3))
def test_classes_match_brute_force(spark, join_path, seed):
    rng = random.Random(seed)
    rows = lambda n: [(rng.choice([None, *range(30)]), rng.choice([None, "a", "b"])) for _ in range(n)]
    master, delta = rows(25), rows(35)
    schema = "k int, v string"
    classified = changes.classify_changes(frame(spark, schema, *master), frame(spark, schema, *delta), ["k"], ["v"])
    same(classified.selectExpr("k", "status", "m.v", "d.v"), brute_force(master, delta))


def test_rejected_rows_leave_the_dimension_alone(dirty, join_path):
    master, delta = dirty
    dimension = scd2.open_versions(master, date(2024, 1, 1))
    merged = scd2.scd2_merge(dimension, delta, ["id"], ["p"], RUN)
    untouched = [(1, "a", "Y"), (1, "b", "Y"), (2, "a", "Y"), (None, "n", "Y"), (3, "a", "Y"), (3, "b", "Y")]
    same(merged, [*untouched, (5, "a", "Y"), (6, "a", "N"), (6, "z", "Y")], "id", "p", "act_in")
    rejected = scd2.rejected_rows(dimension, delta, ["id"], audit=scd2.Versioning())
    assert rows_of(rejected.where("side = 'delta'"), "id", "p") == rows_of(delta.where("id is null or id in (1, 2, 4)"))


def test_a_hot_key_gives_the_same_pairs(spark, join_path):
    left = spark.range(300).selectExpr("if(id % 3 = 0, 7, id) as k", "id as v")
    right = spark.range(400).selectExpr("if(id % 4 = 0, 8, id) as k", "id as w")
    pairs = pair_by_key(left, right, ["k"])
    counts = {r.pairing: r["count"] for r in pairs.groupBy("pairing").count().collect()}
    matched = pair_by_key(left, right, ["k"], matched_only=True)
    n_left = {r.k: r["count"] for r in left.groupBy("k").count().collect()}
    n_right = {r.k: r["count"] for r in right.groupBy("k").count().collect()}
    both = [k for k in n_left if n_left[k] == 1 and n_right.get(k) == 1]
    assert counts["both"] == len(both) == matched.count()
    assert counts["left"] == sum(n for k, n in n_left.items() if k not in n_right)
    assert counts["right"] == sum(n for k, n in n_right.items() if k not in n_left)
    total = sum(n_left.values()) + sum(n_right.values())
    assert counts["ambiguous"] == total - counts["left"] - counts["right"] - 2 * len(both)
    same(matched.selectExpr("k", f"{LEFT}v", f"{RIGHT}w"), [(k, k, k) for k in both])


def test_repeated_keys_are_read_three_times_at_most(spark, tmp_path):
    spark.range(2000).selectExpr("id % 700 as k", "id as v", "string(id) as ballast").write.parquet(f"{tmp_path}/m")
    spark.range(2500).selectExpr("id % 900 as k", "id as v", "string(id) as ballast").write.parquet(f"{tmp_path}/d")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        master, delta = spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/d")
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("planning", "")
        classified = changes.classify_changes(master, delta, ["k"], ["v"])
        assert not jobs.getJobIdsForGroup("planning")  # building the plan runs nothing
        classified.collect()
        plan = plan_of(classified).split("== Initial Plan ==")[0]
    finally:
        spark.sparkContext.setJobGroup("", "")
        spark.conf.set(key, before)
    assert plan.count("FileScan") <= 3 * 2 and "Broadcast" not in plan
    # rows once to be paired; keys alone to be counted; rows and counts of repeated keys to be joined
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 4


def test_rows_are_shuffled_and_sorted_once(spark, tmp_path, monkeypatch):
    """Rows of a hot key, and those with a null key, are not shuffled at all; the pairs are those of the aggregate."""
    spark.range(3000).selectExpr("if(id % 9 = 0, 7, if(id % 50 = 1, null, id)) as k", "id % 5 as j", "id as v", "if(id % 7 = 0, null, 'l') as w").write.parquet(f"{tmp_path}/m")
    spark.range(4000).selectExpr("if(id % 8 = 0, 7, if(id % 60 = 1, null, id % 3500)) as k", "id % 5 as j", "id + 1 as v", "if(id % 3 = 0, null, 'r') as w").write.parquet(f"{tmp_path}/d")
    left, right = spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/d")
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        by_aggregate = [pair_by_key(left, right, ["k", "j"], matched_only=m).collect() for m in (False, True)]
        spark.conf.set(key, "4000")  # less than a side, more than a fiftieth of both
        in_order = [pair_by_key(left, right, ["k", "j"], matched_only=m) for m in (False, True)]
        assert [Counter(map(tuple, p.collect())) for p in in_order] == [Counter(map(tuple, p)) for p in by_aggregate]
        plan = plan_of(in_order[0]).split("== Initial Plan ==")[-1]
    finally:
        spark.conf.set(key, before)
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and len(re.findall(r" Sort \[", plan)) == 1
    assert sum("right__" in x or "left__" in x for x in plan.splitlines() if "Exchange hash" in x) <= 1
    assert {r.pairing for r in by_aggregate[0]} == {"both", "left", "right", "ambiguous"}


def test_unique_keys_take_one_join(spark, cases):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = plan_of(changes.classify_changes(*cases, ["id"], ["p", "q"], unique_keys=True))
    finally:
        spark.conf.set(key, before)
    assert plan.count("Join") == 1 and "FullOuter" in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_unused_columns_are_not_read(spark, tmp_path):
    wide = spark.range(100).selectExpr("id", "id as a", "id as b", "string(id) as ballast")
    wide.write.parquet(f"{tmp_path}/m")
    wide.write.parquet(f"{tmp_path}/d")
    master, delta = spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/d")
    summary = changes.change_summary(changes.classify_changes(master, delta, ["id"], ["a"]))
    assert "ballast" not in plan_of(summary)


def test_latest_version_combines_before_the_shuffle(spark):
    rows = frame(
        spark,
        "ID int, EFF_DT string, ACT_IN string, v int",
        (1, "2024-01-01", "N", 1),
        (1, "2024-02-01", "N", 2),
        (1, "2024-03-01", "Y", 3),
        (2, "2024-01-01", "Y", 4),
    )
    latest = scd2.latest_version(rows, ["ID", "ACT_IN"], "EFF_DT")
    same(latest, [(1, "2024-02-01", "N", 2), (1, "2024-03-01", "Y", 3), (2, "2024-01-01", "Y", 4)])
    plan = plan_of(latest)
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > 0  # below the shuffle too


def test_versions_valid_on_a_day(cities):
    master, delta = cities
    merged = scd2.scd2_merge(master, delta, ["ID"], ["CITY"], RUN, audit=UPPER)
    same(scd2.scd2_as_of(merged, date(2024, 1, 1), UPPER), [(7, "Bergen"), (8, "Porto")], "ID", "CITY")
    after = [(7, "Bergen"), (8, "Vigo"), (9, "Cork"), (12, "Leith")]
    same(scd2.scd2_as_of(merged, RUN, UPPER), after, "ID", "CITY")


def test_change_data_capture(cases, join_path):
    first, second = datetime(2024, 1, 1), datetime(2024, 12, 1)
    master, delta = cases
    result = cdc.cdc_merge(cdc.cdc_initial(master, first), delta, ["id"], ["p", "q"], second)
    high = datetime(9999, 12, 31, 23, 59)
    same(
        result.current,
        [
            (1, "a", "y", second, high),
            (2, None, None, second, high),
            (3, "a", "x", first, high),
            (5, "b", "z", second, high),
        ],
    )
    same(result.deleted, [(4, "a", "x")])
    assert result.rejected.isEmpty()


def test_cdc_keeps_what_it_cannot_decide(dirty, join_path):
    master, delta = dirty
    result = cdc.cdc_merge(cdc.cdc_initial(master, datetime(2024, 1, 1)), delta, ["id"], ["p"], datetime(2024, 12, 1))
    kept = [(1, "a"), (1, "b"), (2, "a"), (None, "n")]
    same(result.current, [*kept, (5, "a"), (6, "z")], "id", "p")
    same(result.deleted, [(3, "a"), (3, "b")])
    same(result.rejected, [(1, "a"), (2, "a"), (2, "c"), (None, "n"), (4, "a"), (4, "a")])
