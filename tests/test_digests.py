"""Digest reconciliation and counts of writes against the plain operators."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from rowloom.operators import changes, counts, digests, recon
from rowloom.sources import lake
from tests.helpers import frame, plan_of, rows_of

SCHEMA = "k int, a string, b double, c decimal(10,2)"


def random_rows(rng, n):
    pick = rng.choice
    return [(pick([1, 2, 3, 40, None]), pick(["x", "", None]), pick([0.5, None, float("inf")]), None) for _ in range(n)]


def test_same_result_as_comparing_rows(spark, join_path, monkeypatch):
    rng = random.Random(1)
    for listed in (0, 1000):
        monkeypatch.setattr(digests, "LISTED", listed)
        rows = random_rows(rng, 60)
        left, right = frame(spark, SCHEMA, *rows), frame(spark, SCHEMA, *rows[5:], *random_rows(rng, 5), *rows[:2])
        for on in ([], ["k"], ["a", "k"]):
            found = digests.reconcile_rows_by_digest(left, right, on)
            assert rows_of(found) == rows_of(recon.reconcile_rows(left, right))
            assert found.columns == recon.reconcile_rows(left, right).columns


def test_order_repeats_and_places_of_nulls(spark):
    left = frame(spark, "a string, b string", ("x", None), ("x", None), ("y", "z"))
    assert rows_of(digests.reconcile_rows_by_digest(left, frame(spark, "a string, b string", ("y", "z"), ("x", None), ("x", None)))) == {}
    swapped = frame(spark, "a string, b string", (None, "x"), (None, "x"), ("y", "z"))
    assert sum(rows_of(digests.reconcile_rows_by_digest(left, swapped)).values()) == 2
    once = frame(spark, "a string, b string", ("x", None), ("y", "z"))  # as in ``reconcile_rows``, repeats are one row
    schema = digests.common_types(left, once)
    assert digests.differing_buckets(digests.digests(left, schema), digests.digests(once, schema))
    assert rows_of(digests.reconcile_rows_by_digest(left, once)) == {}


def test_types_are_made_common(spark):
    ints, longs = frame(spark, "k int, v float", (1, 0.5)), frame(spark, "v double, k long", (0.5, 1))
    assert digests.reconcile_rows_by_digest(ints, longs).isEmpty()
    assert digests.reconcile_rows_by_digest(ints.limit(0), longs.limit(0)).isEmpty()


def test_equal_tables_shuffle_digests_only(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("a")).write.parquet(f"{tmp_path}/t")
    side = spark.read.parquet(f"{tmp_path}/t")
    plan = plan_of(digests.digests(side, side.schema))
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(bucket")  # below it
    assert "FileScan" not in plan_of(digests.reconcile_rows_by_digest(side, side))


def test_only_folders_that_differ_are_read(spark, tmp_path):
    rows = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    changed = rows.where("k <> 5").withColumn("v", F.when(F.col("k") == 9, 100).otherwise(F.col("v")))
    one, two = digests.write_digested(rows, f"{tmp_path}/one", ["k"]), digests.write_digested(changed, f"{tmp_path}/two", ["k"])
    found = digests.reconcile_digested(spark, one, two, ["k"])
    assert rows_of(found) == rows_of(recon.reconcile_rows(rows, changed))
    listing = [line for line in found._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in line]
    assert listing and all("digest_part" in line for line in listing)
    folders = {r.f for r in one.rows(spark, sorted({b >> (digests.BITS - digests.RANGE_BITS) for b in digests.differing_buckets(one.digests(spark), two.digests(spark))})).select(F.input_file_name().alias("f")).collect()}
    assert 0 < len(folders) <= 2
    assert digests.reconcile_digested(spark, one, digests.write_digested(rows, f"{tmp_path}/three", ["k"]), ["k"]).isEmpty()


def test_control_totals_come_from_the_write(spark, tmp_path, join_path):
    master = frame(spark, "id int, v string", (1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e"), (7, "q"))
    delta = frame(spark, "id int, v string", (1, "a"), (2, "b"), (3, "x"), (4, "y"), (4, "z"), (5, "n"))
    counted = counts.counting_changes(changes.classify_changes(master, delta, ["id"], ["v"]))
    counted.rows.write.parquet(f"{tmp_path}/classified")
    plain = changes.control_total(master, delta, ["id"], ["v"]).first().asDict()
    assert plain.pop("balanced")
    assert counted.totals() == plain | {"n_rows": spark.read.parquet(f"{tmp_path}/classified").count()}


def test_load_counts_come_from_the_write(spark, tmp_path):
    rows = frame(spark, "day string, v int", ("a", 1), ("a", 2), ("b", 5))
    table, at = f"{tmp_path}/table", datetime(2024, 1, 1)
    totals = {"v": F.sum("v"), "large": F.count_if(F.col("v") > 1)}
    assert lake.load_counted(rows, table, "day", at, totals=totals) == (1, {"n_rows": 3, "v": 8, "large": 2})
    assert lake.load_counted(rows.limit(0), table, "day", at) == (2, {"n_rows": 0})
    assert lake.load_counted(rows.where("v > 100"), table, "day", at, emptied=["a"]) == (3, {"n_rows": 0})
    assert rows_of(lake.read_as_of(spark, table)) == {("b", 5): 1} or rows_of(lake.read_as_of(spark, table), "v") == {(5,): 1}
    assert [r.n_rows for r in lake.list_snapshots(spark, table).orderBy("load_id").collect()] == [3, 0, 0]
    by_value = counts.counting_by(rows, "day", {"of_a": "a", "of_none": None})
    by_value.rows.write.parquet(f"{tmp_path}/counted")
    assert by_value.totals() == {"n_rows": 3, "of_a": 2, "of_none": 0}
