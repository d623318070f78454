"""Files by header, hidden partitions, changes between loads, streams into loads, and pairs of repeated keys."""

import gzip
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions import transforms
from rowloom.operators import repeated
from rowloom.sources import delimited, lake, tables
from rowloom.streaming import ingest
from tests.helpers import frame, plan_of, rows_of, same

SCHEMA = T.StructType().add("id", "integer").add("name", "string").add("day", "date", True, {"format": "dd/MM/yyyy"})


def test_columns_come_by_the_name_in_each_header(spark, tmp_path):
    for name, text in {
        "a.csv": "id,name,day\n1,x,01/02/2024\n",
        "b.csv": "day,id,name,extra\n02/02/2024,2,y,z\nsoon,3,w,v\n",
        "c.csv": "﻿name,id\nq,4\nr,5,surplus\n",
        "d.csv": "",
        "e.csv": '"name","id"\n"a,b",six\n',
        "f.csv": "day,name,id\n",
    }.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "g.csv.gz").write_bytes(gzip.compress(b"id,day,name\n7,03/02/2024,zipped\n"))
    read = delimited.read_by_header(spark, str(tmp_path), SCHEMA)
    day = lambda n: date(2024, 2, n)
    same(
        read,
        [
            (1, "x", day(1), None), (2, "y", day(2), None), (3, "w", None, "day=soon"), (4, "q", None, None),
            (5, "r", None, "r,5,surplus"), (None, "a,b", None, '"a,b",six'), (7, "zipped", day(3), None),
        ],
        "id", "name", "day", delimited.CORRUPT,
    )
    plain = delimited.read_by_header(spark, str(tmp_path))
    assert set(plain.columns) == {"id", "name", "day", "extra"} and plain.count() == 7
    assert dict(rows_of(plain, "id", "extra"))[("2", "z")] == 1
    (tmp_path / "twice.csv").write_text("id,id\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        delimited.read_by_header(spark, str(tmp_path), SCHEMA)


def test_no_file_with_a_header(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert delimited.read_by_header(spark, str(tmp_path), SCHEMA).collect() == []
    assert delimited.read_by_header(spark, str(tmp_path), SCHEMA).columns == [*SCHEMA.names, delimited.CORRUPT]


def test_a_range_of_timestamps_prunes_days(spark, tmp_path):
    by_day, hour = transforms.days("ts"), "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id, 0, 0)"
    events = spark.range(240).select("id", F.expr(hour).alias("ts"))
    tables.write_table(by_day.added(events), f"{tmp_path}/t", partition_by=[by_day.partition])
    at = lambda d, h=0: datetime(2024, 1, d, h)
    for wanted, keep, folders in [
        (by_day.within(at(3, 5), at(5)), lambda t: at(3, 5) <= t < at(5), 3),
        (by_day.above(at(9, 1)) | by_day.at_most(at(1, 2)), lambda t: t > at(9, 1) or t <= at(1, 2), 3),
        (by_day.equal(at(4, 7)), lambda t: t == at(4, 7), 1),
    ]:
        read = tables.read_where(spark, f"{tmp_path}/t", wanted)
        assert {r.ts for r in read.collect()} == {r.ts for r in events.collect() if keep(r.ts)}
        scan = next(line for line in plan_of(read).splitlines() if "FileScan" in line)
        assert "partition_date" in scan.split("PartitionFilters")[1]
        assert spark.read.parquet(f"{tmp_path}/t").where(wanted.partitions).select(by_day.partition).distinct().count() <= folders
    monthly, stepped = transforms.months("ts"), transforms.steps("id", 50)
    rows = stepped.added(monthly.added(events))
    assert rows.where(stepped.below(60).partitions & monthly.at_least(at(2)).partitions).count() == 100


def test_changes_between_loads_read_other_folders_only(spark, tmp_path):
    table, at = f"{tmp_path}/t", lambda n: datetime(2024, 1, n)
    first = frame(spark, "day string, v int", ("a", 1), ("a", 1), ("b", 2), (None, 3))
    lake.load_partition(first, table, "day", at(1))
    lake.load_partition(frame(spark, "day string, v int", ("b", 2), ("b", 5)), table, "day", at(2))
    lake.load_partition(frame(spark, "day string, v int, w string", ("a", 1, None), ("a", 9, "n")), table, "day", at(3), mode="append")
    changed = lambda a, b: sorted(tuple(map(str, r)) for r in lake.changes_between(spark, table, a, b).collect())
    assert changed(1, 2) == [("b", "5", "added", "1")]
    assert changed(1, 3) == [("a", "1", "None", "added", "1"), ("a", "9", "n", "added", "1"), ("b", "5", "None", "added", "1")]
    assert changed(3, 1) == [(*r[:3], "removed", "1") for r in changed(1, 3)]
    assert changed(2, 2) == [] and len(changed(0, 1)) == 3
    lake.restore_partition(spark, table, "day", "b", 1, at(4))
    assert [r for r in changed(1, 4) if r[0] == "b"] == []
    files = lake.changes_between(spark, table, 2, 3)._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in files.toString() or "DynamicPruning" in files.toString()


def test_a_repeated_batch_loads_once(spark, tmp_path):
    """The stream ends after a load and before its checkpoint, twice; then before a load."""
    rows = spark.range(60).select("id", (F.col("id") % 3).cast("string").alias("day"))
    rows.repartition(4).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id long, day string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    seen = []

    def run(fail_at=None):
        def after(batch_id, load):
            seen.append((batch_id, load.load_id))
            if batch_id == fail_at:
                raise InterruptedError

        query = ingest.stream_load(
            stream, f"{tmp_path}/t", "day", f"{tmp_path}/checkpoint", lambda n: datetime(2024, 1, 1 + n), "in", after_load=after
        )
        query.awaitTermination()

    for fail_at in (0, 2):
        with pytest.raises(StreamingQueryException):
            run(fail_at)
    run()
    same(lake.read_as_of(spark, f"{tmp_path}/t"), [tuple(r) for r in rows.collect()], "id", "day")
    assert seen == [(0, 1), (0, 1), (1, 2), (2, 3), (2, 3), (3, 4)]
    loads = [r.n_rows for r in lake.list_snapshots(spark, f"{tmp_path}/t").collect()]
    assert len(loads) == 4 and sum(loads) == 60


def test_rows_of_repeated_keys_pair_one_to_one(spark):
    left = frame(spark, "k int, a string, b int", (1, "x", 1), (1, "x", 1), (1, "y", 2), (2, "z", 3), (None, "n", 0), (3, "s", None))
    right = frame(spark, "k int, a string, b int", (1, "x", 1), (1, "x", 9), (1, "y", 2), (2, "z", 3), (2, "q", 4), (None, "n", 1), (3, "s", None))
    found = repeated.reconcile_repeated(left, right, ["k"], ["a", "b"])
    assert rows_of(found) == Counter([(1, 1, "both", "b", "1", "9"), (2, 1, "right_only", None, None, "q,4")])


def test_a_hot_key_is_not_paired_in_one_task(spark):
    left = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    right = left.withColumn("a", F.col("a") + 4000)
    pairs = repeated.pair_repeated(left, right, ["k"], ["a"])
    assert pairs.where("right__a - left__a = 4000 and pair = left__a + 1").count() == 4000
    assert "hashpartitioning(k#" not in "".join(x for x in plan_of(pairs).splitlines() if "Exchange" in x and "pair" not in x and "of_left" not in x)
