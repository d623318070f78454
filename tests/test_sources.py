"""Delimited files, tables, the load log, streams."""

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom import workspace
from rowloom.plans import jobs
from rowloom.sources import delimited, jdbc, lake, tables
from rowloom.streaming import ingest as streaming
from tests.helpers import frame, plan_of, rows_of, same


# ---- delimited


def test_schema_from_metadata():
    fields = [
        {"fieldPosition": 2, "fieldName": "b", "fieldDataType": "DECIMAL", "fieldPrecision": 12, "fieldScale": 3},
        {"fieldPosition": 1, "fieldName": "a", "fieldDataType": "Integer", "fieldNullability": False},
        {"fieldPosition": 3, "fieldName": "c", "fieldDataType": "Date", "fieldDateFormat": "yyyy-MM-dd"},
    ]
    schema = delimited.schema_from_metadata(fields)
    assert schema.simpleString() == "struct<a:int,b:decimal(12,3),c:date>"
    assert not schema["a"].nullable and schema["c"].metadata == {"format": "yyyy-MM-dd"}
    with pytest.raises(ValueError, match="unknown type"):
        delimited.schema_from_metadata([{"fieldPosition": 1, "fieldName": "a", "fieldDataType": "Blob"}])


def test_load_schema(spark, tmp_path):
    spark_form = T.StructType().add("ID", "integer").add("CustName", "string").add("dob", "date")
    (tmp_path / "s.json").write_text(spark_form.json())
    assert delimited.load_schema(spark, str(tmp_path / "s.json")) == spark_form
    (tmp_path / "m.json").write_text('[{"fieldPosition": 1, "fieldName": "a", "fieldDataType": "Long"}]')
    assert delimited.load_schema(spark, str(tmp_path / "m.json")).simpleString() == "struct<a:bigint>"


def test_lines_that_do_not_fit_are_kept(spark, tmp_path):
    (tmp_path / "f.dat").write_text("1|x|2024-01-31\n2|y|31/01/2024\nz|y|2024-01-31\n4|y\n5|y|2024-02-01|more\n")
    schema = delimited.schema_from_metadata(
        [
            {"fieldPosition": 1, "fieldName": "a", "fieldDataType": "Integer"},
            {"fieldPosition": 2, "fieldName": "b", "fieldDataType": "String"},
            {"fieldPosition": 3, "fieldName": "c", "fieldDataType": "Date", "fieldDateFormat": "yyyy-MM-dd"},
        ]
    )
    rows = delimited.read_delimited(spark, str(tmp_path / "f.dat"), schema, sep="|")
    same(
        rows,
        [
            (1, "x", date(2024, 1, 31), None),
            (2, "y", None, "c=31/01/2024"),
            (None, "y", date(2024, 1, 31), "z|y|2024-01-31"),
            (4, "y", None, "4|y"),
            (5, "y", date(2024, 2, 1), "5|y|2024-02-01|more"),
        ],
    )
    # the check does not depend on the columns a query uses
    assert rows.select("a", delimited.CORRUPT).where(f"{delimited.CORRUPT} is not null").count() == 4
    assert jobs.unreadable_lines(rows).count() == 4


def test_header_and_plain_columns(spark, tmp_path):
    (tmp_path / "f.csv").write_text("FileName|Row_Count\nfirst.csv|10\nsecond.csv|17\n")
    named = delimited.read_delimited(spark, str(tmp_path / "f.csv"), sep="|", header=True)
    same(named.where("FileName = 'second.csv'"), [("second.csv", "17")])
    assert delimited.read_delimited(spark, str(tmp_path / "f.csv"), sep="|").columns == ["_c0", "_c1"]


def test_empty_text_and_null_survive_a_round_trip(spark, tmp_path):
    rows = frame(spark, "a string, b decimal(12,3), t timestamp_ntz", ("", Decimal("1.250"), None), (None, None, datetime(2024, 1, 2, 3)))
    delimited.write_delimited(rows, f"{tmp_path}/out", sep="|", null_value="\\N", timestamp_format="yyyy-MM-dd HH:mm:ss")
    back = delimited.read_delimited(spark, f"{tmp_path}/out", rows.schema, sep="|", null_value="\\N", check=False)
    assert rows_of(back) == rows_of(rows)
    assert "2024-01-02 03:00:00" in "".join(r.value for r in spark.read.text(f"{tmp_path}/out").collect())


def test_text_in_memory(spark):
    lines = delimited.text_lines(spark, "Name\nOne, two\nA second line.\nA third line.")
    parsed = delimited.parse_delimited_text(lines, T.StructType().add("Name", "string"), header="Name")
    assert jobs.unreadable_lines(parsed).count() == 1
    same(
        parsed,
        [("One", "One, two"), ("A second line.", None), ("A third line.", None)],
    )


def test_jdbc_needs_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        jdbc.read_jdbc(spark, {"url": "jdbc:none", "dbtable": "t"}, split_column="id")


# ---- tables


def test_untouched_partitions_survive(spark, tmp_path):
    rows = frame(spark, "p int, v int", (1, 1), (2, 2))
    tables.write_table(rows, f"{tmp_path}/t", partition_by=["p"])
    tables.write_table(frame(spark, "p int, v int", (2, 9)), f"{tmp_path}/t", ["p"], only_touched_partitions=True)
    same(spark.read.parquet(f"{tmp_path}/t"), [(1, 1), (9, 2)])


def test_catalog_lists(spark):
    assert ("spark_catalog",) in rows_of(tables.list_catalogs(spark))
    assert ("default", "spark_catalog") in rows_of(tables.list_namespaces(spark, "spark_catalog"))
    assert tables.list_tables(spark, "spark_catalog").columns[-1] == "catalog"


def test_describe(spark):
    frame(spark, "a int", (1,)).createOrReplaceTempView("described")
    assert rows_of(tables.describe_table(spark, "described"), "col_name", "data_type") == {("a", "int"): 1}


def test_shared_folder_is_the_configured_one(spark):
    assert workspace.shared_dir(spark) == workspace.shared_dir(spark)
    assert workspace.scratch_path(spark, "x") != workspace.scratch_path(spark, "x")
    assert workspace.scratch_path(spark, "x").startswith(workspace.shared_dir(spark))


class Session:
    """Stands in for a session with the given settings."""

    def __init__(self, master, configured=None):
        self.conf, self.sparkContext, self.master = {SETTING: configured}, self, master
        self.folder = None

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self.folder and f"file:{self.folder}/some-id"

    def setCheckpointDir(self, folder):
        self.folder = folder


SETTING = workspace.SETTING


def test_shared_folder_without_a_setting():
    assert workspace.shared_dir(Session("yarn", "hdfs://shared/folder/")) == "hdfs://shared/folder"
    with pytest.raises(RuntimeError, match=SETTING):
        workspace.shared_dir(Session("yarn"))
    local = Session("local[2]")
    folder = workspace.shared_dir(local)
    assert local.folder == folder and workspace.shared_dir(local) == f"file:{folder}"


# ---- load log

TIMES = [datetime(2025, 6, day) for day in range(1, 10)]


@pytest.fixture
def orders(spark):
    rows = [
        (31, "rope", date(2021, 9, 4)),
        (32, "anchor", date(2021, 9, 4)),
        (33, "lamp", None),
        (34, "rope", date(2022, 2, 28)),
        (35, None, date(2022, 3, 1)),
    ]
    df = frame(spark, "order_id int, Order_name string, Order_date date", *rows)
    return df.withColumn("partition_date", F.lit(date(2025, 6, 3)))


def test_loading_twice_leaves_the_rows_once(spark, orders, tmp_path):
    table = f"{tmp_path}/orders"
    assert not lake.table_exists(spark, table)
    assert [lake.load_partition(orders, table, "partition_date", t) for t in TIMES[:2]] == [1, 2]
    assert lake.table_exists(spark, table)
    assert rows_of(lake.read_as_of(spark, table)) == rows_of(orders)
    same(lake.list_snapshots(spark, table), [(1, "append", 5), (2, "replace", 5)], "load_id", "operation", "n_rows")
    same(lake.list_partitions(spark, table), [("2025-06-03", 1, 5)])


def test_a_load_touches_its_own_partitions(spark, orders, tmp_path):
    table = f"{tmp_path}/orders"
    lake.load_partition(orders, table, "partition_date", TIMES[0])
    other = orders.limit(2).withColumn("partition_date", F.lit(date(2025, 6, 4)))
    lake.load_partition(other, table, "partition_date", TIMES[1])
    lake.load_partition(other.limit(1), table, "partition_date", TIMES[2], mode="append")
    same(lake.list_partitions(spark, table), [("2025-06-03", 1, 5), ("2025-06-04", 2, 3)])
    lake.load_partition(other.limit(1), table, "partition_date", TIMES[3])
    same(lake.list_partitions(spark, table), [("2025-06-03", 1, 5), ("2025-06-04", 1, 1)])
    counts = [lake.read_as_of(spark, table, load_id=i).count() for i in (1, 2, 3, 4)]
    assert counts == [5, 7, 8, 6]
    assert [lake.read_as_of(spark, table, load_ts=t).count() for t in TIMES[:5]] == [5, 7, 8, 6, 6]
    assert lake.read_as_of(spark, table, partitions=[date(2025, 6, 4)]).count() == 1


def test_restore(spark, orders, tmp_path):
    table, day = f"{tmp_path}/orders", date(2025, 6, 3)
    lake.load_partition(orders, table, "partition_date", TIMES[0])
    lake.load_partition(orders.where("order_id = 31"), table, "partition_date", TIMES[1])
    lake.restore_partition(spark, table, "partition_date", day, 1, TIMES[2])
    assert rows_of(lake.read_as_of(spark, table)) == rows_of(orders)
    # a partition that did not exist then is emptied
    new_day = orders.withColumn("partition_date", F.lit(date(2025, 6, 9)))
    lake.load_partition(new_day, table, "partition_date", TIMES[3])
    assert lake.read_as_of(spark, table).count() == 10
    lake.restore_partition(spark, table, "partition_date", date(2025, 6, 9), 3, TIMES[4])
    assert rows_of(lake.read_as_of(spark, table)) == rows_of(orders)
    assert lake.list_partitions(spark, table).count() == 1


def test_update(spark, orders, tmp_path):
    table = f"{tmp_path}/orders"
    lake.load_partition(orders, table, "partition_date", TIMES[0])
    lake.load_partition(orders.withColumn("partition_date", F.lit(date(2025, 6, 4))), table, "partition_date", TIMES[1])
    condition = (F.col("order_id") == 32) & (F.col("partition_date") == date(2025, 6, 3))
    load_id = lake.update_rows(spark, table, "partition_date", condition, {"Order_name": F.lit("chain")}, TIMES[2])
    state = lake.read_as_of(spark, table)
    assert state.count() == 10
    same(state.where("Order_name = 'chain'"), [(32, date(2025, 6, 3))], "order_id", "partition_date")
    same(lake.list_snapshots(spark, table).where(F.col("load_id") == load_id), [(1, 5)], "n_partitions", "n_rows")
    with pytest.raises(ValueError, match="partition column"):
        lake.update_rows(spark, table, "partition_date", condition, {"partition_date": F.lit(None)}, TIMES[3])


def test_an_unlogged_load_is_invisible(spark, orders, tmp_path):
    table = f"{tmp_path}/orders"
    lake.load_partition(orders, table, "partition_date", TIMES[0])
    broken = orders.withColumn("slot", lake.slot_of(F.col("partition_date")))
    broken.write.partitionBy("slot").parquet(f"{table}/data/load_id=2")
    assert lake.read_as_of(spark, table).count() == 5
    assert lake.load_partition(orders.limit(1), table, "partition_date", TIMES[1]) == 2
    assert lake.read_as_of(spark, table).count() == 1


def test_text_partitions_keep_their_type(spark, tmp_path):
    table = f"{tmp_path}/codes"
    rows = frame(spark, "code string, v int", ("001", 1), ("1", 2), (None, 3), ("a/b=c", 4), ("null", 5))
    lake.load_partition(rows, table, "code", TIMES[0])
    lake.load_partition(frame(spark, "code string, v int", (None, 9)), table, "code", TIMES[1])
    same(lake.read_as_of(spark, table), [("001", 1), ("1", 2), (None, 9), ("a/b=c", 4), ("null", 5)])
    assert lake.list_partitions(spark, table).where("partition_value is null").count() == 1


def test_daily_partitions(spark, tmp_path):
    rows = frame(
        spark,
        "id int, created_at timestamp_ntz",
        (1, datetime(2023, 1, 15, 10)),
        (2, datetime(2023, 1, 16, 11, 30)),
        (3, datetime(2023, 1, 17, 14, 45)),
        (4, datetime(2023, 1, 17, 15)),
    )
    lake.load_partition(tables.daily_partition(rows, "created_at"), f"{tmp_path}/t", "partition_date", TIMES[0])
    assert lake.list_partitions(spark, f"{tmp_path}/t").count() == 3


@pytest.mark.parametrize("threshold", ["-1", "1000"])
def test_reading_prunes_folders_and_shuffles_nothing(spark, orders, tmp_path, threshold):
    table, key = f"{tmp_path}/orders", "spark.sql.autoBroadcastJoinThreshold"
    for t in TIMES[:3]:
        lake.load_partition(orders, table, "partition_date", t)
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        state = lake.read_as_of(spark, table)
        day = lake.read_as_of(
            spark, table, partition_by="partition_date", partitions_where=F.col("partition_date") == date(2025, 6, 3)
        )
        for rows in (state, day):
            plan = plan_of(rows)
            above_the_scan = plan[: plan.index("FileScan")]
            assert "Exchange hashpartitioning" not in above_the_scan and "SortMergeJoin" not in plan
            assert "dynamicpruning" in plan
            assert rows.count() == 5
        assert "slot" in plan_of(day).split("PartitionFilters: [")[1].split("]")[0]
    finally:
        spark.conf.set(key, before)


def test_columns_may_be_added_but_not_change_type(spark, orders, tmp_path):
    table = f"{tmp_path}/orders"
    assert lake.load_partition(orders.limit(0), table, "partition_date", TIMES[0]) == 1
    assert lake.read_as_of(spark, table).count() == 0
    assert lake.load_partition(orders, table, "partition_date", TIMES[1]) == 2
    with pytest.raises(ValueError, match="order_id: int to string"):
        lake.load_partition(orders.withColumn("order_id", F.lit("x")), table, "partition_date", TIMES[2])
    more = orders.limit(1).withColumn("colour", F.lit("red"))
    assert lake.load_partition(more, table, "partition_date", TIMES[2], mode="append") == 3
    assert lake.load_partition(more.limit(0), table, "partition_date", TIMES[3]) == 4
    assert lake.load_partition(more.drop("Order_name"), table, "partition_date", TIMES[4], mode="append") == 5
    now = lake.read_as_of(spark, table)
    assert now.where("colour = 'red'").count() == 2 and now.count() == 7
    assert lake.read_as_of(spark, table, load_id=2).columns == orders.columns
    assert [lake.read_as_of(spark, table, load_id=i).count() for i in range(1, 6)] == [0, 5, 6, 6, 7]


def test_update_of_chosen_partitions(spark, orders, tmp_path):
    table = f"{tmp_path}/orders"
    for day in (3, 4, 5):
        rows = orders.withColumn("partition_date", F.lit(date(2025, 6, day)))
        lake.load_partition(rows, table, "partition_date", TIMES[day])
    late = F.col("partition_date") > date(2025, 6, 3)
    load_id = lake.update_rows(
        spark, table, "partition_date", F.col("order_id") == 32, {"Order_name": F.lit("chain")}, TIMES[6], late
    )
    same(lake.list_snapshots(spark, table).where(F.col("load_id") == load_id), [(2, 10)], "n_partitions", "n_rows")
    assert lake.read_as_of(spark, table).where("Order_name = 'chain'").count() == 2


def test_scratch_goes_with_the_application(spark):
    rows = workspace.materialize(spark.range(5).toDF("n"))
    root = workspace.scratch_root(spark)
    assert rows.count() == 5 and os.path.isdir(root.removeprefix("file:"))
    workspace.clear_scratch(spark)
    assert not os.path.exists(root.removeprefix("file:"))


def test_jobs_leave_no_stage_folder(spark, tmp_path):
    schema = T.StructType().add("ID", "integer").add("v", "string")
    (tmp_path / "day0.csv").write_text("1,a\n2,b\n2,c\n")
    root = workspace.scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    jobs.cdc_full_load(spark, f"{tmp_path}/day0.csv", f"{tmp_path}/m0", schema, datetime(2022, 9, 17))
    jobs.cdc_delta_load(spark, f"{tmp_path}/day0.csv", f"{tmp_path}/m0", f"{tmp_path}/m1", schema, ["ID"], datetime(2022, 9, 18))
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before


# ---- streams


def test_stream_of_files(spark, tmp_path):
    messages = frame(spark, "key string, value string", ("1", "a"), ("2", None), (None, "c"))
    binary = messages.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    binary.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(binary.schema).parquet(f"{tmp_path}/in")
    decoded = streaming.decode_messages(stream)
    streaming.stream_ingest(decoded, f"{tmp_path}/c1", f"{tmp_path}/out").awaitTermination()
    assert rows_of(spark.read.parquet(f"{tmp_path}/out")) == rows_of(messages)
    # a restart from the checkpoint takes only what is new
    binary.limit(1).write.mode("append").parquet(f"{tmp_path}/in")
    streaming.stream_ingest(decoded, f"{tmp_path}/c1", f"{tmp_path}/out").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4
    streaming.stream_split(decoded, ["key", "value"], f"{tmp_path}/c2", f"{tmp_path}/split").awaitTermination()
    split = spark.read.parquet(f"{tmp_path}/split")
    complete = "key is not null and value is not null"
    assert split.where(f"(is_valid = 'true') <> ({complete})").isEmpty()
    assert split.count() == 4


def test_stream_in_intervals(spark, tmp_path):
    rows = spark.range(5).selectExpr("id")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    query = streaming.stream_ingest(stream, f"{tmp_path}/c", f"{tmp_path}/out", every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


# ---- jobs


def test_change_data_capture_through_files(spark, tmp_path):
    schema = T.StructType().add("ID", "integer").add("CustName", "string").add("dob", "date")
    (tmp_path / "day0.csv").write_text("1,a,2000-01-01\n2,b,2000-01-02\n3,c,2000-01-03\n")
    (tmp_path / "day1.csv").write_text("1,a,2000-01-01\n2,B,2000-01-02\n4,d,2000-01-04\n")
    day0, day1 = datetime(2022, 9, 17), datetime(2022, 9, 18)
    jobs.cdc_full_load(spark, f"{tmp_path}/day0.csv", f"{tmp_path}/m0", schema, day0)
    result = jobs.cdc_delta_load(spark, f"{tmp_path}/day1.csv", f"{tmp_path}/m0", f"{tmp_path}/m1", schema, ["ID"], day1)
    same(result.current, [(1, "a", day0), (2, "B", day1), (4, "d", day1)], "ID", "CustName", "eff_start_date")
    same(result.deleted, [(3, "c", date(2000, 1, 3))])
    again = jobs.cdc_delta_load(spark, f"{tmp_path}/day1.csv", f"{tmp_path}/m1", f"{tmp_path}/m2", schema, ["ID"], day1)
    assert rows_of(again.current) == rows_of(result.current)


def test_dimension_through_files(spark, tmp_path):
    from rowloom.operators.scd2 import open_versions

    rows = frame(spark, "k int, v string", (1, "a"), (2, "b"))
    open_versions(rows, date(2024, 1, 1)).write.parquet(f"{tmp_path}/d0")
    delta = frame(spark, "k int, v string", (1, "z"))
    jobs.dimension_load(spark, f"{tmp_path}/d0", delta, f"{tmp_path}/d1", ["k"], ["v"], date(2024, 12, 1))
    same(spark.read.parquet(f"{tmp_path}/d1"), [(1, "a", "N"), (1, "z", "Y"), (2, "b", "Y")], "k", "v", "act_in")
