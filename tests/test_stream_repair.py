"""Repair on a stream against the batch repair, landing by landing."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowloom.operators.ingest import repair_hold, split_valid_hold
from rowloom.streaming.ingest import stream_ingest
from rowloom.streaming.repair import still_held, stream_repair
from tests.helpers import frame, rows_of

SCHEMA = "id int, kind string, amount decimal(20,2), name string, day date, ratio double"
REQUIRED = ["amount", "name", "day", "ratio"]
FIRST = datetime(2024, 5, 1)


def landing(rng: random.Random, n: int) -> list[tuple]:
    pick = rng.choice
    return [
        (
            pick([1, 2, 3, 4, 5, 6, None]), pick("ab"), pick([None, Decimal("9.50"), Decimal("10.00"), Decimal("99999999999999999.25")]),
            pick([None, "x", "é"]), pick([None, date(2024, 1, 9), date(2024, 1, 10)]), pick([None, 2.0, 10.5]),
        )
        for _ in range(n)
    ]


class Landings:
    """A folder of landings and the stream that repairs them, one run for each."""

    def __init__(self, spark, path, **options):
        self.spark, self.path = spark, path
        schema = frame(spark, SCHEMA).withColumn("landed", F.current_timestamp()).schema
        stream = spark.readStream.schema(schema).parquet(f"{path}/in/*")
        self.repaired = stream_repair(stream, ["id", "kind"], REQUIRED, "landed", **options)

    def add(self, rows: list[tuple], day: int) -> None:
        landed = F.to_timestamp(F.lit(str(FIRST + timedelta(days=day))))
        frame(self.spark, SCHEMA, *rows).withColumn("landed", landed).write.parquet(f"{self.path}/in/{day}")
        stream_ingest(self.repaired, f"{self.path}/checkpoint", f"{self.path}/out").awaitTermination()

    def valid(self, day: int):
        rows = self.rows()
        return rows.where(F.col("is_valid") & (F.to_date("landed") == (FIRST + timedelta(days=day)).date()))

    def rows(self):
        return self.spark.read.schema(self.repaired.schema).parquet(f"{self.path}/out")


def test_landing_by_landing_as_the_batch_repair(spark, tmp_path):
    rng, columns = random.Random(11), [c.split()[0] for c in SCHEMA.split(", ")]
    landings, held = Landings(spark, tmp_path), None
    for day in range(3):
        rows = landing(rng, 14)
        landings.add(rows, day)
        today = frame(spark, SCHEMA, *rows)
        valid, hold = split_valid_hold(today, REQUIRED) if held is None else repair_hold(today, held, ["id", "kind"], REQUIRED)
        assert rows_of(landings.valid(day), *columns) == rows_of(valid)
        held = frame(spark, SCHEMA, *map(tuple, hold.collect()))
        assert rows_of(still_held(landings.rows(), ["id", "kind"], "landed"), *columns) == rows_of(held)


def test_values_are_forgotten_after_their_time(spark, tmp_path):
    landings = Landings(spark, tmp_path, keep="2 days", late="0 seconds")
    lacking = (1, "a", Decimal("1.00"), "x", None, 1.0)
    other = (9, "b", Decimal("1.00"), "x", date(2024, 1, 1), 1.0)
    landings.add([lacking, (2, "a", None, "x", date(2024, 1, 1), 1.0)], 0)
    landings.add([other, (2, "a", Decimal("7.00"), None, date(2024, 1, 1), 1.0)], 1)
    assert rows_of(landings.valid(1), "id", "amount", "name") == {(9, Decimal("1.00"), "x"): 1, (2, Decimal("7.00"), "x"): 1}
    landings.add([other], 5)
    landings.add([other], 6)
    landings.add([(1, "a", None, "y", date(2024, 2, 2), 1.0)], 7)  # what was known of the key is gone
    assert rows_of(landings.valid(7)) == {}


def test_types_that_cannot_pass(spark, tmp_path):
    frame(spark, "id int, v array<int>, at timestamp").write.parquet(f"{tmp_path}/a")
    stream = lambda schema: spark.readStream.schema(schema).parquet(f"{tmp_path}/a")
    with pytest.raises(TypeError, match="cannot"):
        stream_repair(stream("id int, v array<int>, at timestamp"), ["id"], ["v"], "at")
    with pytest.raises(TypeError, match="must be a timestamp"):
        stream_repair(stream("id int, v int, at timestamp_ntz"), ["id"], ["v"], "at")


def test_keys_of_one_bucket_are_forgotten_each_in_its_time(spark, tmp_path):
    landings = Landings(spark, tmp_path, keep="2 days", late="0 seconds", buckets=1)
    lacking = lambda key: (key, "a", Decimal("1.00"), "x", None, 1.0)
    other = (9, "b", Decimal("1.00"), "x", date(2024, 1, 1), 1.0)
    came = lambda key: (key, "a", None, "y", date(2024, 2, 2), 1.0)
    landings.add([lacking(1), lacking(2)], 0)
    landings.add([lacking(3), lacking(2)], 3)
    landings.add([other], 4)
    landings.add([came(1), came(2), came(3)], 5)  # the first landing's values are gone, where no other renewed them
    assert rows_of(landings.valid(5), "id", "amount", "name") == {(2, Decimal("1.00"), "y"): 1, (3, Decimal("1.00"), "y"): 1}


def test_many_keys_in_few_buckets(spark, tmp_path):
    """Keys are compared as the values they are, however many share a bucket."""
    numbers = spark.range(20_000)
    key = F.when(F.col("id") == 0, F.lit(-0.0)).otherwise(F.col("id").cast("double")).alias("k")
    at = lambda day: F.to_timestamp(F.lit(str(FIRST + timedelta(days=day)))).alias("landed")
    numbers.select(key, F.col("id").alias("v"), F.lit(None).cast("string").alias("w"), at(0)).write.parquet(f"{tmp_path}/in/0")
    second = numbers.select(F.col("id").cast("double").alias("k"), F.lit(None).cast("long").alias("v"), F.lit("w").alias("w"), at(1))
    schema = second.schema
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
    repaired = stream_repair(stream, ["k"], ["v", "w"], "landed", buckets=16)
    for n, rows in enumerate((None, second)):
        if rows is not None:
            rows.write.parquet(f"{tmp_path}/in/{n}")
        stream_ingest(repaired, f"{tmp_path}/checkpoint", f"{tmp_path}/out").awaitTermination()
    valid = spark.read.schema(repaired.schema).parquet(f"{tmp_path}/out").where("is_valid")
    assert valid.where("k = v and w = 'w'").count() == valid.count() == 20_000
