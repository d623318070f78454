"""Masters, deltas, landing rows and loads derived from the driver tables.

The tables hold no changes, gaps or nulls, so rules on the keys make them. The moduli say
which rows change, leave, arrive or lose a value; every rule covers its whole table. New
keys are ``-key - 1``, which no table uses.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators.scd2 import open_versions

OPENED = date(2024, 1, 1)
FIRST_RUN = date(2024, 12, 1)
SECOND_RUN = date(2025, 3, 1)
STAMPED = datetime(2024, 1, 1)
MERGED = datetime(2024, 12, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def customer_delta(customers: DataFrame) -> DataFrame:
    """Changed and cleared segments, every tenth customer gone, some new ones."""
    segment = (
        F.when(every("c_custkey", 13), F.lit(None))
        .when(every("c_custkey", 7), "CHANGED")
        .otherwise(F.col("c_mktsegment"))
    )
    known = customers.where(~every("c_custkey", 10)).withColumn("c_mktsegment", segment)
    new = customers.where(every("c_custkey", 50)).withColumn("c_custkey", -F.col("c_custkey") - 1)
    return known.unionByName(new)


def customer_dimension(customers: DataFrame) -> DataFrame:
    """One open version per customer, and a closed one for every ninth."""
    current = open_versions(customers, OPENED)
    closed = customers.where(every("c_custkey", 9)).withColumns(
        {
            "c_mktsegment": F.lit("BEFORE"),
            "eff_dt": F.lit(date(2023, 1, 1)),
            "end_dt": F.lit(OPENED),
            "act_in": F.lit("N"),
        }
    )
    return current.unionByName(closed)


EXTRACT_DAYS = [date(2024, 6, 1) + timedelta(days=i) for i in range(30)]


def customer_extracts(customers: DataFrame) -> DataFrame:
    """Thirty daily extracts: each day some segments change, some customers are absent, and some are new."""
    numbered = F.explode(F.sequence(F.lit(0), F.lit(len(EXTRACT_DAYS) - 1))).alias("n")
    key, n = F.col("c_custkey"), F.col("n")
    segment = F.when((key + n) % 11 == 0, F.lit(None)).when((key * 7 + n) % 9 < 2, "CHANGED").otherwise(F.col("c_mktsegment"))
    daily = customers.select("*", numbered).withColumn("extract_day", F.date_add(F.lit(EXTRACT_DAYS[0]), n))
    known = daily.where((key * 3 + n) % 13 != 0).withColumn("c_mktsegment", segment)
    new = daily.where((key % 40 == 0) & (n % 4 != 1)).withColumn("c_custkey", -key - 1)
    return known.unionByName(new).drop("n")


def order_records(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


def order_delta(orders: DataFrame) -> DataFrame:
    """Changed status and price, cleared priority, every eleventh order gone, some new ones."""
    records = order_records(orders)
    known = records.where(~every("o_orderkey", 11)).withColumns(
        {
            "o_orderstatus": F.when(every("o_orderkey", 7), "X").otherwise(F.col("o_orderstatus")),
            "o_totalprice": F.when(every("o_orderkey", 17), F.col("o_totalprice") + 1).otherwise(
                F.col("o_totalprice")
            ),
            "o_orderpriority": F.when(~every("o_orderkey", 13), F.col("o_orderpriority")),
        }
    )
    new = records.where(every("o_orderkey", 40)).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return known.unionByName(new)


def order_texts(records: DataFrame) -> DataFrame:
    """Order records with the price as decimal, whose text is the same in every engine."""
    return records.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


def lineitem_delta(lineitems: DataFrame) -> DataFrame:
    """Line items, whose key is not unique: returns recoded, some orders gone, some new."""
    flag = F.when(every("l_partkey", 7), "X").otherwise(F.col("l_returnflag"))
    known = lineitems.where(~every("l_orderkey", 10)).withColumn("l_returnflag", flag)
    new = lineitems.where(every("l_orderkey", 25)).withColumn("l_orderkey", -F.col("l_orderkey") - 1)
    return known.unionByName(new)


def lineitem_records(lineitems: DataFrame) -> DataFrame:
    return lineitems.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")


def landing(orders: DataFrame, no_quantity: int, no_vendor: int) -> DataFrame:
    """Orders as landing rows with gaps in quantity and vendor."""
    return orders.select(
        F.col("o_orderkey").alias("Sale_ID"),
        F.col("o_custkey").alias("Product_ID"),
        F.when(~every("o_orderkey", no_quantity), F.col("o_custkey") % 50).alias("Quantity_Sold"),
        F.when(~every("o_orderkey", no_vendor), F.col("o_orderpriority")).alias("Vendor_ID"),
    )


def landing_today(orders: DataFrame) -> DataFrame:
    """The next day's landing rows: four out of five sales again, with other gaps and values."""
    return (
        landing(orders.where(~every("o_orderkey", 5)), 8, 7)
        .withColumn("Quantity_Sold", F.col("Quantity_Sold") + 100)
        .withColumn("Vendor_ID", F.concat(F.lit("today "), F.col("Vendor_ID")))
    )


def line_landing(lineitems: DataFrame, no_quantity: int, no_vendor: int) -> DataFrame:
    """Line items as landing rows: several rows share a sale."""
    return lineitems.select(
        F.col("l_orderkey").alias("Sale_ID"),
        F.col("l_partkey").alias("Product_ID"),
        F.when(~every("l_partkey", no_quantity), F.col("l_quantity")).alias("Quantity_Sold"),
        F.when(~every("l_partkey", no_vendor), F.col("l_suppkey").cast("string")).alias("Vendor_ID"),
    )


def products(parts: DataFrame) -> DataFrame:
    """Reference products: every fifth part is unknown, every eleventh is listed twice."""
    known = parts.where(~every("p_partkey", 5)).select(
        F.col("p_partkey").alias("Product_ID"),
        F.col("p_name").alias("Product_Name"),
        F.col("p_retailprice").alias("Product_Price"),
    )
    return known.unionByName(known.where(every("Product_ID", 11)))


def sales(lineitems: DataFrame) -> DataFrame:
    return lineitems.select(
        F.col("l_orderkey").alias("Sale_ID"),
        F.col("l_partkey").alias("Product_ID"),
        F.col("l_quantity").alias("Quantity_Sold"),
        F.lit(None).cast("double").alias("Sale_Amount"),
    )


def daily_events(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("event_date"))


def event_loads(events: DataFrame) -> list[tuple[str, DataFrame]]:
    """Three loads: all events; the even days again with other values; late events for every day."""
    rows = daily_events(events)
    corrected = rows.where(F.dayofmonth("event_date") % 2 == 0).withColumn("value", F.col("value") + 1000)
    late = rows.where(every("event_id", 5)).withColumn("event_id", -F.col("event_id") - 1)
    return [("replace", rows), ("replace", corrected), ("append", late)]
