"""One query per operator over the driver tables. ``oracles`` holds the same in SQL."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom import workspace
from rowloom.functions import transforms
from rowloom.operators import cdc, changes, cleanse, counts, digests, history, ingest, recon, repeated, scd2
from rowloom.plans import jobs
from rowloom.plans import testbed as tb
from rowloom.sources import delimited, lake, tables
from rowloom.streaming import ingest as streaming
from rowloom.streaming import repair as stream_repairs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates, times and whole numbers that may be null as text, so that every client shows them alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# ---- changes

CUSTOMER_KEY, SEGMENT = ["c_custkey"], ["c_mktsegment"]
ORDER_KEY = ["o_orderkey"]
ORDER_COMPARE = ["o_orderstatus", "o_orderpriority", "o_totalprice"]
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_COMPARE = ["l_returnflag"]


@query
def classify_changes(spark, sf_dir):
    master = tb.table(spark, sf_dir, "customer")
    classified = changes.classify_changes(master, tb.customer_delta(master), CUSTOMER_KEY, SEGMENT)
    return classified.select(
        "c_custkey",
        "status",
        F.col("m.c_mktsegment").alias("old_segment"),
        F.col("d.c_mktsegment").alias("new_segment"),
    )


@query
def classify_orders(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders")
    master, delta = tb.order_records(orders), tb.order_delta(orders)
    classified = changes.classify_changes(master, delta, ORDER_KEY, ORDER_COMPARE)
    return classified.select(
        "o_orderkey",
        "status",
        F.col("m.o_orderstatus").alias("old_status"),
        F.col("d.o_orderstatus").alias("new_status"),
        F.col("m.o_totalprice").alias("old_price"),
        F.col("d.o_totalprice").alias("new_price"),
    )


@query
def classify_repeated_keys(spark, sf_dir):
    lines = tb.table(spark, sf_dir, "lineitem")
    master, delta = tb.lineitem_records(lines), tb.lineitem_records(tb.lineitem_delta(lines))
    classified = changes.classify_changes(master, delta, LINE_KEY, LINE_COMPARE)
    return classified.select(
        *LINE_KEY,
        "status",
        F.col("m.l_partkey").cast("string").alias("old_part"),
        F.col("d.l_partkey").cast("string").alias("new_part"),
    )


@query
def rejected_rows(spark, sf_dir):
    lines = tb.table(spark, sf_dir, "lineitem")
    master, delta = tb.lineitem_records(lines), tb.lineitem_records(tb.lineitem_delta(lines))
    return scd2.rejected_rows(master, delta, LINE_KEY)


@query
def change_summary(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders")
    classified = changes.classify_changes(
        tb.order_records(orders), tb.order_delta(orders), ORDER_KEY, ORDER_COMPARE
    )
    return changes.change_summary(classified)


@query
def control_total(spark, sf_dir):
    lines = tb.table(spark, sf_dir, "lineitem")
    return changes.control_total(lines, tb.lineitem_delta(lines), LINE_KEY, LINE_COMPARE)


@query
def control_total_written(spark, sf_dir):
    """The control total that the write of the classified rows counts."""
    lines = tb.table(spark, sf_dir, "lineitem")
    counted = counts.counting_changes(changes.classify_changes(lines, tb.lineitem_delta(lines), LINE_KEY, LINE_COMPARE))
    counted.rows.write.parquet(workspace.scratch_path(spark, "classified"))
    return _counted(spark, [counted.totals()])


def _counted(spark, totals: list[dict[str, int]]) -> DataFrame:
    return spark.createDataFrame([tuple(t.values()) for t in totals], ", ".join(f"{name} long" for name in totals[0]))


# ---- dimensions


def _first_merge(spark, sf_dir, **options) -> DataFrame:
    customers = tb.table(spark, sf_dir, "customer")
    options = {"keys": CUSTOMER_KEY, "compare": SEGMENT} | options
    return scd2.scd2_merge(
        tb.customer_dimension(customers), tb.customer_delta(customers), run_date=tb.FIRST_RUN, **options
    )


def _merge_again(spark, sf_dir, delta: DataFrame) -> DataFrame:
    """A second merge on the written result of the first, whose open versions have unique keys."""
    dimension = workspace.materialize(_first_merge(spark, sf_dir, unique_keys=True))
    return scd2.scd2_merge(dimension, delta, CUSTOMER_KEY, SEGMENT, tb.SECOND_RUN, unique_keys=True)


def _second_merge(spark, sf_dir) -> DataFrame:
    return _merge_again(spark, sf_dir, tb.table(spark, sf_dir, "customer"))


def _dated(df: DataFrame) -> DataFrame:
    return _text(df, "eff_dt", "end_dt")


@query
def scd2_single(spark, sf_dir):
    return _dated(_first_merge(spark, sf_dir))


@query
def scd2_composite(spark, sf_dir):
    keys = ["c_custkey", "c_name"]
    return _dated(
        _first_merge(spark, sf_dir, keys=keys, compare=["c_nationkey", "c_acctbal", "c_mktsegment"], missing="expire")
    )


@query
def scd2_replay(spark, sf_dir):
    return _dated(_merge_again(spark, sf_dir, tb.customer_delta(tb.table(spark, sf_dir, "customer"))))


@query
def scd2_second_load(spark, sf_dir):
    return _dated(_second_merge(spark, sf_dir))


@query
def scd2_late_extract(spark, sf_dir):
    """Versions of even customers start after the run date; the extract is older than they are."""
    customers = tb.table(spark, sf_dir, "customer")
    started = F.when(tb.every("c_custkey", 2), F.lit(tb.SECOND_RUN)).otherwise(F.col("eff_dt"))
    dimension = scd2.open_versions(customers, tb.OPENED).withColumn("eff_dt", started)
    return _dated(
        scd2.scd2_merge(
            dimension, tb.customer_delta(customers), CUSTOMER_KEY, SEGMENT, tb.FIRST_RUN, missing="expire"
        )
    )


@query
def scd2_repeated_keys(spark, sf_dir):
    lines = tb.table(spark, sf_dir, "lineitem")
    master = scd2.open_versions(tb.lineitem_records(lines), tb.OPENED)
    delta = tb.lineitem_records(tb.lineitem_delta(lines))
    return _dated(scd2.scd2_merge(master, delta, LINE_KEY, LINE_COMPARE, tb.FIRST_RUN))


@query
def latest_version(spark, sf_dir):
    return _dated(scd2.latest_version(_second_merge(spark, sf_dir), ["c_custkey", "act_in"], "eff_dt", ["end_dt"]))


@query
def scd2_as_of(spark, sf_dir):
    return _dated(scd2.scd2_as_of(_second_merge(spark, sf_dir), tb.FIRST_RUN))


@query
def scd2_history_insert(spark, sf_dir):
    """The extracts of two days, the later one first; the earlier one is a late extract of another day as well."""
    customers = tb.table(spark, sf_dir, "customer")
    dimension, known = scd2.open_versions(customers, tb.OPENED), [tb.OPENED]
    later = customers.withColumn("c_mktsegment", F.when(~tb.every("c_custkey", 7), F.col("c_mktsegment")).otherwise("LATER"))
    for day, rows in ((tb.SECOND_RUN, later), (tb.FIRST_RUN, tb.customer_delta(customers))):
        extract = rows.withColumn(history.DAY, F.lit(day))
        dimension = workspace.materialize(
            history.merge_extracts(dimension, extract, CUSTOMER_KEY, SEGMENT, [day], known)
        )
        known.append(day)
    return _dated(dimension)


@query
def scd2_many_extracts(spark, sf_dir):
    """Thirty daily extracts in one plan."""
    customers = tb.table(spark, sf_dir, "customer")
    return _dated(
        history.merge_extracts(
            tb.customer_dimension(customers), tb.customer_extracts(customers), CUSTOMER_KEY, SEGMENT, tb.EXTRACT_DAYS, [tb.OPENED]
        )
    )


# ---- change data capture


def _cdc_master(orders: DataFrame) -> DataFrame:
    return cdc.cdc_initial(tb.order_records(orders), tb.STAMPED)


def _cdc_merge(spark, sf_dir) -> cdc.CdcResult:
    orders = tb.table(spark, sf_dir, "orders")
    return cdc.cdc_merge(_cdc_master(orders), tb.order_delta(orders), ORDER_KEY, ORDER_COMPARE, tb.MERGED)


@query
def cdc_initial(spark, sf_dir):
    return _text(_cdc_master(tb.table(spark, sf_dir, "orders")), *cdc.STAMPS)


@query
def cdc_merge(spark, sf_dir):
    return _text(_cdc_merge(spark, sf_dir).current, *cdc.STAMPS)


@query
def cdc_deleted(spark, sf_dir):
    return _cdc_merge(spark, sf_dir).deleted


@query
def cdc_outcome(spark, sf_dir):
    lines = tb.table(spark, sf_dir, "lineitem")
    master = cdc.cdc_initial(tb.lineitem_records(lines), tb.STAMPED)
    delta = tb.lineitem_records(tb.lineitem_delta(lines))
    return _text(cdc.cdc_outcome(master, delta, LINE_KEY, LINE_COMPARE, tb.MERGED), *cdc.STAMPS)


CDC_SCHEMA = T.StructType().add("o_orderkey", "long").add("o_orderstatus", "string").add("o_orderdate", "date")


def _extract_lines(orders: DataFrame, day: str) -> DataFrame:
    """Order extracts as lines. On the second day some dates cannot be read and some lines are too long."""
    key = F.col("o_orderkey").cast("string")
    date_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    if day == "first":
        return orders.select(F.concat_ws(",", key, "o_orderstatus", date_text).alias("value"))
    status = F.when(tb.every("o_orderkey", 7), "X").otherwise(F.col("o_orderstatus"))
    wrong = F.when(tb.every("o_orderkey", 5), "2020-13-01").otherwise(date_text)
    surplus = F.when(tb.every("o_orderkey", 6), "more")
    return orders.where(~tb.every("o_orderkey", 11)).select(F.concat_ws(",", key, status, wrong, surplus).alias("value"))


def _captured(spark, sf_dir, *days: str) -> DataFrame:
    """Captured extracts one after the other; the last outcome. ``empty`` is an extract without lines."""
    orders, folder = tb.table(spark, sf_dir, "orders"), workspace.scratch_path(spark, "capture")
    for n, day in enumerate(days):
        lines = _extract_lines(orders, "first" if day == "empty" else day)
        (lines.limit(0) if day == "empty" else lines).write.text(f"{folder}/extract{n}")
        extract, target = f"{folder}/extract{n}", f"{folder}/master{n}"
        if n == 0:
            jobs.cdc_full_load(spark, extract, target, CDC_SCHEMA, tb.STAMPED)
        else:
            master = f"{folder}/master{n - 1}"
            jobs.cdc_delta_load(spark, extract, master, target, CDC_SCHEMA, ORDER_KEY, tb.MERGED)
    written = jobs.read_outcome(spark, f"{folder}/master{len(days) - 1}", CDC_SCHEMA)
    return _text(written.withColumnRenamed(delimited.CORRUPT, "problem"), "o_orderkey", "o_orderdate", *cdc.STAMPS)


@query
def cdc_malformed_extract(spark, sf_dir):
    return _captured(spark, sf_dir, "first", "second")


@query
def cdc_after_empty_extract(spark, sf_dir):
    """An empty extract empties the master; the next one fills it again."""
    return _captured(spark, sf_dir, "first", "empty", "first")


# ---- reconciliation


def _order_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    orders = tb.table(spark, sf_dir, "orders")
    return tb.order_texts(tb.order_records(orders)), tb.order_texts(tb.order_delta(orders))


@query
def reconcile_presence(spark, sf_dir):
    left, right = (side.drop("o_totalprice") for side in _order_sides(spark, sf_dir))
    return recon.reconcile_presence(left, right, ORDER_KEY)


@query
def reconcile_presence_repeated(spark, sf_dir):
    lines = tb.table(spark, sf_dir, "lineitem")
    return recon.reconcile_presence(
        tb.lineitem_records(lines), tb.lineitem_records(tb.lineitem_delta(lines)), LINE_KEY
    )


@query
def reconcile_wide(spark, sf_dir):
    left, right = _order_sides(spark, sf_dir)
    return recon.reconcile_wide(left, right, ORDER_KEY, ORDER_COMPARE)


@query
def reconcile_long(spark, sf_dir):
    left, right = _order_sides(spark, sf_dir)
    return recon.reconcile_long(left, right, ORDER_KEY, ORDER_COMPARE)


@query
def reconcile_long_active(spark, sf_dir):
    left, right = _order_sides(spark, sf_dir)
    flag = F.when(F.col("o_custkey") % 3 == 0, "N").otherwise("Y")
    left, right = (recon.active_rows(side.withColumn("active_in", flag), "active_in") for side in (left, right))
    return recon.reconcile_long(left, right, ["o_orderkey", "o_custkey"], ["o_orderstatus", "o_orderpriority"])


@query
def missing_rows(spark, sf_dir):
    lines = tb.table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_returnflag", "l_linestatus"]
    return recon.missing_rows(lines.select(columns), tb.lineitem_delta(lines).select(columns))


@query
def reconcile_rows(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders")
    return recon.reconcile_rows(tb.order_records(orders), tb.order_delta(orders))


@query
def reconcile_rows_by_digest(spark, sf_dir):
    lines = tb.lineitem_records(tb.table(spark, sf_dir, "lineitem"))
    quantity = F.when(tb.every("l_orderkey", 50), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return digests.reconcile_rows_by_digest(lines, lines.withColumn("l_quantity", quantity), ["l_orderkey"])


@query
def reconcile_digested(spark, sf_dir):
    """Two written tables; only folders in which their digests differ are read."""
    folder, orders = workspace.scratch_path(spark, "digested"), tb.order_records(tb.table(spark, sf_dir, "orders"))
    status = F.when(tb.every("o_orderkey", 97), "X").otherwise(F.col("o_orderstatus"))
    one = digests.write_digested(orders, f"{folder}/one", ORDER_KEY)
    two = digests.write_digested(orders.withColumn("o_orderstatus", status), f"{folder}/two", ORDER_KEY)
    return digests.reconcile_digested(spark, one, two, ORDER_KEY)


@query
def reconcile_repeated(spark, sf_dir):
    """Line items by order: rows of an order are paired after equal ones cancel."""
    lines = tb.table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_partkey", "l_returnflag", "l_shipmode"]
    columns = [c for c in columns if c in lines.columns]
    left, right = lines.select(columns), tb.lineitem_delta(lines).where(~tb.every("l_partkey", 15)).select(columns)
    return _text(repeated.reconcile_repeated(left, right, ["l_orderkey"], ["l_partkey", "l_returnflag"]), "pair")


@query
def rows_without_equal(spark, sf_dir):
    lines = tb.table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_returnflag", "l_linestatus"]
    return recon.rows_without_equal(lines.select(columns), tb.lineitem_delta(lines).select(columns))


# ---- daily ingestion

SALE_KEY, REQUIRED = ["Sale_ID"], ["Quantity_Sold", "Vendor_ID"]


def _day_one(spark, sf_dir) -> ingest.ValidHold:
    return ingest.split_valid_hold(tb.landing(tb.table(spark, sf_dir, "orders"), 4, 6), REQUIRED)


def _day_two(spark, sf_dir) -> ingest.ValidHold:
    today = tb.landing_today(tb.table(spark, sf_dir, "orders"))
    return ingest.repair_hold(today, _day_one(spark, sf_dir).hold, SALE_KEY, REQUIRED)


@query
def split_valid(spark, sf_dir):
    return _day_one(spark, sf_dir).valid


@query
def split_hold(spark, sf_dir):
    return _text(_day_one(spark, sf_dir).hold, "Quantity_Sold")


@query
def repair_valid(spark, sf_dir):
    return _day_two(spark, sf_dir).valid


@query
def repair_hold(spark, sf_dir):
    return _text(_day_two(spark, sf_dir).hold, "Quantity_Sold")


@query
def repair_repeated_keys(spark, sf_dir):
    lines = tb.table(spark, sf_dir, "lineitem")
    held = ingest.split_valid_hold(tb.line_landing(lines, 4, 6), REQUIRED).hold
    today = tb.line_landing(lines.where(~tb.every("l_orderkey", 5)), 3, 7)
    valid, hold = ingest.repair_hold(today, held, SALE_KEY, REQUIRED)
    return valid.withColumn("part", F.lit("valid")).unionByName(hold.withColumn("part", F.lit("hold")))


LANDING_SCHEMA = (
    T.StructType()
    .add("Sale_ID", "long")
    .add("Product_ID", "long")
    .add("Quantity_Sold", "long")
    .add("Vendor_ID", "string")
)


@query
def ingest_next_day(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders")
    folder = workspace.scratch_path(spark, "ingest")
    delimited.write_delimited(tb.landing(orders, 4, 6), f"{folder}/landing1", sep="|")
    delimited.write_delimited(tb.landing_today(orders), f"{folder}/landing2", sep="|")
    jobs.ingest_first_day(spark, f"{folder}/landing1", f"{folder}/day1", LANDING_SCHEMA)
    jobs.ingest_next_day(spark, f"{folder}/landing2", f"{folder}/day1", f"{folder}/day2", LANDING_SCHEMA)
    return _ingested(spark, f"{folder}/day2")


def _ingested(spark, path: str) -> DataFrame:
    parts = [
        jobs.read_tagged(spark, path, LANDING_SCHEMA, is_valid).withColumn("part", F.lit(name))
        for is_valid, name in ((True, "valid"), (False, "hold"))
    ]
    return _text(parts[0].unionByName(parts[1]), "Quantity_Sold")


@query
def ingest_malformed(spark, sf_dir):
    """Landing lines with a surplus field or a quantity that is no number are kept apart with their text."""
    folder = workspace.scratch_path(spark, "ingest")
    quantity = F.when(tb.every("Sale_ID", 9), "five").otherwise(F.col("Quantity_Sold").cast("string"))
    surplus = F.when(tb.every("Sale_ID", 10), "extra")
    fields = ["Sale_ID", "Product_ID", F.coalesce(quantity, F.lit("")), F.coalesce("Vendor_ID", F.lit("")), surplus]
    rows = tb.landing(tb.table(spark, sf_dir, "orders"), 4, 6)
    rows.select(F.concat_ws("|", *fields).alias("value")).write.text(f"{folder}/landing")
    jobs.ingest_first_day(spark, f"{folder}/landing", f"{folder}/day", LANDING_SCHEMA)
    lines = jobs.read_unreadable(spark, f"{folder}/day").select(F.col("value").alias("line"), F.lit("unreadable").alias("part"))
    return _ingested(spark, f"{folder}/day").unionByName(_text(lines, "line"), allowMissingColumns=True).select(
        F.col("Sale_ID").cast("string").alias("Sale_ID"), "Quantity_Sold", "Vendor_ID", "part", "line"
    )


@query
def ingest_without_holds(spark, sf_dir):
    """No row of the first day is held; the second day is repaired from nothing."""
    orders, folder = tb.table(spark, sf_dir, "orders"), workspace.scratch_path(spark, "ingest")
    whole = tb.landing(orders, 4, 6).dropna()
    delimited.write_delimited(whole, f"{folder}/landing1", sep="|")
    delimited.write_delimited(tb.landing_today(orders), f"{folder}/landing2", sep="|")
    jobs.ingest_first_day(spark, f"{folder}/landing1", f"{folder}/day1", LANDING_SCHEMA)
    jobs.ingest_next_day(spark, f"{folder}/landing2", f"{folder}/day1", f"{folder}/day2", LANDING_SCHEMA)
    return _ingested(spark, f"{folder}/day2")


SOLD_SCHEMA = "Sale_ID long, Product_ID long, Quantity_Sold long, Vendor_ID string, Sale_Date date, Sale_Amount double, Sale_Currency string"
PRODUCT_SCHEMA = "Product_ID long, Product_Name string, Product_Price double"


@query
def enrich_day(spark, sf_dir):
    """Both outcomes of one pass: priced sales, and those without one product."""
    folder = workspace.scratch_path(spark, "enrich")
    schemas = [T.StructType.fromDDL(s) for s in (SOLD_SCHEMA, PRODUCT_SCHEMA)]
    lines = tb.table(spark, sf_dir, "lineitem")
    sold = lines.select(
        F.col("l_orderkey").alias("Sale_ID"),
        F.col("l_partkey").alias("Product_ID"),
        F.col("l_quantity").cast("long").alias("Quantity_Sold"),
        F.when(~tb.every("l_orderkey", 9), F.col("l_suppkey").cast("string")).alias("Vendor_ID"),
        F.lit("2024-01-31").alias("Sale_Date"),
        F.lit(None).cast("double").alias("Sale_Amount"),
        F.lit("USD").alias("Sale_Currency"),
    )
    delimited.write_delimited(sold, f"{folder}/landing", sep="|")
    delimited.write_delimited(tb.products(tb.table(spark, sf_dir, "part")), f"{folder}/products", sep="|")
    jobs.ingest_first_day(spark, f"{folder}/landing", f"{folder}/day", schemas[0])
    jobs.enrich_day(spark, f"{folder}/day", f"{folder}/products", f"{folder}/priced", *schemas)
    rows = jobs.read_enriched(spark, f"{folder}/priced", *schemas)
    return rows.groupBy("Product_ID", "Product_Name", "outcome").agg(
        F.count(F.lit(1)).alias("n_sales"),
        F.sum("Quantity_Sold").alias("quantity"),
        F.sum(F.col("Sale_Amount").cast("decimal(18,2)")).cast("string").alias("amount"),
    )


@query
def enrich_sales(spark, sf_dir):
    sold, reference = tb.sales(tb.table(spark, sf_dir, "lineitem")), tb.products(tb.table(spark, sf_dir, "part"))
    return ingest.enrich_sales(sold, reference).enriched


@query
def enrich_unmatched(spark, sf_dir):
    sold, reference = tb.sales(tb.table(spark, sf_dir, "lineitem")), tb.products(tb.table(spark, sf_dir, "part"))
    return ingest.enrich_sales(sold, reference).unmatched.drop("Sale_Amount")


@query
def expected_count_check(spark, sf_dir):
    def files(name: str) -> DataFrame:
        # a table is one file, or a folder of that name
        return ingest.rows_per_file(tb.table(spark, sf_dir, name), r"([^/]+\.parquet)")

    def expected(name: str, source: str, factor: int) -> DataFrame:
        counted = tb.table(spark, sf_dir, source).agg((F.count(F.lit(1)) * factor).alias("row_count"))
        return counted.select(F.lit(name).alias("file_name"), "row_count")

    counted = files("orders").unionByName(files("lineitem")).unionByName(files("supplier")).unionByName(files("part"))
    control = (
        expected("orders.parquet", "customer", 10)
        .unionByName(expected("lineitem.parquet", "orders", 4))
        .unionByName(expected("supplier.parquet", "part", 1))
        .unionByName(expected("returns.parquet", "events", 1))
    )
    checked = ingest.expected_count_check(counted, control, "file_name", "row_count")
    return _text(checked, "expected_rows", "actual_rows")


# ---- cleansing


@query
def clean_statement(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders")
    price = F.format_number("o_totalprice", 2)
    day = F.date_format("o_orderdate", "dd-MMM-yy")
    raw = orders.select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("AccountNo"),
        F.lit("x").alias("DOT"),
        F.lit("y").alias("CHQNO"),
        F.when(~tb.every("o_orderkey", 9), price).alias("WITHDRAWALAMT"),
        F.when(tb.every("o_orderkey", 11), "n/a").otherwise(price).alias("DEPOSITAMT"),
        price.alias("BALANCEAMT"),
        F.when(tb.every("o_orderkey", 6), "someday").otherwise(day).alias("DATE"),
        day.alias("VALUEDATE"),
    )
    return _text(jobs.clean_statement(raw), "DATE", "VALUEDATE")


@query
def clean_users(spark, sf_dir):
    customers = tb.table(spark, sf_dir, "customer")
    flag = lambda n: F.when(tb.every("c_custkey", n), "false").otherwise("true")
    raw = customers.select(
        F.col("c_custkey").cast("string").alias("SNO"),
        F.col("c_name").alias("FNAME"),
        F.concat(F.lit("(040) "), F.col("c_nationkey").cast("string"), F.lit("-"), F.col("c_custkey").cast("string")).alias("PHONE"),
        flag(4).alias("US_CITIZEN"),
        F.when(~tb.every("c_custkey", 9), flag(5)).alias("HAS_SSN"),
        F.when(~tb.every("c_custkey", 11), flag(6)).alias("EMPLOYEE_STATUS"),
        *(F.lit("-").alias(f"DELETE_COLUMN{i}") for i in range(1, 8)),
    )
    return jobs.eligible_users(jobs.clean_users(raw))


@query
def parse_dates(spark, sf_dir):
    day = F.col("o_orderdate")
    # The layouts to parse.
    layouts = {"a": "yyyy-MM-dd", "b": "yyyy/MM/dd", "c": "yyyyMMdd", "d": "dd-MM-yyyy", "e": "dd-MMM-yy"}
    raw = tb.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *(F.date_format(day, layout).alias(name) for name, layout in layouts.items()),
        F.when(tb.every("o_orderkey", 3), "not a date").when(tb.every("o_orderkey", 2), F.date_format(day, "yyyyMMdd"))
        .otherwise(F.date_format(day, "yyyy/MM/dd")).alias("f"),
    )
    parsed = cleanse.parse_dates(raw, {n: [layout] for n, layout in layouts.items()} | {"f": ["yyyy/MM/dd", "yyyyMMdd"]})
    return _text(parsed, *layouts, "f")


@query
def parse_timestamps(spark, sf_dir):
    # The layouts to parse.
    layouts = {
        "ts1": "yyyy-MM-dd HH:mm:ss.SSS",
        "ts2": "yyyy-MM-dd HH:mm:ss",
        "ts3": "yyyyMMddHHmmss.SSS",
        "ts4": "yyyyMMddHHmmss.SSSSSS",
        "ts5": "yyyy-MM-dd-HH.mm.ss.SSS",
    }
    raw = tb.table(spark, sf_dir, "events").select(
        "event_id", *(F.date_format("ts", layout).alias(name) for name, layout in layouts.items())
    )
    parsed = cleanse.parse_timestamps(raw, {name: [layout] for name, layout in layouts.items()})
    return parsed.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS") for n in layouts})


@query
def recode(spark, sf_dir):
    customers = tb.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return cleanse.recode(customers, "c_mktsegment", {"BUILDING": "B", "MACHINERY": "M"}, default="Unknown")


@query
def transform_customers(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders")
    city = F.when(tb.every("o_custkey", 2), "hyd").otherwise(F.col("o_orderpriority"))
    raw = orders.select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("dob"), city.alias("city")
    )
    return _text(jobs.transform_customers(raw), "dob")


@query
def split_contact(spark, sf_dir):
    digits = F.substring_index("c_name", "#", -1)
    contact = (
        F.when(tb.every("c_custkey", 3), digits)
        .when(tb.every("c_custkey", 5), F.substring_index("c_name", "#", 1))
        .otherwise(F.col("c_name"))
    )
    raw = tb.table(spark, sf_dir, "customer").select("c_custkey", contact.alias("contact"))
    return cleanse.split_contact(raw, "contact", sep="#")


@query
def semi_join_distinct(spark, sf_dir):
    """The reference holds a part of the users, several times each."""
    events = tb.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    buyers = events.where((F.col("event_type") == "purchase") & tb.every("user_id", 3)).select("user_id")
    return cleanse.semi_join_distinct(events, buyers, ["user_id"])


@query
def ranked_by_score(spark, sf_dir):
    customers = tb.table(spark, sf_dir, "customer")
    return cleanse.ranked_by_score(
        customers, "c_acctbal", above=500, equals={"c_mktsegment": "BUILDING"}, ties=["c_custkey"]
    )


@query
def word_count(spark, sf_dir):
    return cleanse.word_count(tb.table(spark, sf_dir, "documents"), "text")


@query
def word_count_normalized(spark, sf_dir):
    return cleanse.word_count(tb.table(spark, sf_dir, "documents"), "text", separator="[^a-z0-9]+", lower=True)


# ---- files and tables

PART_METADATA = [
    {"fieldPosition": 2, "fieldName": "p_name", "fieldDataType": "String", "fieldNullability": True},
    {"fieldPosition": 1, "fieldName": "p_partkey", "fieldDataType": "Long", "fieldNullability": False},
    {"fieldPosition": 3, "fieldName": "p_size", "fieldDataType": "integer", "fieldNullability": True},
    {"fieldPosition": 4, "fieldName": "p_retailprice", "fieldDataType": "Decimal", "fieldPrecision": 18, "fieldScale": 2},
    {"fieldPosition": 5, "fieldName": "p_since", "fieldDataType": "Date", "fieldDateFormat": "dd/MM/yyyy"},
]


def _part_rows(spark, sf_dir) -> DataFrame:
    since = F.date_add(F.lit(tb.OPENED), F.col("p_size"))
    return tb.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(tb.every("p_partkey", 9), "").when(~tb.every("p_partkey", 7), F.col("p_name")).alias("p_name"),
        "p_size",
        F.col("p_retailprice").cast("decimal(18,2)").alias("p_retailprice"),
        F.when(tb.every("p_partkey", 6), "soon").otherwise(F.date_format(since, "dd/MM/yyyy")).alias("p_since"),
    )


@query
def read_delimited(spark, sf_dir):
    path = workspace.scratch_path(spark, "delimited")
    delimited.write_delimited(_part_rows(spark, sf_dir), path, sep="|", null_value=jobs.NULL_MARK)
    schema = delimited.schema_from_metadata(PART_METADATA)
    rows = delimited.read_delimited(spark, path, schema, sep="|", null_value=jobs.NULL_MARK)
    return _text(rows, "p_retailprice", "p_since").withColumnRenamed(delimited.CORRUPT, "problem")


@query
def read_with_header(spark, sf_dir):
    """Columns by header, with a schema that is itself a file."""
    folder = workspace.scratch_path(spark, "delimited")
    suppliers = tb.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    delimited.write_delimited(suppliers, f"{folder}/named", sep=";", header=True)
    fields = [
        {"fieldPosition": i, "fieldName": n, "fieldDataType": t}
        for i, (n, t) in enumerate([("s_suppkey", "Long"), ("s_name", "String"), ("s_nationkey", "Integer")])
    ]
    spark.range(1).select(F.lit(json.dumps(fields)).alias("value")).coalesce(1).write.text(f"{folder}/schema")
    schema = delimited.load_schema(spark, f"{folder}/schema")
    typed = delimited.read_delimited(spark, f"{folder}/named", schema, sep=";", header=True)
    named = delimited.read_delimited(spark, f"{folder}/named", sep=";", header=True)
    return typed.drop(delimited.CORRUPT).join(named.select("s_name", F.col("s_nationkey").alias("as_text")), "s_name")


@query
def read_without_header(spark, sf_dir):
    path = workspace.scratch_path(spark, "delimited")
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    delimited.write_delimited(orders, path, sep="|")
    return delimited.read_delimited(spark, path, sep="|")


@query
def read_by_header(spark, sf_dir):
    """Three extracts with their columns in three orders; one lacks a column, one has one more."""
    folder, customers = workspace.scratch_path(spark, "headers"), tb.table(spark, sf_dir, "customer")
    orders = [["c_custkey", "c_name", "c_mktsegment"], ["c_mktsegment", "c_custkey", "c_name", "c_nationkey"], ["c_name", "c_custkey"]]
    for i, columns in enumerate(orders):
        rows = customers.where(F.col("c_custkey") % len(orders) == i).select(columns)
        delimited.write_delimited(rows, f"{folder}/{i}", sep="|", header=True)
    schema = T.StructType().add("c_custkey", "long").add("c_name", "string").add("c_mktsegment", "string")
    read = delimited.read_by_header(spark, f"{folder}/*", schema, sep="|")
    return _text(read.drop(delimited.CORRUPT), "c_mktsegment")


@query
def write_timestamps(spark, sf_dir):
    path = workspace.scratch_path(spark, "delimited")
    events = tb.table(spark, sf_dir, "events").select("event_id", "ts")
    delimited.write_delimited(events, path, timestamp_format="yyyy/MM/dd HH.mm.ss")
    return delimited.read_delimited(spark, path)


@query
def files_of_one_name(spark, sf_dir):
    """Two folders hold a file of the same name; the control table lists it once."""
    folder = workspace.scratch_path(spark, "files")
    for part in ("x", "y"):
        tb.table(spark, sf_dir, "supplier").write.parquet(f"{folder}/{part}/Sales.parquet")
    tb.table(spark, sf_dir, "nation").write.parquet(f"{folder}/z/Nation.parquet")
    read = spark.read.option("recursiveFileLookup", "true").schema("s_suppkey long")
    counted = ingest.rows_per_file(read.parquet(folder), r"([^/]+\.parquet)/")
    names = F.explode(F.array(F.lit("Sales.parquet"), F.lit("Nation.parquet"))).alias("file_name")
    control = tb.table(spark, sf_dir, "nation").agg(F.count(F.lit(1)).alias("row_count")).select(names, "row_count")
    return _text(ingest.expected_count_check(counted, control, "file_name", "row_count"), "expected_rows", "actual_rows")


@query
def daily_partition(spark, sf_dir):
    path = workspace.scratch_path(spark, "table")
    events = tb.table(spark, sf_dir, "events").select("event_id", "ts")
    tables.write_table(tables.daily_partition(events, "ts"), path, partition_by=["partition_date"])
    days = spark.read.parquet(path).groupBy("partition_date").agg(F.count(F.lit(1)).alias("n_rows"))
    return _text(days, "partition_date")


@query
def read_time_range(spark, sf_dir):
    """A table by the hidden day of its timestamp; a range of timestamps reads the folders of its days."""
    path, by_day = workspace.scratch_path(spark, "table"), transforms.days("ts")
    events = tb.table(spark, sf_dir, "events").select("event_id", "ts")
    tables.write_table(by_day.added(events), path, partition_by=[by_day.partition])
    wanted = by_day.within(datetime(2024, 1, 3, 6), datetime(2024, 1, 7)) | by_day.at_least(datetime(2024, 1, 20, 18, 30))
    rows = tables.read_where(spark, path, wanted).select("event_id", "ts")
    return rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def parse_delimited_text(spark, sf_dir):
    extra = F.when(tb.every("p_partkey", 17), "more")
    line = F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", F.col("p_size").cast("string"), extra)
    lines = tb.table(spark, sf_dir, "part").select(line.alias("value"))
    schema = T.StructType().add("p_partkey", "long").add("p_name", "string").add("p_size", "integer")
    parsed = delimited.parse_delimited_text(lines, schema, sep="|")
    return parsed.withColumnRenamed(delimited.CORRUPT, "problem")


@query
def write_table(spark, sf_dir):
    path = workspace.scratch_path(spark, "table")
    suppliers = tb.table(spark, sf_dir, "supplier")
    tables.write_table(suppliers, path, partition_by=["s_nationkey"])
    even = suppliers.where(tb.every("s_nationkey", 2)).withColumn("s_acctbal", F.col("s_acctbal") + 1)
    tables.write_table(even, path, partition_by=["s_nationkey"], only_touched_partitions=True)
    return spark.read.parquet(path)


# ---- loads

LOAD_TIMES = [datetime(2024, 2, 1), datetime(2024, 2, 2), datetime(2024, 2, 3)]
AFTER = datetime(2024, 2, 4)


def _loaded_table(spark, sf_dir) -> str:
    path = workspace.scratch_path(spark, "lake")
    for (mode, rows), load_ts in zip(tb.event_loads(tb.table(spark, sf_dir, "events")), LOAD_TIMES):
        lake.load_partition(rows, path, "event_date", load_ts, mode=mode)
    return path


@query
def load_partition(spark, sf_dir):
    return _text(lake.read_as_of(spark, _loaded_table(spark, sf_dir)), "event_date")


@query
def read_as_of(spark, sf_dir):
    return _text(lake.read_as_of(spark, _loaded_table(spark, sf_dir), load_id=1), "event_date")


@query
def read_as_of_time(spark, sf_dir):
    path = _loaded_table(spark, sf_dir)
    return _text(lake.read_as_of(spark, path, load_ts=datetime(2024, 2, 2, 12)), "event_date")


@query
def list_partitions(spark, sf_dir):
    return lake.list_partitions(spark, _loaded_table(spark, sf_dir))


@query
def list_snapshots(spark, sf_dir):
    return _text(lake.list_snapshots(spark, _loaded_table(spark, sf_dir)), "load_ts")


@query
def restore_partition(spark, sf_dir):
    path = _loaded_table(spark, sf_dir)
    lake.restore_partition(spark, path, "event_date", datetime(2024, 1, 2).date(), load_id=1, load_ts=AFTER)
    return _text(lake.read_as_of(spark, path), "event_date")


@query
def update_rows(spark, sf_dir):
    path = _loaded_table(spark, sf_dir)
    condition = (F.col("event_type") == "error") & (F.dayofmonth("event_date") <= 10)
    lake.update_rows(spark, path, "event_date", condition, {"event_type": F.lit("fixed"), "value": F.lit(0)}, AFTER)
    return _text(lake.read_as_of(spark, path), "event_date")


@query
def load_counts(spark, sf_dir):
    """What each of three loads counted while it wrote its rows."""
    path, counted = workspace.scratch_path(spark, "lake"), []
    totals = {"total_value": F.sum(F.col("value").cast("decimal(18,2)")).cast("long"), "errors": F.count_if(F.col("event_type") == "error")}
    for (mode, rows), load_ts in zip(tb.event_loads(tb.table(spark, sf_dir, "events")), LOAD_TIMES):
        load = lake.load_counted(rows, path, "event_date", load_ts, mode=mode, totals=totals)
        counted.append({"load_id": load.load_id} | load.totals)
    return _counted(spark, counted)


@query
def changes_between_loads(spark, sf_dir):
    """From the first load to the third: corrected days, and late rows of every day."""
    changed = lake.changes_between(spark, _loaded_table(spark, sf_dir), 1, 3)
    return _text(changed, "event_date")


@query
def read_partitions_where(spark, sf_dir):
    """Only the folders of the partitions that meet the condition are read."""
    early = F.col("event_date") <= F.lit(datetime(2024, 1, 5).date())
    rows = lake.read_as_of(spark, _loaded_table(spark, sf_dir), partition_by="event_date", partitions_where=early)
    return _text(rows, "event_date")


def _loads_with_gaps(spark, sf_dir) -> str:
    """An empty first load, all events, another empty load, and late events with a column more."""
    path, events = workspace.scratch_path(spark, "lake"), tb.daily_events(tb.table(spark, sf_dir, "events"))
    late = events.where(tb.every("event_id", 5)).withColumns(
        {"event_id": -F.col("event_id") - 1, "origin": F.lit("late")}
    )
    loads = [(events.limit(0), "replace"), (events, "replace"), (events.limit(0), "replace"), (late, "append")]
    for n, (rows, mode) in enumerate(loads):
        lake.load_partition(rows, path, "event_date", datetime(2024, 3, n + 1), mode=mode)
    return path


@query
def load_with_new_column(spark, sf_dir):
    return _text(lake.read_as_of(spark, _loads_with_gaps(spark, sf_dir)), "event_date")


@query
def load_after_empty_load(spark, sf_dir):
    return _text(lake.list_snapshots(spark, _loads_with_gaps(spark, sf_dir)), "load_ts")


@query
def read_as_of_after_empty_load(spark, sf_dir):
    return _text(lake.read_as_of(spark, _loads_with_gaps(spark, sf_dir), load_id=3), "event_date")


# ---- streams


def _event_stream(spark, sf_dir) -> DataFrame:
    schema = tb.table(spark, sf_dir, "events").schema
    # a pattern: the table may be one file or a folder of files
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return stream.select("event_id", "user_id", "event_type", "value")


@query
def stream_ingest(spark, sf_dir):
    folder = workspace.scratch_path(spark, "stream")
    stream = _event_stream(spark, sf_dir)
    streaming.stream_ingest(stream, f"{folder}/checkpoint", f"{folder}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@query
def stream_in_intervals(spark, sf_dir):
    folder = workspace.scratch_path(spark, "stream")
    stream = _event_stream(spark, sf_dir)
    running = streaming.stream_ingest(stream, f"{folder}/checkpoint", f"{folder}/rows", every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@query
def stream_messages(spark, sf_dir):
    folder = workspace.scratch_path(spark, "stream")
    messages = _event_stream(spark, sf_dir).select(
        F.col("event_id").cast("string").cast("binary").alias("key"), F.col("event_type").cast("binary").alias("value")
    )
    decoded = streaming.decode_messages(messages)
    streaming.stream_ingest(decoded, f"{folder}/checkpoint", f"{folder}/rows").awaitTermination()
    return spark.read.schema(decoded.schema).parquet(f"{folder}/rows")


@query
def stream_split(spark, sf_dir):
    folder = workspace.scratch_path(spark, "stream")
    gaps = F.when(~tb.every("event_id", 4), F.col("event_type"))
    stream = _event_stream(spark, sf_dir).withColumn("event_type", gaps)
    streaming.stream_split(stream, ["event_type", "value"], f"{folder}/checkpoint", f"{folder}/rows").awaitTermination()
    return spark.read.schema(stream.schema.add("is_valid", "boolean")).parquet(f"{folder}/rows")


@query
def stream_load(spark, sf_dir):
    """A stream in several batches, ended right after a load and started again: the batch is repeated and loaded once."""
    folder, events = workspace.scratch_path(spark, "stream"), tb.daily_events(tb.table(spark, sf_dir, "events"))
    events.repartition(3, "event_id").write.parquet(f"{folder}/landing")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landing")

    def start(after_load=None):
        return streaming.stream_load(
            stream, f"{folder}/table", "event_date", f"{folder}/checkpoint", lambda n: datetime(2024, 3, 1 + n), "events",
            after_load=after_load,
        )

    def end_after_second(batch_id: int, load: lake.Load) -> None:
        if batch_id == 1:
            raise InterruptedError("ended after the load")

    try:
        start(end_after_second).awaitTermination()
    except StreamingQueryException:
        pass
    start().awaitTermination()
    return _text(lake.read_as_of(spark, f"{folder}/table"), "event_date")


@query
def stream_repair(spark, sf_dir):
    """Two landings, one micro-batch each; what is valid and what is held after the second."""
    folder, orders = workspace.scratch_path(spark, "stream"), tb.table(spark, sf_dir, "orders")
    days = [datetime(2024, 5, 1), datetime(2024, 5, 2)]
    landed = lambda day: F.to_timestamp(F.lit(str(day))).alias("landed")
    landings = [tb.landing(orders, 4, 6), tb.landing_today(orders)]
    schema = landings[0].select("*", landed(days[0])).schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/landing/*")
    repaired = stream_repairs.stream_repair(stream, SALE_KEY, REQUIRED, "landed")
    for n, (day, rows) in enumerate(zip(days, landings)):
        rows.select("*", landed(day)).write.parquet(f"{folder}/landing/{n}")
        streaming.stream_ingest(repaired, f"{folder}/checkpoint", f"{folder}/rows").awaitTermination()
    rows = spark.read.schema(repaired.schema).parquet(f"{folder}/rows")
    valid = rows.where(F.col("is_valid") & (F.col("landed") == F.to_timestamp(F.lit(str(days[1]))))).drop("is_valid")
    parts = [valid.withColumn("part", F.lit("valid")), stream_repairs.still_held(rows, SALE_KEY, "landed").withColumn("part", F.lit("hold"))]
    return _text(parts[0].unionByName(parts[1]).drop("landed"), "Quantity_Sold")
