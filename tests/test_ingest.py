"""Landing data, repair, enrichment, control file, cleansing."""

from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from rowloom.functions import parsing
from rowloom.operators import cleanse, ingest
from rowloom.plans import jobs
from rowloom.sources.delimited import schema_from_metadata, write_delimited
from tests.helpers import frame, rows_of, same

SALES = "Sale_ID string, Product_ID string, Quantity_Sold int, Vendor_ID string, Sale_Date date, Sale_Amount double, Sale_Currency string"
PRODUCTS = "Product_ID string, Product_Name string, Product_Price int, Product_Price_Currency string, Product_Updated_Date date"
REQUIRED = ["Quantity_Sold", "Vendor_ID"]
DAY = date(2020, 7, 18)


def sale(sale_id, product, quantity, vendor):
    return (sale_id, product, quantity, vendor, DAY, None, "USD")


@pytest.fixture
def day1(spark):
    rows = [sale("S1", "P1", 5, "V1"), sale("S2", "P1", None, "V1"), sale("S3", "P2", 4, None), sale("S4", "P2", None, None)]
    return frame(spark, SALES, *rows)


@pytest.fixture
def day2(spark):
    return frame(spark, SALES, sale("S2", "P1", 7, None), sale("S3", "P2", None, None), sale("S5", "P3", 1, "V9"))


@pytest.fixture
def products(spark):
    return frame(
        spark,
        PRODUCTS,
        ("P1", "Pen", 10, "USD", date(2020, 1, 1)),
        ("P2", "Ink", 2_000_000_000, "USD", date(2020, 1, 1)),
    )


def test_split(day1):
    valid, hold = ingest.split_valid_hold(day1, REQUIRED)
    same(valid, [("S1",)], "Sale_ID")
    same(hold, [("S2",), ("S3",), ("S4",)], "Sale_ID")


def test_repair(day1, day2, join_path):
    held = ingest.split_valid_hold(day1, REQUIRED).hold
    valid, hold = ingest.repair_hold(day2, held, ["Sale_ID"], REQUIRED)
    same(valid, [("S2", 7, "V1"), ("S5", 1, "V9")], "Sale_ID", *REQUIRED)
    same(hold, [("S3", 4, None), ("S4", None, None)], "Sale_ID", *REQUIRED)


def test_repair_multiplies_no_row(spark, join_path):
    schema = "k int, q int, v string"
    today = frame(spark, schema, (1, None, None), (1, 5, None), (None, None, "t"))
    held = frame(spark, schema, (1, 3, None), (1, None, "b"), (1, None, "a"), (2, 8, None), (2, 8, None), (None, 9, None))
    valid, hold = ingest.repair_hold(today, held, ["k"], ["q", "v"])
    same(valid, [(1, 3, "b"), (1, 5, "b")])
    same(hold, [(None, None, "t"), (2, 8, None), (2, 8, None), (None, 9, None)])


def test_repair_with_a_hot_key(spark, join_path):
    today = spark.range(100).selectExpr("if(id % 3 = 0, 0, id) as k", "cast(null as int) as q")
    held = spark.range(100).selectExpr("id as k", "cast(id as int) as q")
    valid, hold = ingest.repair_hold(today, held, ["k"], ["q"])
    assert valid.count() == 100 and valid.where("k <> q").count() == 0
    same(hold, [(k, k) for k in range(1, 100) if k % 3 == 0])


def test_enrichment(spark, products, join_path):
    sales = frame(spark, SALES, sale("S2", "P1", 7, "V1"), sale("S5", "P3", 1, "V9"), sale("S6", "P2", 2, "V1"), sale("S7", None, 2, "V1"))
    enriched, unmatched = ingest.enrich_sales(sales, products)
    same(enriched, [("S2", "Pen", 70), ("S6", "Ink", 4_000_000_000)], "Sale_ID", "Product_Name", "Sale_Amount")
    same(unmatched, [("S5", "unknown_product"), ("S7", "unknown_product")], "Sale_ID", "reason")


def test_enrichment_sets_ambiguous_products_apart(spark, products, join_path):
    sales = frame(spark, SALES, sale("S1", "P1", 7, "V1"), sale("S2", "P2", 1, "V1"))
    enriched, unmatched = ingest.enrich_sales(sales, products.unionByName(products.where("Product_ID = 'P2'")))
    same(enriched, [("S1", 70)], "Sale_ID", "Sale_Amount")
    same(unmatched, [("S2", "ambiguous_product")], "Sale_ID", "reason")


def metadata(**types):
    return [
        {"fieldPosition": i, "fieldName": n, "fieldDataType": t, "fieldDateFormat": "yyyy-MM-dd" if t == "Date" else None}
        for i, (n, t) in enumerate(types.items(), 1)
    ]


def test_two_days_through_files(spark, day1, day2, products, tmp_path):
    sales_schema = schema_from_metadata(
        metadata(
            Sale_ID="String", Product_ID="String", Quantity_Sold="Integer", Vendor_ID="String",
            Sale_Date="Date", Sale_Amount="Double", Sale_Currency="String",
        )
    )
    product_schema = schema_from_metadata(
        metadata(
            Product_ID="String", Product_Name="String", Product_Price="Integer",
            Product_Price_Currency="String", Product_Updated_Date="Date",
        )
    )
    write_delimited(day1, f"{tmp_path}/in1", sep="|")
    write_delimited(day2, f"{tmp_path}/in2", sep="|")
    write_delimited(products, f"{tmp_path}/products", sep="|")
    jobs.ingest_first_day(spark, f"{tmp_path}/in1", f"{tmp_path}/out1", sales_schema)
    jobs.ingest_next_day(spark, f"{tmp_path}/in2", f"{tmp_path}/out1", f"{tmp_path}/out2", sales_schema)
    read = lambda is_valid: jobs.read_tagged(spark, f"{tmp_path}/out2", sales_schema, is_valid)
    same(read(True), [("S2", 7, "V1", DAY), ("S5", 1, "V9", DAY)], "Sale_ID", *REQUIRED, "Sale_Date")
    same(read(False), [("S3", 4, None), ("S4", None, None)], "Sale_ID", *REQUIRED)
    jobs.enrich_day(
        spark, f"{tmp_path}/out2", f"{tmp_path}/products", f"{tmp_path}/enriched", sales_schema, product_schema
    )
    priced = jobs.read_enriched(spark, f"{tmp_path}/enriched", sales_schema, product_schema)
    same(priced, [("S2", "Pen", 70, "enriched"), ("S5", None, None, "unknown_product")], "Sale_ID", "Product_Name", "Sale_Amount", "outcome")
    written = spark.read.csv(f"{tmp_path}/enriched/rows/outcome=enriched", sep="|")
    same(written, [("S2", "P1", "Pen", "10", "7", "V1", "2020-07-18", "70", "USD")])


def test_control_file(spark):
    control = frame(spark, "FileName string, Row_Count int", ("a", 2), ("b", 3), ("c", 1), ("e", 1), ("e", 1))
    counted = frame(spark, "FileName string, n_rows long", ("a", 2), ("b", 1), ("b", 1), ("d", 4), ("e", 1))
    same(
        ingest.expected_count_check(counted, control, "FileName", "Row_Count"),
        [
            ("a", 2, 2, "match"),
            ("b", 3, 2, "mismatch"),
            ("c", 1, None, "missing"),
            ("d", None, 4, "unexpected"),
            ("e", None, 1, "ambiguous"),
        ],
    )


def test_rows_per_file(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/x.parquet")
    spark.range(7).repartition(3).write.parquet(f"{tmp_path}/y.parquet")
    rows = spark.read.parquet(f"{tmp_path}/x.parquet", f"{tmp_path}/y.parquet")
    counted = ingest.rows_per_file(rows, r"([^/]+\.parquet)")
    same(counted, [("x.parquet", 10, 1), ("y.parquet", 7, 1)])


def test_files_of_one_name_are_ambiguous(spark, tmp_path):
    for folder in ("x", "y"):
        spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/{folder}/Sales.dat")
    counted = ingest.rows_per_file(spark.read.parquet(f"{tmp_path}/x/Sales.dat", f"{tmp_path}/y/Sales.dat"), r"([^/]+\.dat)")
    control = frame(spark, "file_name string, n int", ("Sales.dat", 6))
    same(ingest.expected_count_check(counted, control, "file_name", "n"), [("Sales.dat", 6, 6, "ambiguous")])


# ---- cleansing


def test_bank_statement(spark):
    names = ["AccountNo", "DOT", "CHQNO", "DATE", "VALUEDATE", "WITHDRAWALAMT", "DEPOSITAMT", "BALANCEAMT"]
    rows = spark.createDataFrame(
        [
            ("409000611074", "a", "b", "29-Jun-17", "30-Jun-17", None, "1,000,000.50", "12"),
            ("x1", "a", "b", "29/06/17", "30-Jun-17", "abc", " 7 ", "0"),
        ],
        ", ".join(f"{n} string" for n in names),
    )
    same(
        jobs.clean_statement(rows),
        [
            (409000611074, date(2017, 6, 29), date(2017, 6, 30), 0.0, 1000000.5, 12.0, ""),
            (None, None, date(2017, 6, 30), None, 7.0, 0.0, "AccountNo,WITHDRAWALAMT,DATE"),
        ],
    )


def test_users(spark):
    names = "SNO PASSPORT FNAME MNAME LNAME STATE EMAILID PHONE US_CITIZEN HAS_SSN EMPLOYEE_STATUS".split()
    names += [f"DELETE_COLUMN{i}" for i in range(1, 8)]
    person = lambda n, citizen, ssn, employed: (n, "p", "f", "m", "l", "s", "e", "(040) 12-34", citizen, ssn, employed, *"1234567")
    rows = spark.createDataFrame(
        [
            person("1", "true", "true", "true"),
            person("2", "true", None, "true"),
            person("3", "false", "true", "true"),
            person("4", "true", "true", "maybe"),
        ],
        ", ".join(f"{n} string" for n in names),
    )
    cleaned = jobs.clean_users(rows)
    assert len(cleaned.columns) == 10 and cleaned.count() == 3
    same(jobs.eligible_users(cleaned), [("04012" + "34", True, True, True)], "PHONE", "US_CITIZEN", "HAS_SSN", "EMPLOYEE_STATUS")


def test_timestamps(spark):
    rows = frame(
        spark,
        "DOB string, DOB1 string, DOB2 string, TS1 string, TS2 string, TS3 string, TS4 string, TS5 string",
        (
            "1999-12-31", "2008/02/29", "20080229", "1999-12-31 23:59:58.407", "1999-12-31 23:59:58",
            "20080229061510.250", "20080229061510.000037", "2008-02-29-06.15.10.250",
        ),
    )
    dates = cleanse.parse_dates(rows, {"DOB": ["yyyy-MM-dd"], "DOB1": ["yyyy/MM/dd"], "DOB2": ["yyyyMMdd"]})
    parsed = cleanse.parse_timestamps(dates, {f"TS{i}": [] for i in range(1, 6)})
    text = parsed.selectExpr("DOB", "DOB1", "DOB2", *(f"string(TS{i})" for i in range(1, 6)))
    same(
        text,
        [
            (
                date(1999, 12, 31), date(2008, 2, 29), date(2008, 2, 29), "1999-12-31 23:59:58.407", "1999-12-31 23:59:58",
                "2008-02-29 06:15:10.25", "2008-02-29 06:15:10.000037", "2008-02-29 06:15:10.25",
            )
        ],
    )


@pytest.mark.parametrize(
    "layout, text, day",
    [
        ("dd-MM-yyyy", "05-11-1972", date(1972, 11, 5)),
        ("dd-MMM-yy", "29-Jun-17", date(2017, 6, 29)),
        ("dd-MM-yyyy", "1972-11-05", None),
    ],
)
def test_date_layouts(spark, layout, text, day):
    rows = frame(spark, "d string", (text,))
    same(cleanse.parse_dates(rows, {"d": [layout]}), [(day,)])


def test_recode(spark):
    rows = frame(spark, "id int, dob date, city string", (1, date(2024, 2, 28), "hyd"), (2, None, "x"), (3, date(2023, 12, 31), None))
    same(
        jobs.transform_customers(rows),
        [(2, date(2024, 3, 1), "hyderabad"), (3, None, "visakhapatnam"), (4, date(2024, 1, 2), "visakhapatnam")],
    )
    genders = frame(spark, "Gender string", ("M",), ("F",), ("",))
    same(cleanse.recode(genders, "Gender", {"M": "Male", "F": "FeMale"}, "Unknown"), [("Male",), ("FeMale",), ("Unknown",)])
    same(cleanse.recode(genders, "Gender", {"M": "Male"}), [("Male",), ("F",), ("",)])


def test_contact(spark):
    rows = frame(spark, "c string", ("Hyderabad-98480",), ("98480",), ("Hyderabad",), ("12-34",), ("",), (None,))
    same(
        cleanse.split_contact(rows, "c"),
        [
            ("Hyderabad-98480", "Hyderabad", "98480"),
            ("98480", None, "98480"),
            ("Hyderabad", "Hyderabad", None),
            ("12-34", None, "34"),
            ("", None, None),
            (None, None, None),
        ],
    )


def test_semi_join_keeps_copies(spark, join_path):
    rows = frame(spark, "berth string, ship int", ("a", 4), ("a", 4), ("b", 5), ("c", None))
    ships = frame(spark, "ship int", (4,), (4,), (6,), (None,))
    same(cleanse.semi_join_distinct(rows, ships, ["ship"]), [("a", 4), ("a", 4)], "berth", "ship")


def test_ranking(spark):
    students = frame(
        spark, "SID int, FL string, SCORE int", (1, "Telugu", 510), (2, "Hindi", 600), (3, "Telugu", 490), (4, "Telugu", 510)
    )
    ranked = cleanse.ranked_by_score(students, "SCORE", above=500, ties=["SID"])
    assert [r.SID for r in ranked.collect()] == [2, 1, 4]
    assert [r.SID for r in cleanse.ranked_by_score(students, "SCORE", equals={"FL": "Telugu"}, ties=["SID"]).collect()] == [1, 4, 3]


def test_copies_of_one_score_are_spread(spark):
    rows = spark.range(0, 20_000, 1, 8).selectExpr("500 as SCORE")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = cleanse.ranked_by_score(rows, "SCORE")
        assert ranked.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_word_count(spark):
    lines = frame(spark, "t string", ("to be or",), ("",), ("not to be ?",), (None,), ("so  it is, so.",))
    same(
        cleanse.word_count(lines, "t"),
        [("to", 2), ("be", 2), ("or", 1), ("not", 1), ("?", 1), ("so", 1), ("it", 1), ("is,", 1), ("so.", 1)],
    )


def test_a_time_literal_does_not_depend_on_the_zone(spark):
    value = spark.range(1).select(parsing.timestamp_literal(datetime(2024, 1, 1, 5)).alias("t"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert value.first().t == datetime(2024, 1, 1, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_partitioned_text_is_written_without_a_sort(spark, tmp_path, monkeypatch):
    """A task keeps a file open per value; the session's own setting holds again afterwards, also after a failure."""
    setting, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    csv = DataFrameWriter.csv
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, path: seen.append(int(spark.conf.get(setting))) or csv(self, path))
    rows = spark.range(200).selectExpr("id", "id % 3 as few", "id % 40 as many")
    before = spark.conf.get(setting)
    for column in ("few", "many"):  # more values than open files: Spark goes on with a sort
        write_delimited(rows, f"{tmp_path}/{column}", partition_by=[column])
        back = spark.read.schema(f"id long, {'many' if column == 'few' else 'few'} long, {column} long").csv(f"{tmp_path}/{column}")
        assert rows_of(back, "id", "few", "many") == rows_of(rows)
    with pytest.raises(AnalysisException):
        write_delimited(rows, f"{tmp_path}/few", mode="error", partition_by=["few"])
    assert min(seen) > 2 and spark.conf.get(setting) == before
