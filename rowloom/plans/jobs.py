"""The pipelines end to end. Paths, run dates and connection options are arguments.

No job writes over what it reads: the result goes to a new path, partitioned by outcome
where there are several, so that the input is read and the plan run once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators import cdc, cleanse, ingest, scd2
from rowloom.sources.delimited import CORRUPT, read_delimited, write_delimited
from rowloom.sources.jdbc import read_jdbc, write_jdbc
from rowloom.sources.tables import write_table

NULL_MARK = "\\N"


def _read_checked(
    spark: SparkSession, path: str, schema: T.StructType, sep: str, **options: str
) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the schema, and the text of the lines that do not."""
    rows = read_delimited(spark, path, schema, sep=sep, **options)
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), unreadable_lines(rows).select(CORRUPT)


def _write_tagged(rows: DataFrame, unreadable: DataFrame, path: str, sep: str) -> None:
    write_delimited(rows, f"{path}/rows", sep=sep, null_value=NULL_MARK, partition_by=["is_valid"])
    unreadable.write.mode("overwrite").text(f"{path}/unreadable")


def read_tagged(spark: SparkSession, path: str, schema: T.StructType, is_valid: bool, sep: str = "|") -> DataFrame:
    """The valid or the held rows of an earlier ingestion; none if the part was not written."""
    tagged = T.StructType([*schema.fields, T.StructField("is_valid", T.BooleanType())])
    rows = read_delimited(spark, f"{path}/rows", tagged, sep=sep, null_value=NULL_MARK, check=False)
    return rows.where(F.col("is_valid") == is_valid).drop("is_valid")


def read_unreadable(spark: SparkSession, path: str) -> DataFrame:
    """The lines that an earlier ingestion could not read, in a column ``value``."""
    return spark.read.text(f"{path}/unreadable")


def ingest_first_day(
    spark: SparkSession,
    landing: str,
    target: str,
    schema: T.StructType,
    required: Sequence[str] = ("Quantity_Sold", "Vendor_ID"),
    sep: str = "|",
) -> None:
    """Split the landing files into valid rows, held rows and lines that do not fit the schema."""
    rows, unreadable = _read_checked(spark, landing, schema, sep)
    _write_tagged(ingest.tag_valid(rows, required), unreadable, target, sep)


def ingest_next_day(
    spark: SparkSession,
    landing: str,
    previous: str,
    target: str,
    schema: T.StructType,
    keys: Sequence[str] = ("Sale_ID",),
    required: Sequence[str] = ("Quantity_Sold", "Vendor_ID"),
    sep: str = "|",
) -> None:
    """Repair today's rows from the rows held the day before, split them, and carry the rest of the held rows."""
    today, unreadable = _read_checked(spark, landing, schema, sep)
    held = read_tagged(spark, previous, schema, is_valid=False, sep=sep)
    _write_tagged(ingest.repair_tagged(today, held, keys, required), unreadable, target, sep)


# The columns of the enriched sales, in order.
ENRICHED_COLUMNS = [
    "Sale_ID",
    "Product_ID",
    "Product_Name",
    "Product_Price",
    "Quantity_Sold",
    "Vendor_ID",
    "Sale_Date",
    "Sale_Amount",
    "Sale_Currency",
]


def enrich_day(
    spark: SparkSession,
    ingested: str,
    products: str,
    target: str,
    sales_schema: T.StructType,
    product_schema: T.StructType,
    sep: str = "|",
) -> None:
    """Price the valid sales of a day. One join and one write give the priced sales and, with the reason,
    those whose product is unknown or listed more than once (``read_enriched`` reads either)."""
    sales = read_tagged(spark, ingested, sales_schema, is_valid=True, sep=sep)
    reference, unreadable = _read_checked(spark, products, product_schema, sep)
    priced = ingest.enrich_tagged(sales, reference)
    outcome = F.coalesce("reason", F.lit("enriched")).alias("outcome")
    rows = priced.select(*ENRICHED_COLUMNS, outcome)
    write_delimited(rows, f"{target}/rows", sep=sep, null_value=NULL_MARK, partition_by=["outcome"])
    unreadable.write.mode("overwrite").text(f"{target}/unreadable")


def read_enriched(
    spark: SparkSession, target: str, sales_schema: T.StructType, product_schema: T.StructType, sep: str = "|"
) -> DataFrame:
    """What ``enrich_day`` wrote, with its ``outcome``: enriched, unknown_product or ambiguous_product."""
    empty = lambda schema: spark.createDataFrame([], schema)
    columns = ingest.enrich_tagged(empty(sales_schema), empty(product_schema)).select(*ENRICHED_COLUMNS).schema
    columns = columns.add("outcome", T.StringType())
    return read_delimited(spark, f"{target}/rows", columns, sep=sep, null_value=NULL_MARK, check=False)


def cdc_full_load(
    spark: SparkSession, extract: str, target: str, schema: T.StructType, run_ts: datetime
) -> None:
    """First extract: stamp it and write it as the current records; unreadable lines are rejected with their text."""
    rows = read_delimited(spark, extract, schema)
    stamped = cdc.cdc_initial(rows, run_ts)
    outcome = F.when(F.col(CORRUPT).isNull(), "current").otherwise("rejected")
    write_table(stamped.withColumn("outcome", outcome), target, partition_by=["outcome"], mode="error")


def read_outcome(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All that a load wrote, with its ``outcome``; parts that were not written have no rows."""
    stamps = [T.StructField(c, T.TimestampNTZType()) for c in cdc.STAMPS]
    text = [T.StructField(CORRUPT, T.StringType()), T.StructField("outcome", T.StringType())]
    plain = [T.StructField(f.name, f.dataType) for f in schema.fields]
    return spark.read.schema(T.StructType([*plain, *stamps, *text])).parquet(path)


def cdc_delta_load(
    spark: SparkSession,
    extract: str,
    master: str,
    target: str,
    schema: T.StructType,
    keys: Sequence[str],
    run_ts: datetime,
) -> cdc.CdcResult:
    """Apply an extract to the current records of ``master`` and write all outcomes to the new path ``target``.

    A line that does not fit the schema is rejected with its text. Where its key can be read, the record
    of that key stays as it is, and so do readable rows of that key get rejected: what the source holds
    for it is not known.
    """
    current = read_outcome(spark, master, schema).where("outcome = 'current'").drop("outcome", CORRUPT)
    delta = read_delimited(spark, extract, schema)
    outcome = cdc.cdc_outcome_checked(current, delta, keys, CORRUPT, run_ts)
    write_table(outcome, target, partition_by=["outcome"], mode="error")
    written = read_outcome(spark, target, schema)
    part = lambda name: written.where(F.col("outcome") == name).drop("outcome")
    return cdc.CdcResult(
        part("current").drop(CORRUPT), part("deleted").drop(*cdc.STAMPS, CORRUPT), part("rejected").drop(*cdc.STAMPS)
    )


def dimension_load(
    spark: SparkSession,
    dimension: str,
    delta: DataFrame,
    target: str,
    keys: Sequence[str],
    compare: Sequence[str],
    run_date: date,
    audit: scd2.Versioning = scd2.Versioning(),
    missing: str = "keep",
) -> None:
    """Apply an extract to a dimension and write it to a new path, closed and open versions apart."""
    merged = scd2.scd2_merge(
        spark.read.parquet(dimension), delta, keys, compare, run_date, audit=audit, missing=missing
    )
    write_table(merged, target, partition_by=[audit.flag], mode="error")


def clean_statement(rows: DataFrame) -> DataFrame:
    """Bank statement: number, amounts and dates get their types."""
    return cleanse.cleanse(
        rows,
        drop=["DOT", "CHQNO"],
        casts={"AccountNo": "long"},
        amounts=["WITHDRAWALAMT", "DEPOSITAMT", "BALANCEAMT"],
        dates={"DATE": ["dd-MMM-yy"], "VALUEDATE": ["dd-MMM-yy"]},
    )


# Columns of the user file that carry nothing.
UNUSED_USER_COLUMNS = ("SNO", *(f"DELETE_COLUMN{i}" for i in range(1, 8)))


def clean_users(rows: DataFrame) -> DataFrame:
    """User file: drop unused columns, keep rows that state both flags."""
    return cleanse.cleanse(rows, drop=UNUSED_USER_COLUMNS, required=["HAS_SSN", "EMPLOYEE_STATUS"], report=None)


def eligible_users(rows: DataFrame) -> DataFrame:
    """Users for whom all three flags are true, with plain phone numbers."""
    return cleanse.cleanse(
        rows, phones=["PHONE"], all_true=["US_CITIZEN", "HAS_SSN", "EMPLOYEE_STATUS"], report=None
    )


# The city codes and what they stand for; any other code stands for the second.
CITIES, OTHER_CITY = {"hyd": "hyderabad"}, "visakhapatnam"


def transform_customers(rows: DataFrame) -> DataFrame:
    """Spell out the city, move the date of birth by two days and the number by one."""
    recoded = cleanse.recode(rows, "city", CITIES, default=OTHER_CITY)
    return cleanse.shift_customer(recoded)


def transform_customer_table(
    spark: SparkSession, source: Mapping[str, str], target: Mapping[str, str], **split
) -> None:
    """Read customers from a database, transform them, and append them to another table."""
    write_jdbc(transform_customers(read_jdbc(spark, source, **split)), target, mode="append")


def unreadable_lines(rows: DataFrame) -> DataFrame:
    """Lines that ``read_delimited`` or ``parse_delimited_text`` could not fit to the schema."""
    return rows.where(F.col(CORRUPT).isNotNull())
