"""Column expressions and table helpers that the text operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.workspace import materialize

#: White space of the word rules that split at blanks.
BLANKS = r"[\x20\x09-\x0D]+"
#: What separates alphanumeric words, upper case already turned into lower case.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Only A-Z become lower case; every other character stays as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_between(text: Column, separators: str) -> Column:
    """The non-empty pieces of ``text`` between matches of ``separators``."""
    return F.array_remove(F.split(text, separators, -1), "")


def spans_of(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (kind, start, end, found), in code points.

    The pieces between matches and the matches themselves alternate, so running lengths give the
    positions. ``found`` is the text of ``group``. The pattern must not match the empty string.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("found"),
    )

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), part["found"].alias("found")
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.aggregate(
        F.filter(parts, lambda p: p["hit"].isNotNull()),
        F.struct(F.lit(0).alias("at"), no_spans().alias("spans")),
        step,
        lambda state: state["spans"],
    )


def no_spans() -> Column:
    return F.array().cast("array<struct<kind:string,start:int,end:int,found:string>>")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def with_positions(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with each row's place (from 0) in the order of ``order``, columns of ``df``.

    The rows are range-partitioned and sorted, written once, and numbered within their partition; only
    one row per partition takes part in the running total, so no task sees more than its range. Rows
    that are equal in ``order`` get adjacent places.
    """
    spark, width = df.sparkSession, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(width, *order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    placed = materialize(
        ranged.select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_local"),
        )
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + F.col("_local")).alias(name)
    )
