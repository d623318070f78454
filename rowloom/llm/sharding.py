"""Shards that all hold the same mixture: proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; the fractional rank
(2 rank - 1) / (2 rows of the source) spreads each source evenly over the unit interval. All rows
sorted by fractional rank and cut into equal runs give shards whose row counts differ by at most one
and whose share of every source matches the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import whole_text, with_positions


def shuffle_key(id_column: str, seed: int) -> Column:
    """60 bits of MD5 over seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def interleave(
    docs: DataFrame,
    shards: int,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = 42,
    keep: list[str] | None = None,
) -> DataFrame:
    """``row`` (a struct of the columns ``keep``, all if not given), ``shard`` and ``slot`` per row.

    Every row gets a place, repeated rows and equal texts too. A null source is a source of its own, a
    null id shuffles like the empty text. Rows with equal ids are ordered by a digest of their text;
    rows equal in id and text are interchangeable. An empty table gives no rows. With fewer rows than
    shards some shards stay empty. Slots are gapless from 0 in each shard.
    """
    light = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row"),
        F.col(source_column).cast("string").alias("stratum"),
        shuffle_key(id_column, seed).alias("key"),
        F.col(id_column).alias("id"),
        F.md5(whole_text(text_column)).alias("tie"),
    )
    placed = with_positions(light, ["stratum", "key", "id", "tie"], "place")
    strata = placed.groupBy(F.col("stratum").alias("of")).agg(
        F.min("place").alias("first"), F.count("*").alias("rows")
    )
    ranked = placed.join(strata, F.col("stratum").eqNullSafe(F.col("of"))).select(
        "row",
        "stratum",
        "key",
        "id",
        "tie",
        ((2 * (F.col("place") - F.col("first")) + 1) / (2.0 * F.col("rows"))).alias("fraction"),
    )
    spread = with_positions(ranked, ["fraction", "stratum", "key", "id", "tie"], "place")
    total = spread.count()  # the written table's row count
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        spread.withColumn("shard", shard)
        .withColumn("slot", F.col("place") - first)
        .select("row", F.col("shard").cast("int").alias("shard"), "slot")
    )
