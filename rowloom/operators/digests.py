"""Reconciliation of rows by digests: equal parts of two tables are told by sums of hashes and never shuffled.

A row's bucket is a hash of its key (or of the whole row). A bucket's digest is the number of its rows and the
sums of two 64-bit hashes of them, so it does not depend on their order, counts repeated rows, and the digest of a
range of buckets is the sum of theirs. Digests are compared from the top: ranges of buckets first, then
the buckets of the ranges that differ. Two tables that are equal exchange digests only; otherwise only the rows of the
buckets that differ are compared, by ``reconcile_rows``.

Rows that differ within a bucket escape only if two sums of 64-bit hashes agree, and the counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators.recon import reconcile_rows
from rowloom.workspace import materialize

#: Bits of a bucket's number and of a range's: 65,536 buckets in 64 ranges.
BITS, RANGE_BITS = 16, 6
#: Up to so many buckets are looked for by a list in the condition; more, by a join with the list.
LISTED = 1000
DIGESTS = "bucket int, part int, n long, h1 decimal(38,0), h2 decimal(38,0)"


def _hash(columns: Sequence[Column], seed: int) -> Column:
    """Nulls count with their place, which the hash function alone would skip."""
    return F.xxhash64(F.lit(seed), *(x for c in columns for x in (c.isNull(), c)))


def bucket_of(columns: Sequence[Column]) -> Column:
    return F.pmod(_hash(columns, 0), F.lit(1 << BITS)).cast("int")


def common_types(source: DataFrame, target: DataFrame) -> T.StructType:
    """The types that a union of both has; hashes are taken of values of these."""
    return source.unionByName(target.select(*source.columns)).schema


def digests(rows: DataFrame, schema: T.StructType, on: Sequence[str] = ()) -> DataFrame:
    """One row per bucket that has rows; combined before the shuffle, so a task hands on a row per bucket."""
    own = [F.col(f"`{f.name}`").cast(f.dataType) for f in schema]
    placed = [F.col(f"`{c}`").cast(schema[c].dataType) for c in (on or schema.names)]
    wide = lambda c: c.cast("decimal(38,0)")
    return (
        rows.select(bucket_of(placed).alias("bucket"), _hash(own, 1).alias("h1"), _hash(own, 2).alias("h2"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(wide(F.col("h1"))).alias("h1"), F.sum(wide(F.col("h2"))).alias("h2"))
        .select("bucket", _range_of("bucket"), "n", "h1", "h2")
    )


def _range_of(bucket: str) -> Column:
    return F.shiftright(F.col(bucket), BITS - RANGE_BITS).cast("int").alias("part")


def differing_buckets(source: DataFrame, target: DataFrame) -> list[int]:
    """Buckets whose digests differ, found from the top down; at most 2**BITS numbers reach the driver."""
    minus = [(-F.col(c)).alias(c) for c in ("n", "h1", "h2")]
    both = source.unionByName(target.select("bucket", "part", *minus))
    sums = [F.sum(c).alias(c) for c in ("n", "h1", "h2")]
    differ = (F.col("n") != 0) | (F.col("h1") != 0) | (F.col("h2") != 0)
    # a table's digest is the sum of its ranges', so one look at the ranges compares both levels
    parts = [r["part"] for r in both.groupBy("part").agg(*sums).where(differ).collect()]
    if not parts:
        return []
    leaves = both.where(F.col("part").isin(parts)).groupBy("bucket").agg(*sums).where(differ)
    return sorted(r["bucket"] for r in leaves.collect())


def _in_buckets(rows: DataFrame, schema: T.StructType, on: Sequence[str], buckets: Sequence[int]) -> DataFrame:
    own = bucket_of([F.col(f"`{c}`").cast(schema[c].dataType) for c in (on or schema.names)])
    if len(buckets) <= LISTED:
        return rows.where(own.isin(list(buckets)))
    listed = rows.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, buckets))).alias("bucket"))
    return rows.join(F.broadcast(listed), own == F.col("bucket"), "left_semi")  # at most 2**BITS rows


def reconcile_rows_by_digest(source: DataFrame, target: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """As ``reconcile_rows``; the digests of both sides are taken, written and compared while this is called.

    ``on`` names columns that rows which differ are likely to share, such as a key, so that both fall in one bucket.
    """
    schema = common_types(source, target)
    own, other = (materialize(digests(side, schema, on)) for side in (source, target))
    buckets = differing_buckets(own, other)
    return _reconciled(source, target, schema, on, buckets)


def _reconciled(source, target, schema, on, buckets) -> DataFrame:
    if not buckets:
        columns = [*schema.fields, T.StructField("MISSING_FROM", T.StringType())]
        return source.sparkSession.createDataFrame([], T.StructType(columns))
    sides = (_in_buckets(side.select(*source.columns), schema, on, buckets) for side in (source, target))
    return reconcile_rows(*sides)


class Digested(NamedTuple):
    """A table written with its digests: rows in a folder per range of buckets, digests (2**BITS rows at most) beside them."""

    path: str

    def rows(self, spark: SparkSession, parts: Sequence[int] | None = None) -> DataFrame:
        rows = spark.read.parquet(f"{self.path}/rows")
        return rows if parts is None else rows.where(F.col("digest_part").isin(list(parts)))

    def digests(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(DIGESTS).parquet(f"{self.path}/digests")


def write_digested(rows: DataFrame, path: str, on: Sequence[str] = ()) -> Digested:
    """Write rows by range of buckets, and the digests of what was written, in the order of ranges.

    Two tables can be reconciled without reading rows where they are equal, if they were written with the same
    columns, types and ``on``.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    placed = [F.col(f"`{c}`") for c in (on or rows.columns)]
    part = F.shiftright(bucket_of(placed), BITS - RANGE_BITS).cast("int").alias("digest_part")
    rows.select("*", part).hint("rebalance", "digest_part").write.partitionBy("digest_part").parquet(f"{path}/rows")
    written = rows.sparkSession.read.schema(schema).parquet(f"{path}/rows")
    digests(written, schema, on).coalesce(1).sortWithinPartitions("part").write.parquet(f"{path}/digests")
    return Digested(path)


def reconcile_digested(spark: SparkSession, source: Digested, target: Digested, on: Sequence[str] = ()) -> DataFrame:
    """As ``reconcile_rows`` for two digested tables; only folders of ranges that differ are read."""
    buckets = differing_buckets(source.digests(spark), target.digests(spark))
    parts = sorted({b >> (BITS - RANGE_BITS) for b in buckets})
    a, b = (side.rows(spark, parts).drop("digest_part") for side in (source, target))
    return _reconciled(a, b, common_types(a, b), on, buckets)
