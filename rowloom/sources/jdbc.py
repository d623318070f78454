"""Database tables over JDBC. Connection options, credentials included, come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    split_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    splits: int | None = None,
) -> DataFrame:
    """Read a table. With a split column, its bounds and a number of splits, that many tasks read in parallel.

    The bounds only place the cuts; rows outside them are read too.
    """
    reader = spark.read.format("jdbc").options(**options)
    if split_column is not None:
        if bounds is None or splits is None:
            raise ValueError("split_column needs bounds and splits")
        reader = reader.options(
            partitionColumn=split_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=splits
        )
    return reader.load()


def read_jdbc_slices(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: Mapping[str, str]
) -> DataFrame:
    """Read a table with one task per predicate, for keys that are not evenly spread."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "append", batch_size: int = 10_000) -> None:
    """Append to a table, or overwrite it. ``numPartitions`` in the options bounds the open connections."""
    df.write.format("jdbc").options(batchsize=batch_size, **options).mode(mode).save()
