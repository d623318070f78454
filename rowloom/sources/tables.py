"""Plain tables and the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.transforms import Ranged


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    only_touched_partitions: bool = False,
    file_format: str = "parquet",
) -> None:
    """Write a table to a path. ``only_touched_partitions`` replaces just the partitions in ``df``."""
    writer = df.write.format(file_format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_touched_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def daily_partition(df: DataFrame, timestamp: str, partition: str = "partition_date") -> DataFrame:
    """Add the day of a timestamp, to partition by."""
    return df.withColumn(partition, F.to_date(F.col(timestamp)))


def read_where(spark: SparkSession, path: str, wanted: Ranged) -> DataFrame:
    """Rows of a table that meet a condition on a column whose transform it is partitioned by; other folders are not read."""
    return spark.read.parquet(path).where(wanted.partitions).where(wanted.rows)


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def list_namespaces(spark: SparkSession, catalog: str) -> DataFrame:
    return spark.sql(f"SHOW NAMESPACES IN `{catalog}`").withColumn("catalog", F.lit(catalog))


def list_tables(spark: SparkSession, catalog: str, namespace: str = "default") -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{catalog}`.`{namespace}`").withColumn("catalog", F.lit(catalog))


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")
