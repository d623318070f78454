"""Small helpers to build frames and compare rows without regard to order."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def frame(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    """A small local table; by way of Arrow, so that using it starts no Python worker."""
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = zip(*rows) if rows else ([] for _ in struct)
    table = pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, struct)


def rows_of(df: DataFrame, *columns: str) -> Counter:
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def same(df: DataFrame, expected: list[tuple], *columns: str) -> None:
    assert rows_of(df, *columns) == Counter(expected)


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
