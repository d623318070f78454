"""Partitioned tables with a load log: idempotent loads, snapshots, as-of reads and restore.

A table is a folder with

* ``data/load_id=<n>/slot=<partition>/``: the rows of each load, never changed afterwards;
* ``log/load_id=<n>/``: one row per partition of the load, written after the data, with the table's
  schema as of that load. A load without rows writes one row without a partition, so it keeps its number.

A partition's state at load T is its last ``replace`` up to T and the appends after it.
A load is visible once its log is written; a load that failed before is overwritten by the
next one with its number. Loads of one table must not run at the same time.

The first load declares the columns. Later loads may add columns, which are null in older rows, and
may lack some; a column of another type is refused before anything is written.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.parsing import timestamp_literal
from rowloom.operators.counts import counting

LOG_SCHEMA = (
    "slot string, mode string, n_rows long, load_ts timestamp_ntz, columns string, source string, batch_id long, load_id long"
)
KEYS = T.StructType().add("load_id", T.LongType()).add("slot", T.StringType())


def slot_of(value: Column) -> Column:
    """Folder name of a partition value: always text, never null, so that it keeps its type."""
    return F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("null"))


def value_of(slot: Column, kind: T.DataType) -> Column:
    """The partition value that a folder name stands for."""
    return F.when(slot != "null", F.substr(slot, F.lit(2))).cast(kind)


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether the table has at least one finished load."""
    return not read_log(spark, table).isEmpty()


def read_log(spark: SparkSession, table: str) -> DataFrame:
    """The load log; empty when nothing was loaded yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/log")
    if path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return spark.read.schema(LOG_SCHEMA).parquet(f"{table}/log")
    return spark.createDataFrame([], LOG_SCHEMA)


def log_until(log: DataFrame, load_id: int | None = None, load_ts: datetime | None = None) -> DataFrame:
    """Log entries up to a load or a point in time."""
    if load_id is not None:
        log = log.where(F.col("load_id") <= load_id)
    if load_ts is not None:
        log = log.where(F.col("load_ts") <= timestamp_literal(load_ts))
    return log


def last_load(log: DataFrame) -> tuple[int, T.StructType | None]:
    """Number and schema of the newest load in ``log``: 0 and none if there is no load."""
    newest = log.agg(F.max("load_id"), F.max_by("columns", "load_id")).first()
    return newest[0] or 0, T.StructType.fromJson(json.loads(newest[1])) if newest[1] else None


def agreed_schema(known: T.StructType | None, new: T.StructType) -> T.StructType:
    """The columns of both, those known first; a column whose type differs is an error."""
    plain = [T.StructField(f.name, f.dataType) for f in new]
    if known is None:
        return T.StructType(plain)
    types = {f.name: f.dataType for f in known}
    changed = [f"{f.name}: {types[f.name].simpleString()} to {f.dataType.simpleString()}"
               for f in plain if f.name in types and f.dataType != types[f.name]]
    if changed:
        raise ValueError(f"a load must not change types ({'; '.join(changed)})")
    return T.StructType([*known.fields, *(f for f in plain if f.name not in types)])


def visible_loads(log: DataFrame) -> DataFrame:
    """The log entries that make up the state: per partition the last replace and what follows it."""
    per_slot = Window.partitionBy("slot")
    last_replace = F.max(F.when(F.col("mode") == "replace", F.col("load_id"))).over(per_slot)
    return (
        log.where(F.col("slot").isNotNull())
        .withColumn("base", last_replace)
        .where(F.col("base").isNull() | (F.col("load_id") >= F.col("base")))
        .drop("base")
    )


def visible_rows(spark: SparkSession, table: str, log: DataFrame, slots: Sequence[str] | None = None) -> DataFrame:
    """Rows of the visible loads with ``load_id`` and ``slot``. Only visible folders are read.

    The visible (load, partition) pairs are broadcast whatever the size of the log: there are no more of
    them than folders, all of which Spark lists on the driver for any read of the table.
    """
    _, schema = last_load(log)
    if schema is None:
        raise ValueError(f"{table}: no load up to then")
    data = spark.read.schema(T.StructType([*schema.fields, *KEYS.fields])).parquet(f"{table}/data")
    if slots is not None:
        data, log = data.where(F.col("slot").isin(*slots)), log.where(F.col("slot").isin(*slots))
    loads = visible_loads(log).where(F.col("n_rows") > 0).select("load_id", "slot")
    return data.join(F.broadcast(loads), ["load_id", "slot"], "left_semi")


def slots_where(log: DataFrame, partition_by: str, condition: Column) -> list[str]:
    """The visible partitions whose value meets a condition on the partition column. Reads the log only."""
    _, schema = last_load(log)
    kind = schema[partition_by].dataType if schema else T.StringType()
    slots = visible_loads(log).where(F.col("n_rows") > 0).select("slot").distinct()
    met = slots.withColumn(partition_by, value_of(F.col("slot"), kind)).where(condition)
    return [r["slot"] for r in met.select("slot").collect()]  # at most one per partition


def read_as_of(
    spark: SparkSession,
    table: str,
    load_id: int | None = None,
    load_ts: datetime | None = None,
    partitions: Sequence | None = None,
    partition_by: str | None = None,
    partitions_where: Column | None = None,
) -> DataFrame:
    """The table now, after a load, or at a point in time, with the columns that it had then.

    ``partitions`` or a condition on the partition column, ``partitions_where``, reads only these
    partitions' folders.
    """
    log = log_until(read_log(spark, table), load_id, load_ts)
    slots = None
    if partitions is not None:
        slots = ["null" if p is None else spark.range(1).select(slot_of(F.lit(p))).first()[0] for p in partitions]
    elif partitions_where is not None:
        slots = slots_where(log, partition_by, partitions_where)
    return visible_rows(spark, table, log, slots).drop("load_id", "slot")


def list_partitions(spark: SparkSession, table: str, load_id: int | None = None) -> DataFrame:
    """Partitions of the current or an earlier state with their number of loads and rows. Reads the log only."""
    return (
        visible_loads(log_until(read_log(spark, table), load_id))
        .groupBy("slot")
        .agg(F.sum(F.when(F.col("n_rows") > 0, 1).otherwise(0)).alias("n_loads"), F.sum("n_rows").alias("n_rows"))
        .where(F.col("n_rows") > 0)
        .select(F.when(F.col("slot") != "null", F.expr("substr(slot, 2)")).alias("partition_value"), "n_loads", "n_rows")
    )


def list_snapshots(spark: SparkSession, table: str) -> DataFrame:
    """One row per load: when, what it did, and how many partitions and rows it wrote."""
    replaced = F.max(F.when(F.col("mode") == "replace", 1).otherwise(0)) == 1
    return (
        read_log(spark, table)
        .groupBy("load_id", "load_ts")
        .agg(
            F.when(replaced, "replace").otherwise("append").alias("operation"),
            F.count("slot").alias("n_partitions"),
            F.sum("n_rows").alias("n_rows"),
        )
    )


def load_partition(
    df: DataFrame,
    table: str,
    partition_by: str,
    load_ts: datetime,
    mode: str = "replace",
    emptied: Sequence = (),
    spread: bool = True,
) -> int:
    """Load rows into their partitions and return the load's number.

    With ``replace`` a partition that exists is replaced and one that does not is created,
    so loading the same rows twice leaves them once; ``append`` adds to what is there. The
    partitions are taken from the rows; those in ``emptied`` are replaced even if the load
    has no row for them. ``spread`` lets Spark cut large partitions into several files and
    gather small ones, at the price of a shuffle.
    """
    return load_counted(df, table, partition_by, load_ts, mode, emptied, spread).load_id


class Load(NamedTuple):
    """A load's number and what was counted while its rows were written, ``n_rows`` among it."""

    load_id: int
    totals: dict[str, int]


def load_counted(
    df: DataFrame,
    table: str,
    partition_by: str,
    load_ts: datetime,
    mode: str = "replace",
    emptied: Sequence = (),
    spread: bool = True,
    totals: Mapping[str, Column] | None = None,
    batch: tuple[str, int] | None = None,
) -> Load:
    """As ``load_partition``, with control totals: aggregates over the rows, taken by the tasks that write them.

    ``batch`` names the source and number of a batch. The log keeps it, and a batch that it holds is not loaded
    again: the load it had is returned, without totals.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be 'replace' or 'append', not {mode!r}")
    spark = df.sparkSession
    log = read_log(spark, table)
    if batch is not None and (loaded := load_of_batch(log, *batch)) is not None:
        return Load(loaded, {})
    newest, known = last_load(log)
    load_id, schema = newest + 1, agreed_schema(known, df.schema)

    target = f"{table}/data/load_id={load_id}"
    have = set(df.columns)
    rows = df.select(
        *(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema),
        slot_of(F.col(partition_by)).alias("slot"),
    )
    counted = counting(rows.hint("rebalance", "slot") if spread else rows, totals)
    counted.rows.write.mode("overwrite").partitionBy("slot").parquet(target)
    found = counted.totals()
    _write_log(spark, log, table, target, load_id, load_ts, mode, emptied, schema, not found["n_rows"], batch)
    return Load(load_id, found)


def load_of_batch(log: DataFrame, source: str, batch_id: int) -> int | None:
    """The load that a batch of a source became, if it was loaded."""
    found = log.where((F.col("source") == source) & (F.col("batch_id") == batch_id)).agg(F.max("load_id")).first()
    return found[0]


def _write_log(spark, log, table, target, load_id, load_ts, mode, emptied, schema, is_empty, batch) -> None:
    # counted from the files that were written; only the folder names are read
    written = spark.read.schema("slot string").parquet(target).groupBy("slot").agg(F.count(F.lit(1)).alias("n_rows"))
    if emptied:
        cleared = spark.range(1).select(F.explode(F.array(*(slot_of(F.lit(p)) for p in emptied))).alias("slot"))
        written = (
            written.unionByName(cleared.withColumn("n_rows", F.lit(0).cast("long")))
            .groupBy("slot")
            .agg(F.sum("n_rows").alias("n_rows"))
        )
    if mode == "replace":
        known = visible_loads(log).where(F.col("n_rows") > 0).groupBy("slot").agg(F.lit("replace").alias("known"))
        written = written.join(known, "slot", "left")
        entry = F.when(F.col("known").isNull() & (F.col("n_rows") > 0), "append").otherwise("replace")
    else:
        entry = F.lit("append")
    entries = written.select("slot", entry.alias("mode"), "n_rows")
    if is_empty and not emptied:  # the load keeps its number
        entries = spark.range(1).selectExpr("cast(null as string) slot", "'append' mode", "0L n_rows")
    source, batch_id = batch or (None, None)
    entries.select(
        "*",
        timestamp_literal(load_ts).alias("load_ts"),
        F.lit(schema.json()).alias("columns"),
        F.lit(source).cast("string").alias("source"),
        F.lit(batch_id).cast("long").alias("batch_id"),
    ).write.mode("overwrite").parquet(f"{table}/log/load_id={load_id}")


def changes_between(spark: SparkSession, table: str, before: int, after: int) -> DataFrame:
    """Rows that the table gained or lost between two loads: its columns, ``change`` and ``copies``.

    Only folders that are part of one of the two states are read; what both hold cancels without being
    read, so an append costs the appended rows. Rows are compared as multisets: ``added`` and ``removed`` say how
    many more or fewer copies there are. Columns that the earlier state lacks are null in it.
    """
    log = read_log(spark, table)
    _, schema = last_load(log_until(log, max(before, after)))
    if schema is None:
        raise ValueError(f"{table}: no load up to then")
    states = [
        visible_loads(log_until(log, load)).where(F.col("n_rows") > 0).select("load_id", "slot", F.lit(sign).alias("sign"))
        for load, sign in ((before, -1), (after, 1))
    ]
    # a folder of both states has the signs -1 and 1
    folders = states[0].unionByName(states[1]).groupBy("load_id", "slot").agg(F.sum("sign").alias("sign")).where("sign <> 0")
    data = spark.read.schema(T.StructType([*schema.fields, *KEYS.fields])).parquet(f"{table}/data")
    rows = data.join(F.broadcast(folders), ["load_id", "slot"])
    counted = rows.groupBy(*(f"`{c}`" for c in schema.names)).agg(F.sum("sign").alias("surplus"))
    return counted.where(F.col("surplus") != 0).select(
        *(F.col(f"`{c}`") for c in schema.names),
        F.when(F.col("surplus") > 0, "added").otherwise("removed").alias("change"),
        F.abs("surplus").alias("copies"),
    )


def restore_partition(
    spark: SparkSession, table: str, partition_by: str, partition, load_id: int, load_ts: datetime
) -> int:
    """Bring one partition back to its state after an earlier load, as a new load."""
    earlier = read_as_of(spark, table, load_id=load_id, partitions=[partition])
    return load_partition(earlier, table, partition_by, load_ts, emptied=[partition])


def update_rows(
    spark: SparkSession,
    table: str,
    partition_by: str,
    condition: Column,
    assignments: Mapping[str, Column],
    load_ts: datetime,
    partitions_where: Column | None = None,
) -> int:
    """Change the rows that meet a condition, by replacing the partitions that hold such rows.

    One pass over the columns of the condition finds these partitions, one pass over their folders
    rewrites them. ``partitions_where``, a condition on the partition column, keeps both passes to the
    partitions that meet it.
    """
    if partition_by in assignments:
        raise ValueError("the partition column cannot be updated")
    log = read_log(spark, table)
    hit = F.coalesce(condition, F.lit(False))
    if partitions_where is not None:
        hit = hit & F.coalesce(partitions_where, F.lit(False))
    candidates = None if partitions_where is None else slots_where(log, partition_by, partitions_where)
    touched = visible_rows(spark, table, log, candidates).where(hit).select("slot").distinct()
    slots = [r["slot"] for r in touched.collect()]  # at most one per partition
    current = visible_rows(spark, table, log, slots).drop("load_id", "slot")

    def value(name: str) -> Column:
        if name not in assignments:
            return F.col(name)
        new = assignments[name].cast(current.schema[name].dataType)
        return F.when(hit, new).otherwise(F.col(name)).alias(name)

    # one projection: every right-hand side sees the row as it was
    return load_partition(current.select(*(value(c) for c in current.columns)), table, partition_by, load_ts)
