"""Append-only ingestion of a stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowloom.operators.ingest import tag_valid
from rowloom.sources import lake


def kafka_source(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest", **options: str
) -> DataFrame:
    """Subscribe to a topic. Needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).option("startingOffsets", starting_offsets).options(**options).load()


def decode_messages(stream: DataFrame) -> DataFrame:
    """Key and value of each message as text."""
    return stream.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def stream_ingest(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    sink: str = "parquet",
    partition_by: Sequence[str] = (),
    every: str | None = None,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append a stream to a sink and return the running query.

    ``every`` sets the micro-batch interval; without it the query takes what is available
    and ends. The checkpoint makes a file sink exactly-once across restarts.
    """
    writer = stream.writeStream.outputMode("append").format(sink).option("checkpointLocation", checkpoint)
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.options(**(options or {}))
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def stream_console(stream: DataFrame, checkpoint: str, every: str | None = "2 seconds") -> StreamingQuery:
    """Show a stream untruncated on the console."""
    return stream_ingest(stream, checkpoint, sink="console", every=every, options={"truncate": "false"})


def stream_split(
    stream: DataFrame,
    required: Sequence[str],
    checkpoint: str,
    path: str,
    every: str | None = None,
) -> StreamingQuery:
    """Write valid and held rows of a stream in one pass, to ``is_valid=true`` and ``is_valid=false``."""
    return stream_ingest(
        tag_valid(stream, required), checkpoint, path, partition_by=["is_valid"], every=every
    )


def stream_load(
    stream: DataFrame,
    table: str,
    partition_by: str,
    checkpoint: str,
    load_ts: Callable[[int], datetime],
    source: str,
    mode: str = "append",
    every: str | None = None,
    after_load: Callable[[int, lake.Load], None] | None = None,
) -> StreamingQuery:
    """Load each micro-batch into a partitioned table, once, and return the running query.

    A batch's rows become one load, whose log entry holds ``source`` and the batch's number. If the query ends between
    the load and its own checkpoint, Spark repeats the batch after a restart; the log then holds it already,
    and nothing is loaded. A batch that failed before its log entry is not visible and is written anew.
    ``load_ts`` gives the time of a batch's load, and ``after_load`` is told of each load.
    """

    def load(rows: DataFrame, batch_id: int) -> None:
        done = lake.load_counted(rows, table, partition_by, load_ts(batch_id), mode, batch=(source, batch_id))
        if after_load is not None:
            after_load(batch_id, done)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
