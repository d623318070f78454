"""Repair of held rows on a stream: what is known of a key is kept as state until its next rows arrive.

The same rules as ``repair_tagged``, one micro-batch for one day's landing: a row that lacks a required value takes
it from the rows of its key that are held; a row that still lacks one is held. What is known of a key is one value per
required column, the greatest of its held rows, whatever their number; it is dropped when the key arrives
complete, and when it has waited longer than ``keep``. Keys are dealt into a fixed number of buckets by their hash: the
rows of a bucket pass a task together, one Arrow batch after the other, and a bucket's state holds its keys as columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from decimal import Decimal
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rowloom.functions.predicates import all_present, any_missing
from rowloom.operators.ingest import tag_valid
from rowloom.operators.joins import join_unique


def _ranked(kind: T.DataType):
    """How values of a type, given as text, are compared."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return lambda text: (math.isnan(float(text)), float(text))
    if isinstance(kind, T.NumericType):
        return Decimal
    if isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
        return lambda text: text.encode()
    raise TypeError(f"values of type {kind.simpleString()} cannot be held")


def _identity(name: str, kind: T.DataType) -> Column:
    """A key's value as text that is equal where the values are."""
    value = F.col(name)
    if isinstance(kind, T.StringType) and kind != T.StringType():
        raise TypeError(f"key {name} of type {kind.simpleString()} cannot be compared as text")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)  # minus zero is zero
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)  # an hour that the clock repeats has one text twice
    return value.cast("string")


class _Held(NamedTuple):
    """What is known of a key, and until when."""

    until: int
    values: tuple[str | None, ...]


def _packed(held: Mapping[str, _Held], width: int) -> bytes:
    texts = [list(held), *([h.values[i] for h in held.values()] for i in range(width))]
    columns = [pa.array([h.until for h in held.values()], pa.int64()), *(pa.array(c, pa.string()) for c in texts)]
    batch = pa.record_batch(columns, [f"c{i}" for i in range(len(columns))])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> dict[str, _Held]:
    until, keys, *texts = (c.to_pylist() for c in pa.ipc.open_stream(packed).read_all().columns)
    values = zip(*texts) if texts else ((),) * len(keys)
    return {k: _Held(*known) for k, known in zip(keys, zip(until, values))}


def stream_repair(
    stream: DataFrame,
    keys: Sequence[str],
    required: Sequence[str],
    landed: str,
    keep: str = "7 days",
    late: str = "1 day",
    buckets: int = 2048,
) -> DataFrame:
    """The stream's rows with ``is_valid``, required values filled from held rows of the same key.

    ``landed`` is a timestamp, the same for all rows of a landing, and each landing is one micro-batch. Held rows are
    part of the result, not valid; ``still_held`` tells which of them no later landing has replaced.
    A key's values are forgotten when ``landed`` of the stream, less ``late``, is ``keep`` past its own. Rows with a null key pass
    as they are. A task holds what is known of one bucket's keys at a time; ``buckets`` has to stay as it is while a
    checkpoint is in use.
    """
    keys, filled = list(keys), [c for c in required if c not in keys]
    kinds = {f.name: f.dataType for f in stream.schema}
    if not isinstance(kinds[landed], T.TimestampType):
        raise TypeError(f"{landed} must be a timestamp with time zone, not {kinds[landed].simpleString()}")
    rank = {c: _ranked(kinds[c]) for c in filled}
    names = stream.columns
    for name in names:
        if not isinstance(kinds[name], T.AtomicType) or isinstance(kinds[name], T.BinaryType):
            raise TypeError(f"column {name} of type {kinds[name].simpleString()} cannot pass as text")
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    held_schema = T.StructType([T.StructField("held", T.BinaryType())])

    def greatest(name: str, values) -> str | None:
        return max((v for v in values if v is not None), key=rank[name], default=None)

    def repair(batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        before = _unpacked(state.get[0]) if state.exists else {}
        after: dict[str, tuple[str | None, ...]] = {}
        arrived: dict[str, int] = {}
        for rows in () if state.hasTimedOut else batches:
            rows = rows.astype(object).where(rows.notna(), None)
            key, landed_ms = rows.pop("key__"), rows.pop("landed_ms__").astype("int64")
            for k, ms in zip(key, landed_ms):
                arrived[k] = max(ms, arrived.get(k, ms))
            known = [before.get(k) for k in key] if before else []
            if any(known):
                for i, name in enumerate(filled):
                    values = (h.values[i] if v is None and h else v for v, h in zip(rows[name], known))
                    rows[name] = pd.Series(list(values), rows.index, dtype=object)
            lacking = rows[list(required)].isna().any(axis=1)
            for k, own in zip(key[lacking], rows.loc[lacking, filled].itertuples(index=False, name=None)):
                so_far = after.get(k)
                after[k] = own if so_far is None else tuple(map(greatest, filled, zip(so_far, own)))
            yield rows
        held = {k: h for k, h in before.items() if k not in arrived and h.until >= now}
        held |= {k: _Held(max(arrived[k] + keep_ms, now + 1), values) for k, values in after.items()}
        if held:
            state.update((_packed(held, len(filled)),))
            state.setTimeoutTimestamp(min(h.until for h in held.values()))
        elif state.exists:
            state.remove()

    marked = stream.withWatermark(landed, late)
    present = marked.where(all_present(keys)).select(
        F.to_json(F.array(*(_identity(k, kinds[k]) for k in keys))).alias("key__"),
        *(F.col(n).cast("string").alias(n) for n in names),
        F.unix_millis(F.col(landed)).alias("landed_ms__"),
        F.col(landed).alias("landed__"),  # the watermark's column has to stay for the timeout
    )
    bucketed = present.withColumn("bucket__", F.pmod(F.xxhash64("key__"), F.lit(buckets)))
    repaired = bucketed.groupBy("bucket__").applyInPandasWithState(
        lambda bucket, batches, state: repair((b[["key__", *names, "landed_ms__"]] for b in batches), state),
        texts, held_schema, "append", GroupStateTimeout.EventTimeTimeout,
    )
    typed = repaired.select(*(F.col(n).cast(kinds[n]).alias(n) for n in names))
    return tag_valid(typed.unionByName(marked.where(any_missing(keys)).select(*names)), required)


def still_held(repaired: DataFrame, keys: Sequence[str], landed: str) -> DataFrame:
    """The held rows of a repaired stream, written as a table, that no later landing of their key has replaced."""
    newest = repaired.where(all_present(keys)).groupBy(*keys).agg(F.max(landed).alias("newest__"))
    held = join_unique(repaired.where(~F.col("is_valid")), newest, list(keys), "left")
    return held.where(F.col("newest__").isNull() | (F.col(landed) == F.col("newest__"))).drop("newest__", "is_valid")
