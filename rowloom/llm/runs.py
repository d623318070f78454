"""Periodic runs of words, found by exact block convolution.

A run is a stretch of consecutive words with smallest period q, at least ``max(SHORTEST, 3 * q)`` words long,
that no neighbouring word extends. For the periods of one dyadic scale, [B, 2 * B) with B = 8, 16, 32 ...
(8 serves the shorter periods too), a run holds a block of B words that starts at a multiple of B from the start
of its text, together with the block's copy one period later: the run less one period has 2 * B - 1 words or more.
So each block is sought in the window that follows it. The sum of squared differences between the block and every
place of the window is, apart from sums of squares, one product of polynomials; it is computed modulo a prime with
number-theoretic transforms of 2 * B points, many blocks at a time. Where it is zero the block recurs, and the
distance is the seed of a run: neighbouring blocks with the same distance are chained, and the chain is extended
by comparing words until one differs, which also settles a sum that is a multiple of the prime.

Two rules leave out blocks that cannot seed a new run. A block whose words do not all recur within the
window has no copy there. A stretch inside a known one of a shorter period q <= B has that
period too, so a longer period there is not the smallest (by the theorem of Fine and Wilf).

Texts are worked on in portions of about ``PORTION`` bytes inside a task, a longer one alone; nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import whole_text

#: 15 * 2**27 + 1, with 31 as a generator: transforms of up to 2**27 points, products within 64 bits.
PRIME, GENERATOR = np.uint64(15 * 2**27 + 1), 31
#: Words of a shortest run, and periods that a run holds at least.
SHORTEST, PERIODS = 24, 3
SMALLEST_BLOCK = 8
PORTION = 1 << 20
#: Numbers in one array of transforms.
TOGETHER = 1 << 18


def roots(points: int, cache: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    """The first ``points / 2`` powers of a primitive root of unity of that order."""
    if points not in cache:
        step, powers = pow(GENERATOR, (int(PRIME) - 1) // points, int(PRIME)), np.ones(1, np.uint64)
        while len(powers) < points // 2:
            factor = np.uint64(pow(step, len(powers), int(PRIME)))
            powers = np.concatenate([powers, powers * factor % PRIME])
        cache[points] = powers[: max(points // 2, 1)]
    return cache[points]


def transform(values: np.ndarray) -> np.ndarray:
    """Number-theoretic transform along axis 0, in place; the result is in bit-reversed order."""
    half, rows = len(values) // 2, values.shape[1]
    while half:
        pairs = values.reshape(-1, 2, half, rows)
        low, high = pairs[:, 0], pairs[:, 1]
        turned = (low + PRIME - high) * roots(2 * half)[None, :, None] % PRIME
        pairs[:, 0] = (low + high) % PRIME
        pairs[:, 1] = turned
        half //= 2
    return values


def back(values: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``, but for the factor of the number of points and the order of the rows.

    Without turning the roots around, row k of the result is row -k of the inverse.
    """
    points, rows, half = len(values), values.shape[1], 1
    while half < points:
        pairs = values.reshape(-1, 2, half, rows)
        turned = pairs[:, 1] * roots(2 * half)[None, :, None] % PRIME
        low = pairs[:, 0].copy()
        pairs[:, 0] = (low + turned) % PRIME
        pairs[:, 1] = (low + PRIME - turned) % PRIME
        half *= 2
    return values


def mismatches(words: np.ndarray, starts: np.ndarray, block: int, nearest: int) -> np.ndarray:
    """Squared differences, modulo the prime, of each block and its window's places: a row per place.

    Row t compares the ``block`` words from ``starts`` with those ``nearest + t`` words later, t < block.
    """
    points, own = 2 * block, np.arange(block)[:, None]
    blocks = words[starts + own]
    windows = words[starts + nearest + np.arange(points)[:, None]]
    squares = np.cumsum(windows * windows % PRIME, axis=0)
    before = np.concatenate([np.zeros((1, len(starts)), np.uint64), squares[: block - 1]])
    sums = (blocks * blocks % PRIME).sum(axis=0) + squares[block - 1 : points - 1] - before
    padded = np.concatenate([blocks, np.zeros_like(blocks)])
    # both transforms run over the words as they stand: the product at -k correlates them, and ``back`` turns k around
    product = transform(windows) * transform(reversed_places(padded)) % PRIME
    products = back(product)[(-np.arange(block)) % points]
    scale = np.uint64(2 * pow(points, -1, int(PRIME)) % int(PRIME))
    return (sums + PRIME - products * scale % PRIME) % PRIME


def reversed_places(values: np.ndarray) -> np.ndarray:
    """Row k of the result is row -k of ``values``, counted round."""
    return np.concatenate([values[:1], values[:0:-1]])


def recurring_blocks(words, starts_of, sizes, gaps, reach, block, nearest) -> np.ndarray:
    """Starts of the blocks that can recur in their window, and not only within a known stretch."""
    first = max(nearest, 1)
    counts = np.where(sizes >= max(SHORTEST, PERIODS * first), (sizes - block - first) // block + 1, 0)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(starts_of, counts) + within * block
    ends = np.repeat(starts_of + sizes, counts)
    alone = np.concatenate([[0], np.cumsum(gaps >= nearest + block)])
    farthest = np.minimum(starts + 2 * block + nearest - 1, ends)
    return starts[(alone[starts + block] == alone[starts]) & (reach(starts) < farthest)]


def extended(words: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How far words stay equal to those ``distance`` later, from ``at`` on in the direction ``step``."""
    steps, open_, width = np.zeros(len(at), np.int64), np.arange(len(at)), 8
    while len(open_):
        rows = max(TOGETHER // width, 1)
        still = []
        for part in (open_[i : i + rows] for i in range(0, len(open_), rows)):
            places = (at[part] + step * steps[part])[:, None] + step * np.arange(width)
            # one past either end is a word that occurs nowhere else, so what is cut off here never counts
            places = np.clip(places, 0, len(words) - 1)
            later = np.minimum(places + distance[part][:, None], len(words) - 1)
            unequal = words[places] != words[later]
            differs = unequal.any(axis=1)
            steps[part] += np.where(differs, unequal.argmax(axis=1), width)
            still.append(part[~differs])
        open_, width = np.concatenate(still), 2 * width
    return steps


def find_runs(words: np.ndarray, starts_of: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period.

    ``words`` holds the numbers of the words of several texts, each followed by a number that occurs nowhere else;
    text i has ``sizes[i]`` words from ``starts_of[i]`` on. The first number occurs nowhere else either.
    """
    order = np.argsort(words, kind="stable")
    gaps = np.full(len(words), len(words), np.int64)
    same = words[order[1:]] == words[order[:-1]]
    gaps[order[:-1][same]] = (order[1:] - order[:-1])[same]
    longest = int(sizes.max(initial=0))
    known = np.empty((0, 3), np.int64)
    padded = None
    block, nearest = SMALLEST_BLOCK, 0
    while PERIODS * max(nearest, 1) <= longest and SHORTEST <= longest:
        by_start = known[np.argsort(known[:, 0], kind="stable")]
        ends = np.maximum.accumulate(np.concatenate([[0], by_start[:, 1]]))
        reach = lambda at: ends[np.searchsorted(by_start[:, 0], at, "right")]  # noqa: E731, B023
        starts = recurring_blocks(words, starts_of, sizes, gaps, reach, block, nearest)
        if len(starts):
            if padded is None or len(padded) < len(words) + 3 * block:
                padded = np.concatenate([words, np.full(3 * block, len(words), words.dtype)]).astype(np.uint64)
            chains = seeds(padded, starts, reach, block, nearest)
            known = np.concatenate([known, stretches(words, *chains, block)])
        block, nearest = (block, block) if not nearest else (2 * block, 2 * block)
    size = known[:, 1] - known[:, 0]
    runs = known[size >= np.maximum(SHORTEST, PERIODS * known[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    smallest = np.ones(len(runs), bool)  # the same stretch under a multiple of its period
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def seeds(padded: np.ndarray, starts: np.ndarray, reach, block: int, nearest: int) -> tuple[np.ndarray, ...]:
    """(start, end, distance) of chains of neighbouring blocks that recur at one distance."""
    at, distance, rows = [], [], max(TOGETHER // (2 * block), 1)
    for some in (starts[i : i + rows] for i in range(0, len(starts), rows)):
        places, which = np.nonzero(mismatches(padded, some, block, nearest) == 0)
        at.append(some[which])
        distance.append(places + nearest)
    at, distance = np.concatenate(at), np.concatenate(distance)
    new = (distance > 0) & (reach(at) < at + block + distance)
    at, distance = at[new], distance[new]
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1] + block) | (distance[1:] != distance[:-1])
    last = np.append(first[1:], True)[: len(at)]
    return at[first], at[last] + block, distance[first]


def stretches(words, at, end, distance, block) -> np.ndarray:
    """Rows (start, end, period) of the widest stretches around chains of equal blocks."""
    whole = np.ones(len(at), bool)
    if len(at):  # a sum of squares may be a multiple of the prime without being zero
        whole = extended(words, at, distance, 1) >= end - at
    at, end, distance = at[whole], end[whole], distance[whole]
    left = extended(words, at - 1, distance, -1)
    right = extended(words, end, distance, 1)
    found = np.stack([at - left, end + right + distance, distance], axis=1)
    return np.unique(found, axis=0) if len(found) else found


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text, given as its words: rows (start, length, period), words numbered from 0."""
    numbers: dict[bytes, int] = defaultdict(count(1).__next__)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    known = [np.fromiter(map(numbers.__getitem__, t), np.int64, len(t)) for t in texts]
    ends = len(numbers) + 1 + np.arange(len(texts))
    words = np.concatenate([[0], *chain.from_iterable((k, [e]) for k, e in zip(known, ends))]).astype(np.int64)
    starts_of = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    found = find_runs(words, starts_of, sizes)
    owner = np.searchsorted(starts_of, found[:, 0], "right") - 1
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    local = np.stack([found[:, 0] - starts_of[owner], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    return [local[a:b] for a, b in zip(cuts, cuts[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, joined by one blank, without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([w for w, depth in zip(words, np.cumsum(change).tolist()) if not depth])


def portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of neighbouring texts of about ``PORTION`` bytes together, one text at least."""
    sizes = np.cumsum([0, *pc.binary_length(texts).to_pylist()])
    start = 0
    while start < len(texts):
        stop = max(int(np.searchsorted(sizes, sizes[start] + PORTION, "right")) - 1, start + 1)
        yield start, stop - start
        start = stop


def find_periodic_runs(docs: DataFrame, *, id_column: str = "doc_id", text_column: str | Column = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs``.

    ``runs`` are structs (start, length, period) in numbers of words, by start and period. ``collapsed`` is the
    text's words joined by one blank, each run cut down to its first period. Words are what stands between
    blanks ``[\\x20\\x09-\\x0D]+``; letters are compared as they are.

    A null or empty text, or one of blanks only, has no words, no runs and the empty collapsed text. Null ids and
    repeated rows stay, each with its own result; no other column is read. An empty table gives no rows. A very long
    text takes memory and, up to a factor of the square of its logarithm, time in proportion to its length.
    Runs of equal start differ in period, so there are no ties.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    text = whole_text(text_column) if isinstance(text_column, str) else F.coalesce(text_column, F.lit(""))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for start, rows in portions(texts):
                split = [t.split() for t in texts.slice(start, rows).to_pylist()]  # at ASCII blanks only
                found = runs_of(split)
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                columns = np.concatenate(found).T if found else np.empty((3, 0), np.int64)
                listed = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(run))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, rows),
                        pa.array([len(w) for w in split], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), listed),
                        pa.array([collapsed(w, r) for w, r in zip(split, found)], pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(F.col(id_column).alias("doc_id"), text.alias("text")).mapInArrow(
        search,
        f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )
