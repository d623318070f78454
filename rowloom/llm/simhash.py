"""SimHash near-duplicates by a byte-position index with count filtering.

Two 64-bit fingerprints within 3 bits differ in at most 3 of their 8 bytes, so they share at least 5
bytes position by position: the guaranteed minimum. The inverted index posts a fingerprint under its
bytes. A posting list of a single byte would hold 1/256 of all fingerprints, so positions are posted
three together: of any 5 shared positions, at least 3 lie in the same half, and the 8 triples within
the halves are the lists of the index. Each pair that meets in a list has its shared bytes counted; pairs
with fewer than 5 go, the others are verified bit by bit.

Long lists (many fingerprints that share three bytes, as in a large group of near copies) are not
paired: their fingerprints are posted again under those bytes and two of the other five. What shares five
bytes has 24 free bits, so such a list has a bound, and its links are found in one pass over the 2,324
ways in which up to 3 of these bits can differ. A list then hands on a spanning star of each linked set
instead of all its pairs.

Equal fingerprints are one node throughout, however many documents have them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from rowloom.llm.common import whole_text
from rowloom.workspace import materialize

BYTES = 8
#: Lists of up to this many fingerprints are paired; longer ones are posted again.
PAIRED = 64
#: Up to this many fingerprints with five bytes in common are compared one by one, more by difference.
COMPARED = 2048
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def shingle_hashes(text: str, size: int) -> list[int]:
    """XXH64 (seed 42) of the word shingles, repeats included; a shorter text is one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII blanks only
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), 42)] if words else []
    if size == 3:
        return [digest(b"%b %b %b" % w, 42) for w in zip(words, words[1:], words[2:])]
    return [digest(b" ".join(w), 42) for w in zip(*(words[i:] for i in range(size)))]


def fingerprint_of(text: str, size: int) -> int:
    """Signed 64-bit fingerprint: a bit is set if more than half of the hashes have it."""
    hashes = np.array(shingle_hashes(text, size), dtype=np.uint64)
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprint(text: Column, size: int) -> Column:
    @pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, size) for t in texts], index=texts.index, dtype="int64")

    return prints(text)


def byte_mask(positions: tuple[int, ...]) -> int:
    """The bits of these bytes, as a signed number."""
    mask = sum(0xFF << 8 * p for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def shared_bytes(x: Column) -> Column:
    """How many of the 8 byte positions are equal, given the XOR of two fingerprints."""
    zero = [F.when(x.bitwiseAND(F.lit(byte_mask((p,)))) == 0, 1).otherwise(0) for p in range(BYTES)]
    return sum(zero[1:], zero[0])


def flips(mask: int, most: int) -> np.ndarray:
    """All differences of 1 to ``most`` bits outside ``mask``."""
    free = [np.uint64(1 << b) for b in range(64) if not mask >> b & 1]
    return np.array(
        [np.bitwise_or.reduce(c) for n in range(1, most + 1) for c in combinations(free, n)], dtype=np.uint64
    )


def stars(values: np.ndarray, mask: int, bits: int) -> list[tuple[int, int]]:
    """(fingerprint, smallest one linked to it) for distinct ``values`` that agree on ``mask``."""
    values = np.sort(values.view(np.uint64))
    root = np.arange(len(values))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def unite(left: np.ndarray, right: np.ndarray) -> None:
        for i, j in zip(left.tolist(), right.tolist()):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)

    if len(values) <= COMPARED:
        for i in range(len(values) - 1):
            near = np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= bits) + i + 1
            unite(np.full(len(near), i), near)
    else:
        for flip in flips(mask, bits):
            other = values ^ flip
            at = np.searchsorted(values, other)
            found = np.flatnonzero((at < len(values)) & (values[np.minimum(at, len(values) - 1)] == other))
            found = found[at[found] > found]
            unite(found, at[found])
    signed = values.view(np.int64)
    return [(int(signed[i]), int(signed[r])) for i in range(len(values)) if (r := find(i)) != i]


def links(nodes: DataFrame, bits: int) -> DataFrame:
    """(u, v) links between distinct fingerprints (column ``fp``) that span every linked set.

    Two fingerprints surely meet if at most three bytes differ, so ``bits`` is at most 3.
    """
    if bits > 3:
        raise ValueError(f"bits {bits}: the lists link up to 3 differing bits only")
    least = BYTES - bits
    postings = nodes.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(byte_mask(t))).alias("key"))
                    for i, t in enumerate(TRIPLES)
                ]
            )
        ).alias("p"),
    ).select("fp", "p.list", "p.key")
    lengths = postings.groupBy("list", "key").agg(F.count("*").alias("length")).where("length > 1")
    posted = materialize(postings.join(lengths, ["list", "key"]))

    short = posted.where(F.col("length") <= PAIRED)
    pairs = short.alias("a").join(
        short.alias("b"),
        (F.col("a.list") == F.col("b.list")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")),
    )
    differing = pairs.select(
        F.col("a.fp").alias("u"), F.col("b.fp").alias("v"), F.col("a.fp").bitwiseXOR(F.col("b.fp")).alias("x")
    )
    counted = differing.where(shared_bytes(F.col("x")) >= least)
    verified = counted.where(F.bit_count("x") <= bits).select("u", "v")

    again = [(i, t + two) for i, t in enumerate(TRIPLES) for two in combinations(sorted(set(range(BYTES)) - set(t)), 2)]
    lists = F.array(
        *[
            F.when(
                F.col("list") == i,
                F.struct(
                    F.lit(byte_mask(p)).alias("mask"), F.col("fp").bitwiseAND(F.lit(byte_mask(p))).alias("key")
                ),
            )
            for i, p in again
        ]
    )
    fine = (
        posted.where(F.col("length") > PAIRED)
        .select("fp", F.explode(F.array_compact(lists)).alias("p"))
        .select("fp", "p.mask", "p.key")
        .distinct()
    )

    def star(frame: pd.DataFrame) -> pd.DataFrame:
        mask = int(frame["mask"].iloc[0]) & (1 << 64) - 1
        found = stars(frame["fp"].to_numpy().astype(np.int64), mask, bits) if len(frame) > 1 else []
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    dense = fine.groupBy("mask", "key").applyInPandas(star, "u long, v long")
    return verified.union(dense).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link.

    Alternating large and small stars: each round every node links its larger neighbours, then its
    smaller ones, to the smallest it sees, until nothing changes. Rounds grow with the logarithm of the
    longest chain. Each round is written to the shared folder, so nothing is worked out twice.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialize(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    bits: int = 3,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``row`` (a struct of the columns ``keep``, by default the id), ``doc_id``,
    ``fp``, ``root`` and ``component_id``.

    ``root`` names the linked set by one of its fingerprints, ``component_id`` by the smallest id of its
    documents (null if all are null). Null and empty texts have fingerprint zero and link like any other.
    Repeated rows and equal texts share a fingerprint. An empty table gives no rows.
    """
    prints = materialize(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in (keep or [id_column])]).alias("row"),
            F.col(id_column).alias("doc_id"),
            fingerprint(whole_text(text_column), shingle).alias("fp"),
        )
    )
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = materialize(components(links(nodes, bits)))
    rooted = nodes.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    classes = rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"))
    named = rooted.join(classes, F.col("root") == F.col("of")).select(
        F.col("fp").alias("known"), "root", "component_id"
    )
    # a fingerprint that many documents have is a skewed key on the left, which Spark splits at run time
    return prints.join(named, F.col("fp") == F.col("known")).select("row", "doc_id", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", **parameters) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id, any one of equal ids or if all are null."""
    marked = near_duplicates(docs, id_column=id_column, keep=docs.columns, **parameters)
    first = marked.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return first.dropDuplicates(["root"]).select("row.*")
