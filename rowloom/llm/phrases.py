"""Phrases whose words occur together more often than apart, mined as Toivonen does.

A sample of the documents proposes the frequent words and word pairs. One pass over all documents then counts,
exactly, every word and every longer phrase whose two shorter parts (all but its last word, all but its first) were
proposed: the proposed phrases and their negative border, which is what could be frequent if the sample was right.
Where it was not, a phrase of the border turns out frequent; such phrases join the proposed ones, and the next pass
counts what that adds to the border. When no counted phrase is frequent without being a proposed one, nothing
frequent is left uncounted, since every part of a frequent phrase is frequent. With phrases of at most three
words that takes three passes at the most; results do not depend on the sample.

Proposed phrases reach the tasks as a filter of ``filter_bits`` bits, one bit per phrase, whatever their number.
A phrase that meets a foreign bit is counted without need, which changes no result; a filter of a former pass tells
what has been counted, so no phrase is counted twice. Tasks count ``portion`` words at a time and hand on one row per
distinct phrase; Spark adds these up.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import whole_text
from rowloom.operators.joins import join_unique
from rowloom.workspace import materialize

#: Bits of the filter of proposed phrases: 8 MB, broadcast in each pass.
FILTER_BITS = 1 << 26
#: One document in so many is in the sample; what it holds so often is proposed.
SAMPLED, PROPOSED = 8, 2
#: Words that a task counts at a time. Three numbers of words make one of less than 2**63.
PORTION = 2_000_000
UNDEFINED = "und"
MARK = b"\xff"  # no byte of UTF-8
# What ends a piece, and letters that become lower case.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
LETTERS = bytes(MARK[0] if c in ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))

COUNTED = "lang string, words byte, phrase string, n long"
Filter = np.ndarray


def tokens_of(text: bytes) -> list[bytes]:
    """Words in lower case, and a mark at the end of each piece."""
    return text.translate(LETTERS).replace(MARK, b" \xff ").split()


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of pairs from the hashes of their words."""
    h = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29)))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def bits_of(hashes: np.ndarray, words: int, size: int) -> np.ndarray:
    """The bit of each phrase in a filter of ``size`` numbers: words have the lower half, pairs the upper."""
    half = np.uint64(size * 32)
    return (hashes >> np.uint64(16)) % half + half * np.uint64(words - 1)


def passes(known: Filter, bits: np.ndarray) -> np.ndarray:
    return known[bits >> np.uint64(6)] >> (bits & np.uint64(63)) & np.uint64(1) == 1


def distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(numbers, return_counts=True)


def count_phrases(
    lang: str, words: list[bytes], at: np.ndarray, own: int, former: Filter | None, current: Filter | None
) -> Iterator[tuple[int, tuple[np.ndarray, ...], np.ndarray]]:
    """(length, numbers of the words, counts) of the phrases that start among the first ``own`` places.

    ``at`` holds the numbers of the words, as places in ``words``, in the order of the text; number 0 marks the end of a
    piece. ``current`` says which words and pairs are proposed; without it all words and pairs count, no longer
    phrases. ``former`` says which were when the last pass counted; without it nothing has been counted.
    """
    size, hashes = len(words), word_hashes(lang, words)
    at = at.astype(np.int64)
    if former is None:
        times = np.bincount(at[:own], minlength=size)
        times[0] = 0
        yield 0, (), times.sum(keepdims=True)
        met = np.nonzero(times)[0]
        yield 1, (met,), times[met]
    left, right = at[:-1], at[1:]
    pair = (left != 0) & (right != 0)
    counted = pair
    if current is not None:
        proposed = passes(current, bits_of(hashes, 1, len(current)))
        counted = pair & proposed[left] & proposed[right]
        if former is not None:
            before = passes(former, bits_of(hashes, 1, len(current)))
            counted &= ~(before[left] & before[right])
    found, times = distinct((left * size + right)[:own][counted[:own]])
    yield 2, (found // size, found % size), times
    if current is None:
        return
    bits = bits_of(mixed(hashes[left], hashes[right]), 2, len(current))
    proposed = pair & passes(current, bits)
    counted = proposed[:-1] & proposed[1:]
    if former is not None:
        before = pair & passes(former, bits)
        counted &= ~(before[:-1] & before[1:])
    starts = np.nonzero(counted[:own])[0]
    found, times = distinct((at[starts] * size + at[starts + 1]) * size + at[starts + 2])
    yield 3, (found // size // size, found // size % size, found % size), times


class Portion:
    """Texts of one language that wait to be counted, as numbers of their words."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.numbers[MARK]
        self.parts: list[np.ndarray] = []

    def add(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens))


def joined(names: pa.Array, numbers: Sequence[np.ndarray]) -> pa.Array:
    if not numbers:
        return pa.array([b""], pa.binary())
    return pc.binary_join_element_wise(*(names.take(pa.array(n)) for n in numbers), pa.scalar(b" ", pa.binary()))


def counted_phrases(docs: DataFrame, former: Filter | None, current: Filter | None, portion: int) -> DataFrame:
    """Exact counts of the phrases that this pass is to count, over all of ``docs`` (lang, text).

    Rows of no words (``words`` 0) hold the number of all words of a language.
    """
    known = docs.sparkSession.sparkContext.broadcast((former, current))

    def rows_of(lang: str, portion_of: Portion, at: np.ndarray, own: int) -> Iterator[pa.RecordBatch]:
        words = list(portion_of.numbers)
        names = pa.array(words, pa.binary())
        for length, numbers, times in count_phrases(lang, words, at, own, *known.value):
            for i in range(0, len(times), 1 << 16):
                some = joined(names, [n[i : i + (1 << 16)] for n in numbers])
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n), pa.array(np.full(n, length, np.int8)), some.cast(pa.string()), pa.array(times[i : i + n], pa.int64())],
                    ["lang", "words", "phrase", "n"],
                )

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, Portion] = defaultdict(Portion)
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                tokens = tokens_of(text.as_py())
                tokens.append(MARK)
                for start in range(0, len(tokens) - portion, portion):  # phrases belong to the part that they start in
                    alone = Portion()
                    yield from rows_of(lang, alone, alone.add(tokens[start : start + portion + 2]), portion)
                rest = tokens[(len(tokens) - 1) // portion * portion :]
                if held + len(rest) > portion:
                    for name, own in waiting.items():
                        at = np.concatenate(own.parts)
                        yield from rows_of(name, own, at, len(at))
                    waiting.clear()
                    held = 0
                waiting[lang].parts.append(waiting[lang].add(rest))
                held += len(rest)
        for name, own in waiting.items():
            at = np.concatenate(own.parts)
            yield from rows_of(name, own, at, len(at))

    # what tasks hand on is added up already, so it is dealt out before Spark adds it up once
    rows = docs.mapInArrow(tally, COUNTED).repartition("lang", "words", "phrase")
    return rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def filter_of(phrases: DataFrame, size: int) -> Filter:
    """The filter of words and pairs, ``size`` numbers at the most of which reach the driver."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table: dict[tuple[str, int], list[list[bytes]]] = defaultdict(list)
            for lang, words, phrase in zip(*(c.to_pylist() for c in batch.columns)):
                table[lang, words].append(phrase.encode().split(b" "))
            for (lang, words), own in table.items():
                hashes = word_hashes(lang, [w for p in own for w in p])
                bits = bits_of(hashes if words == 1 else mixed(hashes[::2], hashes[1::2]), words, size)
                slot = (bits >> np.uint64(6)).astype(np.int64)
                value = (np.uint64(1) << (bits & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(value)], ["slot", "value"])

    short = phrases.where(F.col("words").between(1, 2)).select("lang", "words", "phrase")
    merged = short.mapInArrow(slots, "slot long, value long").groupBy("slot").agg(F.bit_or("value").alias("value"))
    got = merged.toArrow()
    out = np.zeros(size, np.uint64)
    out[got.column("slot").to_numpy()] = got.column("value").to_numpy().view(np.uint64)
    return out


def frequent_phrases(
    docs: DataFrame,
    least: int,
    sampled: int = SAMPLED,
    proposed: int = PROPOSED,
    filter_bits: int = FILTER_BITS,
    portion: int = PORTION,
) -> DataFrame:
    """(lang, words, phrase, n): all phrases of one to three words that occur ``least`` times or more in a language.

    Rows with ``words`` 0 hold the number of all words of a language.
    """
    enough = (F.col("n") >= least) | (F.col("words") == 0)
    sample = docs.where(F.pmod(F.xxhash64("lang", "text"), F.lit(sampled)) == 0)
    guess = counted_phrases(sample, None, None, portion).where((F.col("n") >= proposed) & F.col("words").between(1, 2))
    size = filter_bits // 64
    former, current, found = None, filter_of(guess, size), None
    while True:
        counted = materialize(counted_phrases(docs, former, current, portion).where(enough))
        found = counted if found is None else found.unionByName(counted)
        grown = current | filter_of(counted, size)
        if (grown == current).all():  # every frequent phrase was a proposed one: the border holds none
            return found
        former, current = current, grown


def mine_collocations(
    docs: DataFrame,
    *,
    least: int = 10,
    covered: int = 50,
    best: int = 2000,
    sampled: int = SAMPLED,
    proposed: int = PROPOSED,
    filter_bits: int = FILTER_BITS,
    portion: int = PORTION,
    lang_column: str = "lang",
    text_column: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of two or three words of each language.

    Only A-Z become lower case. Pieces end at ``[.,;:!?\\x0A-\\x0D]``, words at blanks and tabs. ``a``, ``l`` and ``r``
    count the phrase and the two parts of its weakest cut, ``n`` all words; the score is
    floor(1,000,000 a^2 / (l r)), computed in whole numbers of 38 digits. Phrases under ``least`` occurrences are left
    out, and those inside a longer one of at least ``least`` that occurs at least ``covered`` times in a hundred of theirs. Equal
    scores go by ``a``, then by the phrase's bytes.

    A null language is a language of its own, ``und``, together with one of that name. Null and empty texts have no
    words; repeated rows count as often as they stand; an empty table gives no rows. Long texts are counted in
    parts of ``portion`` words, across whose ends phrases are counted too. Other columns are not read.

    The passes run, and their counts are written, while this is called.
    """
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(UNDEFINED)).alias("lang")
    docs = docs.select(lang, whole_text(text_column).alias("text"))
    found = frequent_phrases(docs, least, sampled, proposed, filter_bits, portion)
    longer = found.where("words >= 2").select("lang", "words", "phrase", F.col("n").alias("a"))
    first, last = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)
    but_last = F.expr("left(phrase, length(phrase) - length(substring_index(phrase, ' ', -1)) - 1)")
    but_first = F.expr("substr(phrase, length(substring_index(phrase, ' ', 1)) + 2)")

    three = longer.where("words = 3")
    covering = (
        three.select("lang", F.explode(F.array_distinct(F.array(but_last, but_first))).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longest"))
    )
    pairs = join_unique(longer.where("words = 2"), covering, ["lang", "phrase"], "left")
    free = pairs.where(F.col("longest").isNull() | (100 * F.col("longest") < covered * F.col("a"))).drop("longest")

    cut = lambda k, a, b: F.struct(F.lit(k).alias("k"), a.alias("left_part"), b.alias("right_part"))
    cuts = F.when(F.col("words") == 2, F.array(cut(1, first, last))).otherwise(
        F.array(cut(1, first, but_first), cut(2, but_last, last))
    )
    parts = found.where("words between 1 and 2")
    rows = free.unionByName(three).select("lang", "phrase", "a", F.inline(cuts))
    for side, times in (("left_part", "l"), ("right_part", "r")):
        rows = join_unique(rows, parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(times)), ["lang", side], "inner")
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    ratio = F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a"))
    whole = F.call_function("div", ratio, wide("l") * wide("r"))
    weakest = (
        rows.groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(whole.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    ranked = top_phrases(weakest, best)
    words = found.where("words = 0").select("lang", "n")
    return join_unique(ranked, words, ["lang"], "inner").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def top_phrases(scored: DataFrame, best: int) -> DataFrame:
    """The first ``best`` of each language, with their rank.

    Ranked within 64 parts of each language first, so that the last ranking of a language gets 64 times ``best`` rows.
    """
    order = "ORDER BY score DESC, a DESC, phrase"
    parts = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    early = parts.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang, part {order})"))
    late = early.where(F.col("rank") <= best).withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang {order})"))
    return late.where(F.col("rank") <= best).withColumn("rank", F.col("rank").cast("long")).drop("part")
