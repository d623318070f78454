"""Benchmark decontamination by spaced seeds that miss nothing.

Words of a document and of an item are aligned, one point for an equal word, one off for another. Take a
stretch with the most points, the shortest of these: each of its openings has points (or it could be cut off), and
the word before it is unequal or missing (or it could be added). So up to its w-th equal word it is one of a few
patterns, ``opening_masks(w)``, and of its first n words more than half are equal, as long as it has w and n points.

A mask selects the equal words of such a pattern and ignores the others; the hash of the selected words is a
seed. Seeds of all benchmark items are joined with the seeds at every word of every document, hits that are no
such opening are left out, and the best stretch of each alignment that is left decides. Everything is columns
and joins.

Words stand in the seed tables as 32-bit hashes: a row has a text's address, a place, a seed and the hashes of the next
words, whatever the length of the text. Only alignments that are left meet the words themselves, once each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import NOT_WORD, whole_text, words_between
from rowloom.workspace import materialize

#: Equal words that a mask selects, of items that need so many points; fewer for items that need fewer.
WEIGHT = 4
#: Words of a stretch whose points are counted before the whole alignment is.
OPENING = 13
#: The masks that the SQL version seeks by; they miss some stretches, ``opening_masks`` none.
MASKS = ["110110011011", "101111001101", "111001110011"]
#: Tables of up to so many rows of fixed size (some 100 bytes each), and items of up to so many bytes, are broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 300_000, 32 << 20
#: Places of a text that share a row before they are taken apart.
BLOCK = 256


def words_of(text: Column) -> Column:
    """Alphanumeric words without regard to case."""
    return words_between(F.lower(text), NOT_WORD)


def seed(hashes: Column, at: Column, mask: str) -> Column:
    """Hash of the words from ``at`` (from 0) that the mask selects, given the words' hashes."""
    return F.xxhash64(F.lit(mask), *[F.get(hashes, at + i) for i, bit in enumerate(mask) if bit == "1"])


def opening_masks(weight: int) -> list[str]:
    """The patterns, up to the ``weight``-th equal word, in which equal words always outnumber the others."""
    found, grown = [], [("1", 1)]  # a pattern and its points
    while grown:
        mask, points = grown.pop()
        if mask.count("1") == weight:
            found.append(mask)
        else:
            grown += [(mask + "1", points + 1)] + ([(mask + "0", points - 1)] if points > 1 else [])
    return sorted(found)


def seeds(table: DataFrame, name: str, masks: list[str]) -> DataFrame:
    """(name, at, seed, block, place): every mask at every place of ``words`` where it fits.

    ``block`` holds the hashes of the words around, ``place`` the place's number in it. The text is cut into
    blocks first, so that taking places apart copies a block each time and not the text.
    """
    shortest = min(map(len, masks))
    hashed = table.where(F.size("words") >= shortest).select(
        name, F.transform("words", lambda w: F.hash(w)).alias("hashes")
    )
    blocks = hashed.select(
        name, "hashes", F.explode(F.sequence(F.lit(0), F.size("hashes") - 1, F.lit(BLOCK))).alias("start")
    ).select(
        name,
        "start",
        F.slice("hashes", F.col("start") + 1, BLOCK + OPENING).alias("block"),
        F.least(F.lit(BLOCK), F.size("hashes") - F.col("start")).alias("own"),
    )
    placed = blocks.select(name, "start", "block", F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("place"))
    fits = lambda m: F.size("block") - F.col("place") >= len(m)
    each = F.explode(F.array(*(F.when(fits(m), seed(F.col("block"), F.col("place"), m)) for m in masks)))
    found = placed.select(name, (F.col("start") + F.col("place")).alias("at"), each.alias("seed"), "block", "place")
    return found.where("seed is not null")


def best_stretch(equal: Column) -> Column:
    """Struct (score, first, last): the stretch with most equal less unequal words, places from 0.

    ``equal`` is an array of booleans. Of stretches with the same score the one found first counts.
    """
    start = F.struct(
        F.lit(0).alias("at"),
        F.lit(0).alias("run"),
        F.lit(0).alias("begin"),
        F.lit(0).alias("score"),
        F.lit(0).alias("first"),
        F.lit(-1).alias("last"),
    )

    def step(s: Column, e: Column) -> Column:
        begin = F.when(s["run"] <= 0, s["at"]).otherwise(s["begin"])
        run = F.greatest(s["run"], F.lit(0)) + F.when(e, 1).otherwise(-1)
        better = run > s["score"]
        return F.struct(
            (s["at"] + 1).alias("at"),
            run.alias("run"),
            begin.alias("begin"),
            F.when(better, run).otherwise(s["score"]).alias("score"),
            F.when(better, begin).otherwise(s["first"]).alias("first"),
            F.when(better, s["at"]).otherwise(s["last"]).alias("last"),
        )

    return F.aggregate(equal, start, step, lambda s: F.struct(s["score"], s["first"], s["last"]))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_score: int = 13,
    min_share: float = 0.8,
    by_text: bool = False,
) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_words, score): the leaked stretch, once per alignment.

    A stretch leaks if its equal words exceed its unequal ones by ``min_score``, or by ``min_share`` of the
    item's words if that is less; every alignment with such a stretch is found. Items and documents without
    words match nothing, nor does null text. Null ids are kept. A passage that
    stands in a document several times is listed at each place; repeated rows of documents or items give
    repeated results, merged where all columns are equal. With ``by_text`` the document is named by the
    SHA-256 of its text instead of its id. Of stretches of an alignment with equal scores the first counts. Empty
    tables on either side give no rows. A very long text is cut into blocks before its places are taken apart, so
    time and memory grow with its length.
    """
    enough = F.least(F.lit(min_score), F.ceil(F.lit(min_share) * F.size("words")).cast("int"))
    items = (
        benchmark.select(F.col(item_id).alias("item_id"), words_of(whole_text(item_text)).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("item", F.unhex(F.sha2(F.array_join("words", " "), 256)))
        .withColumn("enough", F.greatest(enough, F.lit(1)))
        .withColumn("weight", F.least("enough", F.lit(WEIGHT)))
    )
    known = materialize(items.select("item", "words", "enough", "weight").dropDuplicates(["item"]))
    weights = sorted(r["weight"] for r in known.select("weight").distinct().collect())  # at most WEIGHT rows
    ahead = F.slice("block", F.col("place") + 1, OPENING).alias("ahead")
    own = [
        seeds(known.where(F.col("weight") == w), "item", opening_masks(w)).select(
            "seed", "item", F.col("at").alias("item_at"), ahead
        )
        for w in weights or [WEIGHT]
    ]
    seeded = materialize(
        reduce(DataFrame.unionByName, own)
        .withColumnRenamed("ahead", "item_ahead")
        .join(known.select("item", "enough"), "item")
        .distinct()
    )
    text = whole_text(text_column)
    address = F.unhex(F.sha2(text, 256))
    masks = [mask for w in weights for mask in opening_masks(w)] or opening_masks(WEIGHT)
    places = seeds(docs.select(address.alias("address"), words_of(text).alias("words")), "address", masks)
    hits = materialize(_alignments(places, seeded))

    n_bytes = known.agg(F.sum(F.octet_length(F.array_join("words", " ")) + 16 * F.size("words"))).first()[0] or 0
    bounded = lambda df: F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
    name = F.sha2(text, 256) if by_text else F.col(id_column)
    named = docs.select(name.alias("doc_id"), text.alias("whole"), address.alias("address"))
    lengthy = known.select("item", F.col("words").alias("item_words"), "enough")
    met = (
        named.join(bounded(hits), "address")
        .join(F.broadcast(lengthy) if n_bytes <= BROADCAST_BYTES else lengthy, "item")
        .withColumn("words", words_of(F.col("whole")))
    )
    ids = items.select("item", "item_id").distinct()

    # the aligned part: item word i stands beside document word i + shift
    begin = F.greatest(F.lit(0), -F.col("shift"))
    length = F.least(F.size("item_words") - F.col("begin"), F.size("words") - F.col("shift") - F.col("begin"))
    aligned = (
        met.withColumn("begin", begin)
        .withColumn("length", length)
        .withColumn(
            "best",
            best_stretch(
                F.transform(
                    F.arrays_zip(
                        F.slice("item_words", F.col("begin") + 1, F.col("length")).alias("a"),
                        F.slice("words", F.col("begin") + F.col("shift") + 1, F.col("length")).alias("b"),
                    ),
                    lambda z: z["a"] == z["b"],
                )
            ),
        )
    )
    return (
        aligned.where(F.col("best.score") >= F.col("enough"))
        .join(bounded(ids), "item")
        .select(
            "doc_id",
            "item_id",
            (F.col("begin") + F.col("shift") + F.col("best.first")).cast("long").alias("doc_start"),
            (F.col("begin") + F.col("best.first")).cast("long").alias("item_start"),
            (F.col("best.last") - F.col("best.first") + 1).cast("long").alias("n_words"),
            F.col("best.score").cast("long").alias("score"),
        )
        .distinct()
    )


def _alignments(places: DataFrame, seeded: DataFrame) -> DataFrame:
    """(address, item, shift) where seeds meet and a stretch can open: with points all along, by the words' hashes.

    Equal words have equal hashes, so none is lost. Each alignment is listed once, however many openings it has.
    """
    if seeded.count() <= BROADCAST_ROWS:
        met = places.join(F.broadcast(seeded), "seed")
        word = lambda i: F.get("block", F.col("place") + i)
    else:  # rows of fixed size meet by seed
        light = places.select("address", "at", "seed", F.slice("block", F.col("place") + 1, OPENING).alias("ahead"))
        met = light.join(seeded, "seed")
        word = lambda i: F.get("ahead", F.lit(i))
    counted = F.least(F.col("enough"), F.lit(OPENING))
    equal = lambda i: F.coalesce(word(i) == F.get("item_ahead", F.lit(i)), F.lit(False))
    points = sum((F.when(equal(i) & (counted > i), 1).otherwise(0) for i in range(OPENING)), F.lit(0))
    opens = met.where(points * 2 > counted)
    return opens.select("address", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_column: str = "text", **parameters) -> DataFrame:
    """``docs`` without the rows whose text holds a leaked stretch, whatever their ids."""
    found = overlaps(docs, benchmark, text_column=text_column, by_text=True, **parameters)
    name = "leaked"
    while name in docs.columns:
        name += "_"
    leaked = materialize(found.select(F.col("doc_id").alias(name)).distinct())
    return docs.join(leaked, F.sha2(whole_text(text_column), 256) == F.col(name), "left_anti")
