"""Information-theoretic sanitisation of personal data.

Protected entities are the addresses, numbers and cards that the base patterns find. Removing them is not
enough where other terms give them away, so the corpus tells how much each term reveals: over documents,
the pointwise mutual information log2(n(e,t) N / (n(e) n(t))) of entity e and term t, relative to the
information log2(N / n(e)) of the entity itself. It is 1 if the term occurs only with the entity. Terms
over the disclosure threshold are generalised, terms of full disclosure removed, in the documents that
hold the entity; all other documents stay as they are. Everything is columns and joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import no_spans, spans_of, whole_text
from rowloom.workspace import materialize

SPANS = "array<struct<kind:string,start:int,end:int,found:string>>"

# The base patterns, in the order of listing. Look-behinds let a run of characters be tried
# only from its first one or where the last match ended, and possessive repeats keep long runs from
# being tried again; both change no match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ["email", "ip", "card", "phone"]
TERM = r"[A-Za-z\x{80}-\x{10FFFF}][0-9A-Za-z\x{80}-\x{10FFFF}_'-]*+"
#: Candidate term tables of up to this many rows are broadcast, larger ones shuffled.
BROADCAST_TERMS = 200_000


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, nines cast out; the sum is a multiple of ten."""
    size = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), size),
        F.lit(0),
        lambda s, i: s
        + F.when(
            (size - i) % 2 == 1,
            (F.substring(digits, i, F.lit(1)).cast("int") * 2) % 10
            + F.floor(F.substring(digits, i, F.lit(1)).cast("int") * 2 / 10).cast("int"),
        ).otherwise(F.substring(digits, i, F.lit(1)).cast("int")),
    )
    return total % 10 == 0


def small_part(part: Column) -> Column:
    """At most 255, however many leading zeros."""
    short = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(short) <= 3) & (F.substring(short, 1, 3).cast("int") <= 255)


def base_rules() -> dict[str, tuple[str, str, Callable[[Column], Column]]]:
    """Per kind: the pattern, a cheaper one that every match holds, and the check that a match must pass."""
    card_size = lambda s: F.length(digits_of(s["found"]))
    return {
        "email": (EMAIL, "@[A-Za-z0-9-]++\\.[A-Za-z0-9-]", lambda s: F.lit(True)),
        "ip": (IP, r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", lambda s: F.forall(F.split(s["found"], r"\."), small_part)),
        "card": (
            CARD,
            r"[0-9](?:[\x20-]?[0-9]){12}",
            lambda s: F.when(card_size(s).between(13, 19), passes_luhn(digits_of(s["found"]))).otherwise(F.lit(False)),
        ),
        "phone": (PHONE, r"\+[0-9]", lambda s: card_size(s).between(9, 15)),
    }


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each kind that pass its check."""
    return {
        kind: F.when(text.rlike(hint), F.filter(spans_of(text, pattern, kind), check)).otherwise(no_spans())
        for kind, (pattern, hint, check) in base_rules().items()
    }


def without_base(text: Column) -> Column:
    """``text`` with a line feed for each base span, one kind after the other; no span holds one, so none is made anew.

    Where spans of two kinds overlap, only characters of which no term can start are left of the second.
    """
    for pattern, _, check in base_rules().values():
        text = _replaced(text, pattern, check)
    return text


def _replaced(text: Column, pattern: str, check: Callable[[Column], Column]) -> Column:
    """``text`` with a line feed for each match of ``pattern`` that passes the check."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    )

    def kept(part: Column) -> Column:
        found = F.when(part["found"].isNull(), "").when(check(part), "\n").otherwise(part["found"])
        return F.concat(F.coalesce(part["gap"], F.lit("")), found)

    return F.array_join(F.transform(parts, kept), "")


def terms_of(text: Column) -> Column:
    """Distinct lower-case terms."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def disclosures(
    held: DataFrame, docs: DataFrame, text_column: str, *, threshold: float, least_texts: int
) -> DataFrame:
    """(entity, term, n_both, ratio): terms that reveal an entity.

    ``held`` has one row per distinct text with entities: ``key``, ``entities`` (distinct), ``terms`` (distinct,
    without those inside a base span) and ``copies``. Copies count as documents, but a term must stand
    beside the entity in ``least_texts`` different texts. Terms are counted over all documents.

    Entities and terms that stand in fewer texts at all are left out first, so a text pairs only what can count.
    """
    owned = held.select("key", "copies", F.explode("entities").alias("entity"))
    entities = materialize(
        owned.groupBy("entity")
        .agg(F.sum("copies").alias("n_e"), F.count("*").alias("texts"))
        .where(F.col("texts") >= least_texts)
    )
    bounded = lambda df: F.broadcast(df) if df.count() <= BROADCAST_TERMS else df
    owners = materialize(owned.join(bounded(entities.select("entity")), "entity", "left_semi"))
    beside = held.join(owners.select("key").distinct(), "key", "left_semi").select("key", F.explode("terms").alias("term"))
    often = beside.groupBy("term").agg(F.count("*").alias("texts")).where(F.col("texts") >= least_texts)
    spoken = beside.join(often.select("term"), "term", "left_semi")
    pairs = materialize(
        owners.select(F.struct("key").alias("of"), "copies", "entity")
        .join(spoken.select(F.struct("key").alias("of"), "term"), "of")
        .groupBy("entity", "term")
        .agg(F.sum("copies").alias("n_both"), F.count("*").alias("texts"))
        .where(F.col("texts") >= least_texts)
    )
    candidates = materialize(pairs.select("term").distinct())
    few = candidates.count() <= BROADCAST_TERMS
    words = docs.select(F.explode(terms_of(whole_text(text_column))).alias("term"))
    if few:
        words = words.join(F.broadcast(candidates), "term", "left_semi")
    counts = words.groupBy("term").agg(F.count("*").alias("n_t"))
    total = docs.count()
    pmi = F.log2(F.col("n_both") * F.lit(float(total)) / (F.col("n_e") * F.col("n_t")))
    own = F.log2(F.lit(float(total)) / F.col("n_e"))
    return (
        pairs.join(entities, "entity")
        .join(counts, "term")
        .withColumn("ratio", F.when(own > 0, pmi / own).otherwise(F.lit(0.0)))
        .where(F.col("ratio") >= threshold)
        .select("entity", "term", "n_both", "ratio")
    )


def find_personal_data(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = 0.9,
    least_texts: int = 3,
    term_length: int = 4,
) -> DataFrame:
    """One row per document: ``doc_id``, ``email``, ``ip``, ``card``, ``phone`` and ``term`` spans, ``text``.

    ``found`` of a term span is ``remove`` or ``generalise``. Null and empty texts have no spans; repeated
    rows are rows of their own; null ids stay null. Terms under ``term_length`` letters reveal nothing.
    Texts without a base span are only matched and counted; the others are written once. A ratio equal to the threshold
    counts as over it; an empty table gives no rows. Of a text with very many addresses and terms only those that stand in
    ``least_texts`` texts meet.
    """
    base = docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"))
    spans = base_spans(F.col("text"))
    marked = base.select("doc_id", "text", *[spans[k].alias(k) for k in BASE])
    any_span = sum((F.size(k) for k in BASE[1:]), F.size(BASE[0])) > 0
    with_data = materialize(marked.where(any_span).withColumn("key", F.sha2("text", 256)))
    entities = F.array_distinct(
        F.flatten(F.array(*[F.transform(k, lambda s: F.concat_ws(":", s["kind"], s["found"])) for k in BASE]))
    )
    held = (
        with_data.groupBy("key")
        .agg(F.count("*").alias("copies"), F.first(F.struct("text", *BASE)).alias("one"))
        .select("key", "copies", "one.*")
        .select(
            "key",
            "copies",
            entities.alias("entities"),
            F.filter(terms_of(without_base(F.col("text"))), lambda t: F.length(t) >= term_length).alias("terms"),
        )
    )
    held = materialize(held)
    shown = disclosures(held, docs, text_column, threshold=threshold, least_texts=least_texts)
    # the terms that a text has to lose, with the most that one of its entities makes of them
    lost = (
        held.select("key", "terms", F.explode("entities").alias("entity"))
        .join(shown, "entity")
        .where(F.array_contains("terms", F.col("term")))
        .groupBy("key", "term")
        .agg(F.max("ratio").alias("ratio"))
        .groupBy("key")
        .agg(
            F.map_from_entries(
                F.collect_list(
                    F.struct("term", F.when(F.col("ratio") > 1 - 1e-9, "remove").otherwise("generalise").alias("how"))
                )
            ).alias("how")
        )
        .select(F.struct("key").alias("of"), "how")  # shuffled anew below, so that a hot text can be split
    )
    inside = lambda s: F.exists(  # noqa: E731  a term span that a base span overlaps
        F.concat(*BASE), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
    )
    term_spans = F.when(
        F.col("how").isNotNull(),
        F.transform(
            F.filter(
                spans_of(F.col("text"), TERM, "term"),
                lambda s: F.col("how")[F.lower(s["found"])].isNotNull() & ~inside(s),
            ),
            lambda s: F.struct(s["kind"], s["start"], s["end"], F.col("how")[F.lower(s["found"])].alias("found")),
        ),
    ).otherwise(no_spans())
    treated = with_data.join(lost, F.struct("key") == F.col("of"), "left").withColumn("term", term_spans)
    clean = marked.where(~any_span).withColumn("term", no_spans())
    columns = ["doc_id", "text", *BASE, "term"]
    return treated.select(columns).unionByName(clean.select(columns))


def sanitise(text: Column, spans: Column) -> Column:
    """``text`` with spans replaced: a removed term by nothing, a generalised one by ``[TERM]``, data by its kind.

    ``spans`` must be sorted by start; what overlaps an earlier span only lengthens it.
    """

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        mark = F.when((s["kind"] == "term") & (s["found"] == "remove"), "").otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        )
        return F.struct(
            F.concat(state["out"], gap, F.when(fresh, mark).otherwise(F.lit(""))).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    return F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))),
    )
