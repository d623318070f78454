"""One query per text operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import (
    bpe, decontaminate, extraction, licenses, phrases, pii, quality, runs, secret_scan, sharding, simhash, toxicity, warc,
)
from rowloom.llm.common import BLANKS, span_list, table, whole_text, words_between
from rowloom.workspace import scratch_path

SHARDS = 40


def vocabulary() -> str:
    """The path of the public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def licenses_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["word"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    phrases = [t.label for t in licenses.PHRASES]
    # a phrase's label needs its words in a row, a notice's label only the contained words
    notices = F.transform(
        F.filter("matches", lambda m: ~m["label"].isin(phrases)), lambda m: m["label"]
    )
    counted = F.filter("matches", lambda m: ~m["label"].isin(phrases) | F.array_contains(base, m["label"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, notices))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform(counted, lambda m: m["containment"])), F.lit(0.0)).alias("score"),
    )


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, per document."""
    return bpe.encode_texts(docs, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), vocabulary())


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = toxicity.learn(toxicity.labelled_texts(docs, table(spark, sf_dir, "labels")))
    return docs.select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        toxicity.score(whole_text("text"), grammar).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = secret_scan.scan_into_ledger(table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))
    base = F.filter("spans", lambda s: s["kind"].isin(secret_scan.BASE))
    return findings.select(
        F.col("path").alias("doc_id"),
        *[
            F.size(F.filter("spans", secret_scan.is_kind(kind))).cast("long").alias(f"n_{kind}")
            for kind in secret_scan.BASE
        ],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(span_list(F.concat(*pii.BASE)), 256).alias("base_sha256"),
        span_list(F.concat(*pii.BASE, "term")).alias("spans"),
    )


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quality.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return kept.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed", ",").alias("failed_rules"),
    )


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(table(spark, sf_dir, "pages"), scratch_path(spark, "archives"))
    return records.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "text",
        (F.octet_length(whole_text("text")) + 16).cast("long").alias("size"),
        F.crc32(whole_text("text")).alias("text_crc32"),
    )
    dealt = sharding.interleave(docs, SHARDS, keep=["doc_id", "size", "text_crc32"])
    return dealt.select(
        "row.doc_id",
        "row.size",
        "row.text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def repeated_text() -> Column:
    """The text; where a tenth of the ids say so, with its words from one on repeating those that follow it."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        start = (g % n).cast("int")
        period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
        turns = F.ceil((n - start) / period).cast("int")
        copies = F.slice(F.flatten(F.array_repeat(F.slice(words, start + 1, period), turns)), 1, n - start)
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, 1, start), copies), " "))

    # as a lambda's variable the words are split once
    words = F.array(words_between(whole_text("text"), BLANKS))
    return F.when(h % 10 == 0, F.coalesce(F.get(F.transform(words, repeated), 0), whole_text("text"))).otherwise(whole_text("text"))


def runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", repeated_text().alias("text"))
    found = runs.find_periodic_runs(docs)
    # runs come by start and period, so the first of equal exponents stays
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", 0),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def phrases_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_collocations(table(spark, sf_dir, "documents"))


def extraction_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.extract_main_text(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": licenses_query,
    "op2_bpe": bpe_query,
    "op3_toxicity": toxicity_query,
    "op4_simhash": simhash_query,
    "op5_secret_scan": secrets_query,
    "op6_personal_data": pii_query,
    "op7_quality": quality_query,
    "op8_decontamination": decontamination_query,
    "op9_warc": warc_query,
    "op10_sharding": sharding_query,
    "op11_periodic_runs": runs_query,
    "op12_collocations": phrases_query,
    "op13_main_text": extraction_query,
}
