"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of a file is addressed by the SHA-256 of its text. A blob is scanned once per rule
version: blobs whose (blob, rule version) pair stands in the ledger are not scanned again, and copies
are scanned once. Findings are joined back to every path that holds the blob.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.common import no_spans, spans_of, whole_text

RULE_VERSION = "1.2"
LEDGER = "blob string, rule_version string, spans array<struct<kind:string,start:int,end:int,found:string>>"

# The base patterns and least lengths, then this operator's own, in the order of listing.
# A look-behind lets a run of characters be tried only from its first one; it changes no match.
ASSIGN = (
    r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A key runs through its END line, past dashes that begin no such line and no next key; where the END line is
# missing, through what follows of base64 (long runs, or short ones that end a line) and of fields.
LINE_END = r"(?:\\[nr]|[\x0A\x0D\x22']|\z)"
KEY_BODY = r"[^-]{0,}+(?:-{1,4}+[^-]{1,}+|-{5,}+(?:[^-BE]|B[^-E]|E[^-N])[^-]{0,}+){0,}+-{5,}+END [A-Z ]{0,30}PRIVATE KEY-----"
KEY_LINES = (
    r"(?:(?:[\x09-\x0D\x20\x22'>,|*#]|\\[nrt]){0,}+"
    rf"(?:[A-Za-z0-9+/=]{{16,}}+|[A-Za-z0-9+/=]{{1,15}}+[\x20\x09]{{0,}}+{LINE_END}"
    r"|[A-Za-z]{1,}+-[A-Za-z]{1,}+:[^\x0A\x0D\\]{0,}+)){0,}+"
)
# A web token's head has 8 to 1,000 characters, so that a long run of heads is not read to its end from each.
RULES: list[tuple[str, str, int, int]] = [  # kind, pattern, group that must have the least length
    ("assign", ASSIGN, 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{16,}+", 0, 16),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}+", 0, 40),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,1000}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", 0, 30),
    ("pem", rf"-----BEGIN [A-Z ]{{0,30}}PRIVATE KEY-----(?:{KEY_BODY}|{KEY_LINES})", 0, 27),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+", 0, 15),
    ("url", r"://[^\x00-\x20/:@]{0,}+:[^\x00-\x20/@]{1,}+@", 0, 6),
]
BASE = ["assign", "access", "hex"]


def is_long(least: int) -> Callable[[Column], Column]:
    return lambda span: F.length(span["found"]) >= least


def is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def secret_spans(text: Column) -> Column:
    """All findings in ``text``, by start, then in the order of the rules."""
    found = [
        F.when(
            text.rlike(pattern),
            F.filter(spans_of(text, pattern, kind, group), is_long(least)),
        ).otherwise(no_spans())
        for kind, pattern, group, least in RULES
    ]
    order = F.create_map(*[F.lit(x) for i, (kind, *_) in enumerate(RULES) for x in (kind, i)])
    ranked = F.transform(
        F.flatten(F.array(*found)),
        lambda s: F.struct(s["start"].alias("at"), order[s["kind"]].alias("rank"), s.alias("span")),
    )
    return F.transform(F.array_sort(ranked), lambda r: r["span"])


def known_hits(scanned: DataFrame, ledger: DataFrame | None, rule_version: str) -> DataFrame:
    """(blob, rule_version, spans): blobs with findings, scanned now or listed in the ledger, each once."""
    known = scanned if ledger is None else scanned.unionByName(
        ledger.where(F.col("rule_version") == rule_version).select("blob", "rule_version", "spans")
    )
    return known.where(F.size("spans") > 0).dropDuplicates(["blob"])


def scan_versions(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    *,
    path_column: str = "doc_id",
    text_column: str = "text",
    rule_version: str = RULE_VERSION,
) -> tuple[DataFrame, DataFrame]:
    """(findings per version, the ledger's new rows).

    The first table has every row of ``versions`` as (path, blob, spans); the second has (blob,
    rule_version, spans) of the blobs scanned now, to be appended to ``ledger``. Null texts are empty
    blobs, repeated rows are rows of one blob, a null path is kept. The smallest path of a blob brings
    its text to the scan, so a text travels once however many paths share it. Both tables are lazy: a
    caller who uses both writes the ledger's rows first and hands them back as ``ledger``. Findings that start
    together are listed in the order of the rules; an empty table gives no rows. A very long text is matched within its
    row, each rule in time that grows with its length.
    """
    addressed = versions.select(
        F.col(path_column).alias("path"),
        F.sha2(whole_text(text_column), 256).alias("blob"),
        whole_text(text_column).alias("text"),
    )
    paths = addressed.select("path", "blob")
    blobs = paths.groupBy("blob").agg(F.min("path").alias("from"))
    if ledger is not None:
        done = ledger.where(F.col("rule_version") == rule_version).select("blob").distinct()
        blobs = blobs.join(done, "blob", "left_anti")
    sent = addressed.join(
        blobs.select(F.col("blob").alias("new"), "from").hint("shuffle_hash"),
        (F.col("blob") == F.col("new")) & F.col("path").eqNullSafe(F.col("from")),
    )
    scanned = (
        sent.select("blob", secret_spans(F.col("text")).alias("spans"))
        .dropDuplicates(["blob"])
        .select("blob", F.lit(rule_version).alias("rule_version"), "spans")
    )
    return _beside_paths(paths, known_hits(scanned, ledger, rule_version)), scanned


def _beside_paths(paths: DataFrame, hits: DataFrame) -> DataFrame:
    """Every path with the findings of its blob."""
    # as a struct the address is shuffled anew, so that the partition of a blob with very many paths can be split
    found = hits.select(F.struct("blob").alias("hit"), "spans")
    return paths.join(found, F.struct("blob") == F.col("hit"), "left").select(
        "path", "blob", F.coalesce("spans", no_spans()).alias("spans")
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger written at a path; empty if none was."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def scan_into_ledger(
    versions: DataFrame,
    ledger_path: str,
    *,
    path_column: str = "doc_id",
    text_column: str = "text",
    rule_version: str = RULE_VERSION,
) -> DataFrame:
    """Findings per version, (path, blob, spans), after the ledger was brought up to date.

    Blobs that the ledger at ``ledger_path`` lacks under this rule version are scanned and appended to it in one write, which
    is visible as a whole or not at all; findings come from the ledger alone. A scan that was broken off is
    made again by the next call. Rows and cases are those of ``scan_versions``.
    """
    spark = versions.sparkSession
    names = {"path_column": path_column, "text_column": text_column, "rule_version": rule_version}
    _, unseen = scan_versions(versions, read_ledger(spark, ledger_path), **names)
    unseen.write.mode("append").parquet(ledger_path)
    paths = versions.select(F.col(path_column).alias("path"), F.sha2(whole_text(text_column), 256).alias("blob"))
    ledger = read_ledger(spark, ledger_path)
    return _beside_paths(paths, known_hits(ledger.where(F.col("rule_version") == rule_version), None, rule_version))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with the given spans (sorted by start) replaced; overlapping ones share a mark."""

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(
            F.concat(state["out"], gap, F.when(fresh, F.lit(mark)).otherwise(F.lit(""))).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    return F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))),
    )


def redact_secrets(
    docs: DataFrame,
    ledger: DataFrame | None = None,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    rule_version: str = RULE_VERSION,
) -> DataFrame:
    """``docs`` with every finding in the text replaced, those that the ledger lists too.

    Rows without a finding, null texts too, stay as they are.
    """
    _, scanned = scan_versions(
        docs, ledger, path_column=id_column, text_column=text_column, rule_version=rule_version
    )
    # blobs scanned now are listed once already
    found = scanned.where(F.size("spans") > 0) if ledger is None else known_hits(scanned, ledger, rule_version)
    hits = found.select(F.struct("blob", "spans").alias("_hit"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    text = F.col("doc").getField(text_column)
    joined = whole.join(hits, F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256) == F.col("_hit.blob"), "left")
    changed = F.when(F.col("_hit").isNull(), text).otherwise(redact(text, F.col("_hit.spans")))
    return joined.select(
        *[(changed if c == text_column else F.col("doc").getField(c)).alias(c) for c in docs.columns]
    )
