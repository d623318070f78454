"""Quality rules with risk-controlled thresholds.

Every rule is a measure of a text that is high for bad texts. Cutoffs come from labelled documents: a
cutoff may be used in a stratum only if an exact binomial test shows that it rejects at most ``risk``
of the good documents there. The cutoffs of a rule are tested from the most lenient on, up to the first
that fails (a fixed sequence needs no correction); the level is divided by the number of such sequences,
all rules in all strata (Bonferroni), and the risk by the number of rules, so that a stratum's rules
together stay within it. A rule without a proven cutoff does not apply in that stratum.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from rowloom.llm.common import whole_text
from rowloom.workspace import materialize

SYMBOLS = "#*$%&|<>"
WINDOW = 3
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

#: The measures that rules look at, higher is worse, and the cutoffs that are tested.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / n_words", [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]),
    "dup_lines": ("n_dup_lines / n_words", [0.005, 0.01, 0.02, 0.03, 0.05, 0.1, 0.2]),
    "repeats": ("n_repeat_words / n_words", [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45]),
    "long_words": ("word_chars / n_words", [6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0]),
    "short_words": ("- word_chars / n_words", [-6.0, -5.0, -4.5, -4.0, -3.5, -3.0, -2.5, -2.0]),
}


def measure(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated 3-word windows."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
    blanks = sum(text.count(c) for c in " \t\n\v\f\r")
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line in seen:
            repeated += 1
        elif line.strip(" \t\v\f\r"):
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    inside, end = 0, 0  # end: the first word not yet counted
    if len(set(windows)) < len(windows):
        often = {w for w, n in Counter(windows).items() if n > 1}
        for start, window in enumerate(windows):
            if window in often:
                inside += start + WINDOW - max(start, end)
                end = start + WINDOW
    return len(words), len(text) - blanks, sum(text.count(c) for c in SYMBOLS), repeated, inside


def measures(text: Column) -> Column:
    """A struct of the measures."""

    @pandas_udf(MEASURES)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=[m.split()[0] for m in MEASURES.split(", ")])

    return of(text)


def base_failed() -> Column:
    """Under 50 words, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def tail(rejected: int, good: int, risk: float) -> float:
    """P(Binomial(good, risk) <= rejected), summed exactly term by term in logarithms."""
    if rejected >= good:
        return 1.0
    terms = (
        math.lgamma(good + 1) - math.lgamma(k + 1) - math.lgamma(good - k + 1)
        + k * math.log(risk) + (good - k) * math.log1p(-risk)
        for k in range(rejected + 1)
    )
    return min(1.0, math.fsum(math.exp(t) for t in terms))


def tested(counts: Iterator[pd.DataFrame], risk: float) -> Iterator[pd.DataFrame]:
    """Adds the p-value of "rejects more than ``risk`` of the good" to counts of (good, good_rejected)."""
    for frame in counts:
        p = [tail(int(k), int(n), risk) if n else 1.0 for k, n in zip(frame["good_rejected"], frame["good"])]
        yield frame.assign(p=p)


def cutoffs(labelled: DataFrame, *, risk: float, confidence: float) -> DataFrame:
    """(stratum, rule, cutoff) from labelled measures with ``good`` (boolean) and ``stratum``.

    Among the proven cutoffs of a rule the one with most bad documents rejected over good ones counts, then
    the highest. Rules whose cutoff rejects no more bad documents than good ones are left out.
    """
    grid = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.expr(value).alias("value"), F.lit(cutoff).alias("cutoff"))
            for rule, (value, grid) in RULES.items()
            for cutoff in grid
        ]
    )
    counts = (
        labelled.where("not base_failed")
        .select("stratum", "good", F.explode(grid).alias("test"))
        .groupBy("stratum", "test.rule", "test.cutoff")
        .agg(
            F.count_if("good").alias("good"),
            F.count_if(F.col("good") & (F.col("test.value") > F.col("test.cutoff"))).alias("good_rejected"),
            F.count_if(~F.col("good") & (F.col("test.value") > F.col("test.cutoff"))).alias("bad_rejected"),
        )
    )
    counts = materialize(counts)  # one row per stratum, rule and cutoff
    sequences = counts.select("stratum", "rule").distinct().count()
    per_rule, level = risk / len(RULES), (1 - confidence) / max(sequences, 1)
    schema = "stratum string, rule string, cutoff double, good long, good_rejected long, bad_rejected long, p double"
    in_turn = Window.partitionBy("stratum", "rule").orderBy(F.desc("cutoff"))
    passed = (
        counts.mapInPandas(lambda frames: tested(frames, per_rule), schema)
        .withColumn("worst", F.max("p").over(in_turn))  # of this cutoff and all more lenient ones
        .withColumn("gain", F.col("bad_rejected") - F.col("good_rejected"))
        .where((F.col("worst") <= level) & (F.col("gain") > 0))
    )
    best = F.max_by("cutoff", F.struct("gain", "cutoff"))
    return passed.groupBy("stratum", "rule").agg(best.alias("cutoff"))


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str = "lang",
    label_id: str = "doc_id",
    label_column: str = "quality",
    risk: float = 0.05,
    confidence: float = 0.95,
) -> DataFrame:
    """One row per document: id, measures, ``base_failed``, ``failed`` (rules, sorted) and ``kept``.

    A null or empty text has no words, so it fails the base. A null stratum is a stratum of its own. All
    labelled documents serve as holdout (the cutoffs tested are fixed beforehand); null labels are left
    out, a document with several labels counts with each. Without labels only the base rules apply. The
    measures are written once; the texts are read once and not shuffled. Repeated rows are rows of their own and
    values equal to a cutoff pass it; an empty table gives no rows. A very long text is measured within its row, in
    time and memory that grow with its length.
    """
    measured = materialize(
        docs.select(
            F.col(id_column).alias("id"),
            F.coalesce(F.concat(F.lit("="), F.col(stratum_column).cast("string")), F.lit("")).alias("stratum"),
            measures(whole_text(text_column)).alias("m"),
        )
        .select("id", "stratum", "m.*")
        .withColumn("base_failed", base_failed())
    )
    truth = labels.where(F.col(label_column).isNotNull()).select(
        F.col(label_id).alias("label_of"), (F.col(label_column) == 1).alias("good")
    )
    known = measured.join(truth, F.col("id") == F.col("label_of"))
    chosen = cutoffs(known, risk=risk, confidence=confidence)
    # one row per stratum; a map of its rules
    limits = chosen.groupBy(F.col("stratum").alias("of")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits")
    )
    fails = F.array_compact(
        F.array(
            *[
                F.when(F.expr(value) > F.col("limits")[rule], F.lit(rule))
                for rule, (value, _) in sorted(RULES.items())
            ]
        )
    )
    return (
        measured.join(limits, F.col("stratum") == F.col("of"), "left")
        .withColumn("failed", F.coalesce(F.when(F.col("n_words") > 0, fails), F.array().cast("array<string>")))
        .select(
            F.col("id").alias("doc_id"),
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"),
            "failed",
        )
    )
