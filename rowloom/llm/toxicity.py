"""Toxicity by a weighted grammar of finite-state transducers over clauses.

Five transducers make the grammar. The lexical ones read letters: a trie of learned stems writes ``insult`` with a
weight, word lists write ``threat``, ``target``, ``negation`` and ``report``. The three of context read these
symbols, a word at a time, and write them again with a mark: ``scope`` marks what stands behind a negation, or behind a
verb of reporting, within some words; ``aim`` marks what stands within some words of a target, before or after it (a target
still to come is a guess, which dies if none comes). Their arcs are data, each with a factor, and ``compose`` makes
one transducer of them. The best path over a clause gives its weight: the sum, over insults and threats, of
their own weight times the factors of the arcs that read them. A threat without a target weighs nothing.

A text's features are sums over clauses with weight, the share of such words and the largest clause weight; a logistic
model over them gives the score. Stems, weights and the model are learned from labelled rows: a bounded sample of ``SAMPLE``
labels, the parameter ``sample`` of ``labelled_texts``. Every text is scored whole.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from rowloom.llm.common import whole_text
from rowloom.workspace import materialize

#: Lengths of the word beginnings that may be learned as stems.
STEMS = range(4, 9)
#: A clause ends at these or at a line's end.
CLAUSE_END = ".!?;:"
#: Labelled texts that grammar and model are learned from at most.
SAMPLE = 20_000
#: Words whose symbols a task keeps in mind.
KEPT_WORDS = 200_000

# The words of the closed lists, in four languages.
TARGETS = frozenset("you your yours yourself he she they them him her du dich dir ihr euch sie tu te toi vous il elle tú ti usted vosotros él ella".split())
NEGATIONS = frozenset("not never no nor isn't aren't wasn't don't doesn't nicht kein keine nie pas jamais ne no nunca jamás ni".split())
REPORTS = frozenset("said says say called calls call quoted wrote writes sagte sagt schrieb nannte dit disait appelle écrit dijo dice llama escribió".split())
THREATS = frozenset("kill hurt destroy beat töten tuer matar".split())
THREAT_WEIGHT = 0.5
#: Words that a negation, a verb of reporting and a target reach.
NEGATION_REACH, REPORT_REACH, TARGET_REACH = 4, 8, 4

PIECE = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:]+(?=\s|$)|\n|,")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


@dataclass
class Grammar:
    """Weights of stems and of the features that clauses are summed to; factors of the arcs of context."""

    stems: dict[str, float]
    bias: float = 0.0
    weights: tuple[float, ...] = ()
    aimed: float = 1.25
    negated: float = 0.25
    reported: float = 0.4


FEATURES = ("any", "rate", "largest", "clauses", "aimed", "distinct")


# ---- transducers

MATCHES = ("insult", "threat")
PLAIN = ("word", "target", "negation", "report")


class Arc(NamedTuple):
    """From ``state``, reading a symbol: what is written, the factor of what is read, and the next state."""

    state: object
    reads: str
    writes: str
    factor: float
    to: object


@dataclass(frozen=True)
class Transducer:
    """Arcs, the state to start in, and the states to end in."""

    arcs: tuple[Arc, ...]
    start: object
    ends: frozenset

    def table(self) -> dict[tuple[object, str], list[Arc]]:
        out = defaultdict(list)
        for arc in self.arcs:
            out[arc.state, arc.reads].append(arc)
        return dict(out)


def marked(kinds: Sequence[str], marks: Sequence[str]) -> list[str]:
    """Each kind with every choice of the marks, in order."""
    out = list(kinds)
    for mark in marks:
        out += [f"{k} {mark}" for k in out]
    return out


def scope(opener: str, mark: str, factor: float, reach: int, kinds: Sequence[str], until_break: bool) -> Transducer:
    """Marks matches up to ``reach`` words behind an opener. The state counts the words since; 0 is outside."""
    arcs = []
    for s in range(reach + 1):
        following = s + 1 if 0 < s < reach else 0
        arcs += [Arc(s, k, f"{k} {mark}" if s else k, factor if s else 1.0, following) for k in kinds]
        arcs += [Arc(s, w, "word" if w == opener else w, 1.0, 1 if w == opener else following) for w in PLAIN]
        arcs.append(Arc(s, "break", "break", 1.0, 0 if until_break else s))
    return Transducer(tuple(arcs), 0, frozenset(range(reach + 1)))


def aim(factor: float, reach: int, kinds: Sequence[str]) -> Transducer:
    """Marks matches within ``reach`` words of a target. Threats that are not marked weigh nothing.

    Above 0 the state counts the words since a target; below 0, the words left in which a target must come.
    """
    arcs = []
    for s in range(-reach, reach + 1):
        following = s + 1 if s < reach else 0
        dies = s == -1  # the last word in which the target could come
        for k in kinds:
            if not dies:
                arcs += [Arc(s, k, f"{k} aimed", factor, following)] if s else [Arc(s, k, f"{k} aimed", factor, -reach)]
                if s <= 0:
                    arcs.append(Arc(s, k, k, 0.0 if k.startswith("threat") else 1.0, following if s else 0))
        for w in PLAIN:
            if w == "target":
                arcs.append(Arc(s, w, "word", 1.0, 1))
            elif not dies:
                arcs.append(Arc(s, w, w, 1.0, following if s else 0))
        arcs.append(Arc(s, "break", "break", 1.0, s))
    return Transducer(tuple(arcs), 0, frozenset(range(reach + 1)))


def compose(first: Transducer, second: Transducer) -> Transducer:
    """One transducer that does what the second does with what the first writes."""
    table, of_first = second.table(), defaultdict(list)
    for arc in first.arcs:
        of_first[arc.state].append(arc)
    start = (first.start, second.start)
    arcs, found, waiting = [], {start}, [start]
    while waiting:
        state = waiting.pop()
        for a in of_first[state[0]]:
            for b in table.get((state[1], a.writes), ()):
                to = (a.to, b.to)
                arcs.append(Arc(state, a.reads, b.writes, a.factor * b.factor, to))
                if to not in found:
                    found.add(to)
                    waiting.append(to)
    return Transducer(tuple(arcs), start, frozenset(s for s in found if s[0] in first.ends and s[1] in second.ends))


def cascade(aimed: float, negated: float, reported: float) -> list[Transducer]:
    """The transducers of context, in the order in which they read one another."""
    return [
        scope("negation", "negated", negated, NEGATION_REACH, MATCHES, until_break=True),
        scope("report", "reported", reported, REPORT_REACH, marked(MATCHES, ["negated"]), until_break=False),
        aim(aimed, TARGET_REACH, marked(MATCHES, ["negated", "reported"])),
    ]


@lru_cache(maxsize=8)
def context(aimed: float, negated: float, reported: float) -> tuple[dict, object, frozenset]:
    """The composed transducer of context, as a table of arcs, with its start and its ends."""
    first, *others = cascade(aimed, negated, reported)
    for other in others:
        first = compose(first, other)
    return first.table(), first.start, first.ends


class Lexicon:
    """The lexical transducers: stems as a trie over letters, and the closed lists."""

    def __init__(self, stems: dict[str, float]) -> None:
        self.trie: dict = {}
        for stem, weight in stems.items():
            node = self.trie
            for letter in stem:
                node = node.setdefault(letter, {})
            node[""] = weight, stem
        self.known: dict[str, tuple[str, float, str]] = {}

    def read(self, word: str) -> tuple[str, float, str]:
        """(symbol, weight, stem) of a word: the longest stem that it begins with, a whole word before any stem."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > KEPT_WORDS:
                self.known.clear()
            found = self.known[word] = self.look(word)
        return found

    def look(self, word: str) -> tuple[str, float, str]:
        node, insult = self.trie, None
        for letter in word:
            node = node.get(letter)
            if node is None:
                break
            insult = node.get("", insult)
        else:
            insult = node.get("$", {}).get("", insult)
        if insult and (word not in THREATS or insult[0] >= THREAT_WEIGHT):
            return "insult", *insult
        if word in THREATS:
            return "threat", THREAT_WEIGHT, word
        for symbol, words in (("negation", NEGATIONS), ("report", REPORTS), ("target", TARGETS)):
            if word in words:
                return symbol, 0.0, ""
        return "word", 0.0, ""


#: After so many plain words every count of the transducers is back at its start.
FORGOTTEN = max(NEGATION_REACH, REPORT_REACH, TARGET_REACH) + 1


def best_path(symbols: Sequence[tuple[str, float]], table: dict, start, ends: frozenset) -> tuple[float, list[str]]:
    """Weight of the best path over (symbol, weight) pairs, and what it writes for insults and threats.

    Of paths of equal weight the one with more marks counts.
    """
    alive = {start: (0.0, 0, ())}
    for symbol, weight in symbols:
        following: dict = {}
        for state, (total, n_marks, written) in alive.items():
            for arc in table.get((state, symbol), ()):
                if weight:
                    reached = (total + weight * arc.factor, n_marks + arc.writes.count(" "), (written, arc.writes))
                else:
                    reached = (total, n_marks, written)
                if arc.to not in following or reached[:2] > following[arc.to][:2]:
                    following[arc.to] = reached
        alive = following
    total, _, written = max((alive[s] for s in alive if s in ends), key=lambda r: r[:2])
    out = []
    while written:
        written, mark = written
        out.append(mark)
    return total, out[::-1]


def clauses(text: str, lexicon: Lexicon) -> Iterator[tuple[int, list[tuple[str, float, str]]]]:
    """(words, symbols) of each clause; runs of plain words are cut to what the transducers can tell apart."""
    n_words, plain, own, matches = 0, 0, [], False
    for piece in PIECE.findall(text.lower()):
        first = piece[0]
        if first == "\n" or first in CLAUSE_END:
            yield n_words, own if matches else []
            n_words, plain, own, matches = 0, 0, [], False
        elif first == ",":
            own.append(("break", 0.0, ""))
        else:
            n_words += 1
            read = lexicon.read(piece)
            plain = plain + 1 if read[0] == "word" else 0
            if plain <= FORGOTTEN:
                own.append(read)
            matches = matches or read[1] > 0
    yield n_words, own if matches else []


def features(text: str, grammar: Grammar, lexicon: Lexicon | None = None) -> list[float]:
    """The features of a text; all zero if no clause has weight.

    Weights are those of the best paths; counts are of clauses and stems that are neither negated nor reported.
    """
    lexicon = lexicon or Lexicon(grammar.stems)
    table, start, ends = context(grammar.aimed, grammar.negated, grammar.reported)
    n_words, total, largest, aimed, plain, stems = 0, 0.0, 0.0, 0, 0, set()
    for words, symbols in clauses(text, lexicon):
        n_words += words
        if not symbols:
            continue
        weight, marks = best_path([s[:2] for s in symbols], table, start, ends)
        total, largest = total + weight, max(largest, weight)
        read = [(m, s[2]) for m, s in zip(marks, (s for s in symbols if s[1])) if m != "threat"]
        meant = [(m, stem) for m, stem in read if "negated" not in m and "reported" not in m]
        plain += bool(meant)
        aimed += any("aimed" in m for m, _ in meant)
        stems.update(stem for _, stem in meant)
    if not total:
        return [0.0] * len(FEATURES)
    return [
        float(plain > 0),
        math.log1p(200 * total / max(n_words, 50)),
        largest,
        math.log1p(plain),
        math.log1p(aimed),
        math.log1p(len(stems)),
    ]


def stem_counts(labelled: DataFrame) -> DataFrame:
    """(stem, positive, negative): labelled texts that have a word, or a word that begins so.

    ``labelled`` has ``text`` and ``label``. Each text counts once for a stem; whole words end in ``$``.
    """

    @pandas_udf("array<string>")
    def stems_of(texts: pd.Series) -> pd.Series:
        def stems(text: str) -> list[str]:
            words = set(WORD.findall(text.lower()))
            return [*{w[:k] for w in words for k in STEMS if len(w) > k}, *(w + "$" for w in words)]

        return pd.Series([stems(t) for t in texts], index=texts.index, dtype=object)

    return (
        labelled.select("label", F.explode(stems_of("text")).alias("stem"))
        .groupBy("stem")
        .agg(F.sum("label").alias("positive"), F.sum(1 - F.col("label")).alias("negative"))
    )


def learn_stems(labelled: DataFrame, least_texts: int, least_odds: float) -> dict[str, float]:
    """Stems that occur in at least ``least_texts`` toxic texts, with log odds of at least ``least_odds``.

    A longer stem stays only if it says clearly more than the stem it begins with.
    """
    totals = labelled.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    positives, negatives = int(totals[0] or 0), int(totals[1] or 0)
    odds = F.log((F.col("positive") + 0.5) / (positives + 1.0)) - F.log((F.col("negative") + 0.5) / (negatives + 1.0))
    chosen = (
        stem_counts(labelled)
        .where(F.col("positive") >= least_texts)
        .withColumn("odds", odds)
        .where(F.col("odds") >= least_odds)
        .collect()  # no more than the sample's texts hold
    )
    found = {r["stem"]: r["odds"] / 5 for r in chosen}
    return {
        s: w
        for s, w in found.items()
        if not any(s[:k] in found and found[s[:k]] >= w - 0.2 for k in STEMS if k < len(s.rstrip("$")) + s.endswith("$"))
    }


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 50) -> tuple[float, tuple[float, ...]]:
    """Bias and weights by Newton's method with a small ridge."""
    z = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + ridge * len(y) * np.r_[0, w[1:]] / 10
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.eye(len(w)) * (ridge * len(y) / 10 + 1e-6)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), tuple(float(v) for v in w[1:])


def learn(labelled: DataFrame, *, least_texts: int = 5, least_odds: float = 2.5) -> Grammar:
    """A grammar from ``text`` and ``label`` (0 or 1), a bounded table as ``labelled_texts`` gives it.

    Without both labels the grammar is empty and its scores are next to 0.
    """
    labelled = materialize(labelled)
    grammar = Grammar(learn_stems(labelled, least_texts, least_odds))
    rows = labelled.select("label", feature_columns(F.col("text"), grammar).alias("x")).collect()
    rows = sorted((r["label"], r["x"]) for r in rows)  # the same sum order on each run
    y = np.array([label for label, _ in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return Grammar(grammar.stems, -20.0, (0.0,) * len(FEATURES))
    bias, weights = fit_logistic(np.array([x for _, x in rows], dtype=float), y)
    return Grammar(grammar.stems, bias, weights)


def feature_columns(text: Column, grammar: Grammar) -> Column:
    plain = asdict(grammar)

    @pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        own = Grammar(**plain)
        lexicon = Lexicon(own.stems)
        return pd.Series([features(t, own, lexicon) for t in texts], index=texts.index, dtype=object)

    return of(text)


def score(text: Column, grammar: Grammar) -> Column:
    """Probability of label 1. Null must be made empty before; an empty text has no clause and the lowest score.

    Equal texts have equal scores; an empty table has none. A very long text takes time in proportion to its length.
    """
    plain = asdict(grammar)

    @pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        own = Grammar(**plain)
        lexicon, weights = Lexicon(own.stems), np.array(own.weights)
        z = [own.bias + float(np.dot(weights, features(t, own, lexicon))) for t in texts]
        return pd.Series([1 / (1 + math.exp(-max(-30.0, min(30.0, v)))) for v in z], index=texts.index)

    return of(text)


def held_out(id_column: str, folds: int = 5) -> Column:
    """CRC-32 of the id as text, remainder 0; a null id is never held out, nor learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == 0, F.lit(False))


def labelled_texts(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_id: str = "doc_id",
    label_column: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """``text`` and ``label`` of up to ``sample`` labels of 0 or 1 whose id is not held out.

    The labels with the smallest id hashes are taken, so the sample is the same on each run and its size
    bounds what is broadcast. Null ids have no label; repeated ids count with each of their rows.
    """
    known = (
        labels.where(F.col(label_column).isin(0, 1) & F.col(label_id).isNotNull() & ~held_out(label_id))
        .select(F.col(label_id).alias("label_of"), F.col(label_column).cast("int").alias("label"))
        .orderBy(F.xxhash64("label_of"), "label_of", "label")
        .limit(sample)
    )
    return (
        docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
        .join(F.broadcast(known), F.col("id") == F.col("label_of"))
        .select("text", "label")
    )
