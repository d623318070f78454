"""BPE encoding and decoding by a prefix-sharing trie.

The tokens of a prefix of a word are a prefix's own encoding, so the state of a prefix is only its last
token: the one token that ends there, is the encoding of its own text or follows the last token of what
stands before it validly. Distinct words are put in a trie; a depth-first walk hands the states down, and
a prefix that many words share is worked out once. The encoding of a word is read back from its last
state. Words in sorted order visit the trie depth first, so the walk holds one path at a time.

The vocabulary file is a parameter (the ``tokenizers`` JSON of a byte-level BPE with word ends). Texts are
cut into words as that file's normaliser and pre-tokeniser say.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from rowloom.llm.common import whole_text

#: Pieces and seams that a worker keeps in mind; beyond that some are worked out again. No result depends on it.
KEPT_PIECES, KEPT_SEAMS = 300_000, 300_000
#: Letters of the longest piece that is kept.
LONG_PIECE = 200
#: Bytes of text that a task looks at together.
PORTION = 1_000_000


# The letters of byte-level vocabularies.
def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    return [letters[b] for b in range(256)]


class Codec:
    """A vocabulary and what the walk needs of it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = [""] * (max([*self.vocabulary.values(), *self.special.values()]) + 1)
        for name, i in [*self.vocabulary.items(), *self.special.items()]:
            self.names[i] = name
        # tokens inside a word, and tokens that end one, by their letters
        self.inner = {t: i for t, i in self.vocabulary.items() if not t.endswith(self.end)}
        self.final = {t.removesuffix(self.end): i for t, i in self.vocabulary.items() if t.endswith(self.end)}
        # all ends of tokens, to stop looking for longer ones
        self.inner_tails = {t[i:] for t in self.inner for i in range(len(t))}
        self.final_tails = {t[i:] for t in self.final for i in range(len(t))}
        self.parts: dict[int, tuple[int, int]] = {}  # token -> the two tokens it is merged from
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> (rank, token)
        for order, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            i, j, k = (self.vocabulary[x] for x in (left, right, left + right))
            self.parts[k], self.merged[i, j] = (i, j), (order, k)
        self.order = {k: order for order, k in self.merged.values()}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if "pattern" in p)
        self.word = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.white = regex.compile(r"\p{White_Space}+")
        self.separators = regex.compile(r"[\x1c-\x1f]")
        self.cut = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.letters = byte_letters()
        self.valid: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.long: list[str] = []

    # --- words -------------------------------------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        """Normalised runs without white space, and special tokens; these are found in the text as it is."""
        if "<" not in text or not self.special:
            return self.plain_pieces(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [*self.plain_pieces(text[at : m.start()]), f" {m[0]}"]  # the blank tells it from plain text
            at = m.end()
        return out + self.plain_pieces(text[at:])

    def plain_pieces(self, text: str) -> list[str]:
        # each letter by itself, so the capital sigma does not depend on its neighbours
        plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if self.separators.search(plain):  # white space to str.split only
            return [p for p in self.white.split(plain) if p]
        return plain.split()

    # --- the walk ----------------------------------------------------------------------------------

    def follows(self, left: int, right: int) -> bool:
        """Whether merging never crosses the seam between these tokens.

        The merges that made both tokens are undone at the seam, the latest first. If at any moment the two
        tokens at the seam could merge, and would have before the merge just undone, the seam is not one.
        """
        known = self.valid.get((left, right))
        if known is None:
            known = self.valid[left, right] = self.seam_holds(left, right)
        return known

    def seam_holds(self, left: int, right: int) -> bool:
        bound, tie_crosses = len(self.order) + 1, True
        while True:
            crossing = self.merged.get((left, right))
            if crossing and (crossing[0] < bound or crossing[0] == bound and tie_crosses):
                return False
            a, b = self.order.get(left, -1), self.order.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:  # on a tie the left one was merged first, so the right one is undone first
                # the undone merge stands to the left of the seam and wins a tie
                bound, tie_crosses, left = a, False, self.parts[left][1]
            else:
                bound, tie_crosses, right = b, True, self.parts[right][0]

    def whole(self, token: int) -> bool:
        """Whether a token's text is encoded as this token."""
        return token not in self.parts or self.follows(*self.parts[token]) is False and self.rebuilt(token)

    def rebuilt(self, token: int) -> bool:
        """Whether merging the letters of a token gives the token back."""
        parts = [token]
        while any(p in self.parts for p in parts):
            parts = [x for p in parts for x in self.parts.get(p, (p,))]
        while len(parts) > 1:
            rank, at = min(
                ((self.merged[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.merged),
                default=(-1, -1),
            )
            if rank < 0:
                return False
            parts[at : at + 2] = [self.merged[parts[at], parts[at + 1]][1]]
        return parts == [token]

    def last_token(
        self, letters: str, size: int, states: list[int], tokens: dict[str, int], tails: set[str]
    ) -> int:
        """The last token of the encoding of the first ``size`` letters, given the states of all shorter prefixes.

        Candidates are the tokens that end here; longer ends are looked at while some token has them.
        """
        candidates, at = [], size - 1
        while at >= 0 and (tail := letters[at:size]) in tails:
            token = tokens.get(tail)
            if token is not None:
                candidates.append((at, token))
            at -= 1
        for before, token in reversed(candidates):
            if self.follows(states[before], token) if before else self.whole_cached(token):
                return token
        raise ValueError(f"no token ends {letters[:size]!r}")

    def whole_cached(self, token: int) -> bool:
        known = self.valid.get((-1, token))
        if known is None:
            known = self.valid[-1, token] = self.whole(token)
        return known

    def encode_words(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        """Encodings of distinct words: a depth-first walk over their trie."""
        as_letters = sorted((self.spelled(w), w) for w in words)
        out, path, states = {}, "", [-1]
        for spelled, word in as_letters:
            shared, most = 0, min(len(path), len(spelled) - 1)
            while shared < most and path[shared] == spelled[shared]:
                shared += 1  # up to the node where this word leaves the previous one
            del states[shared + 1 :]
            for size in range(shared + 1, len(spelled)):  # the last letter ends the word, it is no inner node
                states.append(self.last_token(spelled, size, states, self.inner, self.inner_tails))
            path = spelled[: len(states) - 1]
            token = self.last_token(spelled, len(spelled), states, self.final, self.final_tails)
            ids, at = [token], len(spelled) - len(self.names[token]) + len(self.end)
            while at:
                ids.append(states[at])
                at -= len(self.names[states[at]])
            out[word] = tuple(reversed(ids))
        return out

    def spelled(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word
        return "".join([self.letters[b] for b in word.encode()])

    def encode_batch(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text. Texts are cut at white space first; each distinct piece is looked up once."""
        pieces = [self.pieces(t) for t in texts]
        if len(self.known) > KEPT_PIECES:  # what is frequent was met early, so the later half goes
            for late in list(self.known)[KEPT_PIECES // 2 :]:
                del self.known[late]
        for long in self.long:  # as long as a portion, perhaps: not kept, so that the count bounds the memory
            self.known.pop(long, None)
        self.long = []
        if len(self.valid) > KEPT_SEAMS:
            self.valid.clear()
        self.known |= {f" {name}": (i,) for name, i in self.special.items()}
        words = {p: self.word.findall(p) for p in set().union(*pieces).difference(self.known)}
        encoded = self.encode_words(set(chain.from_iterable(words.values())))
        self.long = [p for p in words if len(p) > LONG_PIECE]
        for piece, own in words.items():
            self.known[piece] = encoded[own[0]] if len(own) == 1 else tuple(chain.from_iterable(encoded[w] for w in own))
        get = self.known.__getitem__
        return [np.array(list(chain.from_iterable(map(get, p))), np.int32) for p in pieces]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' names, one blank between them: what the file's missing decoder step means."""
        return " ".join(map(self.names.__getitem__, np.asarray(ids).tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per worker process."""
    return Codec(path)


def portions(texts: pa.ChunkedArray | pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of runs of rows with about ``PORTION`` bytes of text; at least one row each."""
    start, size = 0, 0
    for at, length in enumerate(pc.binary_length(texts).to_pylist()):
        if size and size + (length or 0) > PORTION:
            yield start, at - start
            start, size = at, 0
        size += length or 0
    if start < len(texts):
        yield start, len(texts) - start


def encode_texts(docs: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) for every row of ``docs``: token ids, and the text that the ids decode to.

    Null and empty texts have no ids and decode to the empty text; null ids and repeated rows stay as they
    are. Texts pass in portions of about ``PORTION`` bytes (a longer one alone), which with the bounded
    tables of known pieces and seams bounds the memory of a task; a piece without blanks of any length takes time in
    proportion to it. An empty table gives no rows, and no two encodings of a text tie.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = batch.column(1)
            for start, rows in portions(texts):
                ids = own.encode_batch(texts.slice(start, rows).to_pylist())
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                decoded = pa.array([own.decode(i) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, rows), listed, decoded], ["doc_id", "ids", "decoded"]
                )

    return docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text")).mapInArrow(
        code, f"doc_id {kind}, ids array<int>, decoded string"
    )


def decode_ids(ids: Column, path: str) -> Column:
    """The text that a column of token ids decodes to."""

    @pandas_udf("string")
    def text(batches: pd.Series) -> pd.Series:
        return pd.Series([codec(path).decode(i) for i in batches], index=batches.index, dtype=object)

    return text(ids)
