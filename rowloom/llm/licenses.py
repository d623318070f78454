"""License scans as an exact set-similarity join of text blocks and templates.

A text's words are cut into overlapping blocks of ``2 * step`` words, one every ``step``, so that every run of up
to ``step + 1`` words lies whole in the block in whose first half it starts. The step is 32, doubled for templates
of more than 33 words until it suffices. A template matches a block if the block contains at least ``threshold`` of the
template's distinct words. The join finds all such pairs without comparing all of them:

* tokens are ordered by their frequency in the whole corpus, rarest first;
* prefix filter: of a template with n tokens that needs k in common, one of the first n - k + 1 must be
  in the block, and likewise one of the first m - k + 1 of the block's m template tokens. So the templates are indexed by
  these tokens only, and a block meets a template only through a token that both have there;
* length filter: the block must have k template tokens at all;
* positional filter: what is left behind the positions of the first common token must suffice for k.

Pairs that pass are verified by their exact overlap. The phrases are templates of threshold 1; within
their matched blocks the places where their words stand consecutively are counted.

The templates are an argument, so their index goes to every task; the work on a block grows with the index entries that it
meets, not with the number of templates.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import NOT_WORD, whole_text

#: Words from one block to the next, and in a block, for templates of up to 33 words.
STEP, BLOCK = 32, 64


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    threshold: float = 0.8
    is_phrase: bool = False

    @property
    def tokens(self) -> set[str]:
        return set(self.words.split())

    @property
    def needed(self) -> int:
        return math.ceil(self.threshold * len(self.tokens) - 1e-9)

    @property
    def step(self) -> int:
        step, size = STEP, len(self.words.split())
        while size > step + 1:
            step *= 2
        return step


def whole_license(label: str, text: str, threshold: float = 0.8) -> Template:
    """A template of a license's whole text."""
    return Template(label, " ".join(re.findall("[a-z0-9]+", text.lower())), threshold)


# The phrases and their labels.
PHRASES = [
    Template("mit", "under the mit license", 1.0, True),
    Template("apache-2", "apache license version 2", 1.0, True),
    Template("cc-by-nc", "cc by nc", 1.0, True),
]
#: Sentences of license notices.
NOTICES = [
    Template("agpl", "licensed under the gnu affero general public license"),
    Template(
        "apache-2-notice",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ),
    Template(
        "bsd-notice",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    Template("cc-by-sa", "licensed under the creative commons attribution sharealike license"),
    Template("gpl", "this work is licensed under the gnu general public license"),
    Template(
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation",
    ),
    Template("lgpl", "licensed under the gnu lesser general public license"),
    Template(
        "mit-notice",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files",
    ),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("proprietary", "all rights reserved no part of this publication may be reproduced"),
]
# Whole texts of short licenses.
WHOLE = [
    whole_license(
        "mit-text",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    whole_license(
        "isc-text",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    ),
    whole_license(
        "bsd-2-text",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
        LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    whole_license(
        "zlib-text",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being
        the original software. This notice may not be removed or altered from any source distribution.""",
    ),
]
TEMPLATES = PHRASES + NOTICES + WHOLE


def token_counts(docs: DataFrame, text_column: str, vocabulary: list[str]) -> dict[str, int]:
    """How often each token of the templates occurs in all texts; at most one row per token is fetched.

    The text is cut at everything that is no lower-case word character after A-Z became lower case; here
    upper case is matched directly, which spares a copy of the text.
    """
    separators = NOT_WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    words = docs.select(F.explode(F.split(whole_text(text_column), separators, -1)).alias("cased"))
    counted = words.select(F.lower("cased").alias("word")).where(F.col("word").isin(vocabulary)).groupBy("word").count()
    return {r["word"]: r["count"] for r in counted.collect()}  # no more rows than template tokens


#: Bytes of text as word bytes in lower case; everything that is no word becomes a blank.
LETTERS = bytes(c if c >= 0x80 or chr(c).isalnum() and not 65 <= c <= 90 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class Index:
    """Templates by the tokens of their prefixes, for each step of blocks."""

    def __init__(self, templates: list[Template], counts: dict[str, int]) -> None:
        self.templates = [t for t in templates if t.tokens]
        order = sorted({w for t in self.templates for w in t.tokens}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w.encode(): i for i, w in enumerate(order)}
        self.tokens = [frozenset(self.rank[w.encode()] for w in t.tokens) for t in self.templates]
        self.phrases = [[w.encode() for w in t.words.split()] if t.is_phrase else [] for t in self.templates]
        #: step -> token -> (template, position of the token in it)
        self.prefixes: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for number, (t, own) in enumerate(zip(self.templates, self.tokens)):
            for position, token in enumerate(sorted(own)[: len(own) - t.needed + 1]):
                self.prefixes[t.step][token].append((number, position))
        self.prefixes = {step: dict(own) for step, own in self.prefixes.items()}

    @cached_property
    def needed(self) -> list[int]:
        return [max(t.needed, 1) for t in self.templates]

    @cached_property
    def probes(self) -> frozenset[bytes]:
        met = {token for own in self.prefixes.values() for token in own}
        return frozenset(w for w, i in self.rank.items() if i in met)

    def candidates(self, tokens: list[int], own: dict[int, list[tuple[int, int]]]) -> list[int]:
        """Templates that the filters let pass, for a block's template tokens in order."""
        size, seen, out = len(tokens), set(), []
        for position, token in enumerate(tokens):
            for number, at in own.get(token, ()):
                if number in seen:
                    continue
                seen.add(number)  # the first common token decides
                needed = self.needed[number]
                left = min(len(self.tokens[number]) - at, size - position)
                if position <= size - needed and left >= needed:
                    out.append(number)
        return out

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int]], list[tuple[str, int, int, float]]]:
        """(label, word) of the phrases' places, and (label, block, overlap, containment) of the matches."""
        places, matches = [], []
        if self.probes.isdisjoint(words):
            return places, matches
        ranks = list(map(self.rank.get, words))
        for step, own in self.prefixes.items():
            met = {i // step for i, r in enumerate(ranks) if r in own}
            for block in sorted(met | {b - 1 for b in met if b}):
                start = block * step
                tokens = sorted(set(ranks[start : start + 2 * step]) - {None})
                for number in sorted(self.candidates(tokens, own)):
                    overlap = len(self.tokens[number].intersection(tokens))
                    if overlap < self.needed[number]:
                        continue
                    label = self.templates[number].label
                    matches.append((label, block, overlap, overlap / len(self.tokens[number])))
                    if phrase := self.phrases[number]:
                        first = [i for i in range(start, min(start + step, len(words))) if words[i] == phrase[0]]
                        places += [(label, i) for i in first if words[i : i + len(phrase)] == phrase]
        return places, matches


PLACES = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
MATCHES = pa.list_(pa.struct([("label", pa.string()), ("block", pa.int32()), ("overlap", pa.int32()), ("containment", pa.float64())]))


def scan_licenses(
    docs: DataFrame,
    templates: list[Template] | None = None,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, ``n_words``, ``places`` and ``matches``.

    ``places`` are (label, word) of every place of a phrase, ``matches`` are (label, block, overlap,
    containment) of all template and block pairs that reach the threshold; block b of a template starts at word
    ``b * template.step``. Null and empty texts have no words, places or matches; repeated rows are rows of their own;
    null ids stay null; an empty table gives no rows; tokens of equal frequency go by their letters. Matching happens
    within the row of a text, so a text is read twice (frequencies, then blocks) and never shuffled, in time and
    memory that grow with its length. Templates without a word match nothing.
    """
    templates = TEMPLATES if templates is None else templates
    kind = docs.schema[id_column].dataType.simpleString()
    index = Index(templates, token_counts(docs, text_column, sorted({w for t in templates for w in t.tokens})))
    needed = (index.templates, {w.decode(): i for w, i in index.rank.items()})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(*needed)  # ranks order tokens as the counts did
        for batch in batches:
            sizes, places, matches = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = text.as_py().translate(LETTERS).split()
                at, found = own.scan(words)
                sizes.append(len(words))
                places.append([{"label": label, "word": word} for label, word in at])
                matches.append([dict(zip(("label", "block", "overlap", "containment"), m)) for m in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(places, PLACES), pa.array(matches, MATCHES)],
                ["doc_id", "n_words", "places", "matches"],
            )

    return docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text")).mapInArrow(
        scan,
        f"doc_id {kind}, n_words long, places array<struct<label:string,word:long>>, "
        "matches array<struct<label:string,block:int,overlap:int,containment:double>>",
    )
