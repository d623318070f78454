"""Plain versions of the text operators, written from their definitions and without Spark."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def blank_words(text: str) -> list[str]:
    return [w for w in BLANK.split(text) if w]


# --- licenses --------------------------------------------------------------------------------------


def license_places(text: str, phrases: dict[str, str]) -> tuple[int, list[tuple[str, int]]]:
    words = WORD.findall(ascii_lower(text))
    found = []
    for label, phrase in phrases.items():
        p = phrase.split()
        found += [(label, i) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), found


def license_matches(text: str, templates) -> set[tuple[str, int, float]]:
    """Every template against every block of its step."""
    words = WORD.findall(ascii_lower(text))
    found = set()
    for t in templates:
        for b in range(max((len(words) - 1) // t.step, 0) + 1):
            have = set(words[b * t.step : b * t.step + 2 * t.step])
            share = len(have & t.tokens) / len(t.tokens)
            if len(have & t.tokens) >= t.needed:
                found.add((t.label, b, share))
    return found


# --- SimHash ---------------------------------------------------------------------------------------


def fingerprint(text: str) -> int:
    words = blank_words(ascii_lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(prints: list[int], bits: int = 3) -> list[int]:
    """The number of each fingerprint's linked set, by comparing all pairs."""
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p: int) -> int:
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(p) for p in prints]


def component_ids(docs: list[tuple[int | None, str]]) -> list[int | None]:
    prints = [fingerprint(t) for _, t in docs]
    of = classes(prints)
    least: dict[int, int] = {}
    for (doc_id, _), c in zip(docs, of):
        if doc_id is not None:
            least[c] = min(least.get(c, doc_id), doc_id)
    return [least.get(c) for c in of]


# --- secrets and personal data ---------------------------------------------------------------------

SECRETS = {
    "assign": (re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def secret_base(text: str) -> list[tuple[str, int, int]]:
    found = []
    for rank, (kind, (pattern, group, least)) in enumerate(SECRETS.items()):
        found += [
            (m.start(), rank, kind, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least
        ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d),
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def personal_base(text: str) -> dict[str, list[tuple[str, int, int]]]:
    return {
        kind: [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if passes(m[0])]
        for kind, (pattern, passes) in PERSONAL.items()
    }


TERM = re.compile(r"[A-Za-z\x80-\U0010FFFF][0-9A-Za-z\x80-\U0010FFFF_'-]*")


def disclosing_terms(texts: list[str], threshold: float, least_texts: int, term_length: int) -> list[dict[str, str]]:
    """For each text its terms over the threshold, by counting over all documents."""
    total, n_term, n_entity, n_both, seen = len(texts), Counter(), Counter(), Counter(), defaultdict(set)
    own = []
    for text in texts:
        base = personal_base(text)
        spans = [s for kind in base.values() for s in kind]
        entities = {f"{k}:{text[a:b]}" for k, a, b in spans}
        inside = {i for _, a, b in spans for i in range(a, b)}
        blanked = "".join("\n" if i in inside else c for i, c in enumerate(text))
        terms = {t.lower() for t in TERM.findall(blanked) if len(t) >= term_length}
        own.append((entities, terms, spans))
        n_term.update({t.lower() for t in TERM.findall(text)})
        for e in entities:
            n_entity[e] += 1
            for t in terms:
                n_both[e, t] += 1
                seen[e, t].add(text)
    out = []
    for entities, terms, _ in own:
        lost = {}
        for t in terms:
            ratios = [0.0]
            for e in entities:
                if len(seen[e, t]) >= least_texts and n_entity[e] < total:
                    pmi = math.log2(n_both[e, t] * total / (n_entity[e] * n_term[t]))
                    ratios.append(pmi / math.log2(total / n_entity[e]))
            if max(ratios) >= threshold:
                lost[t] = "remove" if max(ratios) > 1 - 1e-9 else "generalise"
        out.append(lost)
    return out


# --- quality ---------------------------------------------------------------------------------------


def measures(text: str) -> tuple[int, int, int, int, int]:
    words, seen, dup = blank_words(text), [], 0
    for line in text.split("\n"):
        if blank_words(line):
            dup += line in seen
            seen.append(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(i, i + 3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(inside)


# --- decontamination -------------------------------------------------------------------------------


def contaminated(text: str, item: str, min_score: int = 13, min_share: float = 0.8) -> bool:
    """Whether any alignment of the two has a long enough stretch, without looking for seeds."""
    a, b = WORD.findall(text.lower()), WORD.findall(item.lower())
    for shift in range(-len(b) + 1, len(a)):
        run = 0
        for k in range(max(0, -shift), min(len(b), len(a) - shift)):
            run = max(0, run) + (1 if a[k + shift] == b[k] else -1)
            if run >= min(min_score, math.ceil(min_share * len(b))):
                return True
    return False


# --- archives and shards ---------------------------------------------------------------------------


def archived(pages: list[tuple[int, str | None]]) -> set[tuple]:
    first: dict[bytes, int] = {}
    for page, html in pages:
        body = (html or "").encode()
        first[body] = min(first.get(body, page), page)
    rows = set()
    for page, html in pages:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        own = first[body] == page
        rows.add((page, len(body), digest, "response" if own else "revisit", None if own else first[body]))
    return rows


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())


# --- periodic runs ---------------------------------------------------------------------------------


def repeated_words(doc_id, text: str | None) -> list[str]:
    """The words of a text, repeated from one of them on where its id says so."""
    words = blank_words(text or "")
    n = len(words)
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def periodic_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs: every period is tried on the whole text."""
    smallest: dict[tuple[int, int], int] = {}
    for p in range(1, len(words) // 3 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(24, 3 * p):
                smallest.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in smallest.items())


def run_row(doc_id, text: str | None) -> tuple:
    words = repeated_words(doc_id, text)
    runs = periodic_runs(words)
    best = (None,) * 4
    if runs:
        s, n, p = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (s, n, p, 1000 * n // p)
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *best, sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha256(kept))


# --- collocations ----------------------------------------------------------------------------------


def collocations(texts, least: int = 10, best: int = 2000) -> list[tuple]:
    """All phrases of (lang, text) pairs, counted one by one."""
    counts: dict[str, Counter] = defaultdict(Counter)
    for lang, text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text or "")):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for size in (1, 2, 3):
                own = counts["und" if lang is None else lang]
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, own in sorted(counts.items()):
        frequent = {p: n for p, n in own.items() if len(p) > 1 and n >= least}
        scored = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and 100 * n >= 50 * a and p in (q[:-1], q[1:]) for q, n in frequent.items()):
                continue
            score, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        n = sum(v for p, v in own.items() if len(p) == 1)
        ranked = enumerate(sorted(scored)[:best], 1)
        out += [(lang, i, phrase.decode(), -a, l, r, n, -score) for i, (score, a, phrase, l, r) in ranked]
    return out
