"""The results of the text queries in DuckDB's SQL, where SQL can express them.

XXH64 fingerprints, the trained grammar and the vocabulary file have no SQL; those queries are tested
against brute force, an exact round trip or held-out accuracy instead.
"""

from __future__ import annotations

import string

from rowloom.llm.decontaminate import MASKS
from rowloom.llm.licenses import TEMPLATES
from rowloom.llm.quality import RULES as QUALITY_RULES
from rowloom.llm.secret_scan import BASE, RULES

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ALPHABET = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
BASE32 = string.ascii_uppercase + "234567"


def quoted(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def crc_table() -> list[int]:
    """The 256 remainders of CRC-32, from its reversed polynomial."""
    table = []
    for byte in range(256):
        value = byte
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


TEMPLATE_ROWS = ",\n    ".join(
    f"({i}, '{t.label}', {str(t.is_phrase).lower()}, {quoted(sorted(t.tokens))}, {quoted(t.words.split())}, {t.needed}, {t.step})"
    for i, t in enumerate(TEMPLATES)
)

LICENSES = f"""
WITH templates(number, label, is_phrase, tokens, words, needed, step) AS (VALUES
    {TEMPLATE_ROWS}),
texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), {ALPHABET}), '{NOT_WORD}'),
                     lambda w: w <> '') AS words
  FROM documents),
blocks AS (
  SELECT r, step, list_distinct(words[b * step + 1 : b * step + 2 * step]) AS tokens
  FROM (SELECT r, words, step, unnest(range(0, greatest((len(words) - 1) // step, 0) + 1)) AS b
        FROM texts, (SELECT DISTINCT step FROM templates))),
matched AS (
  SELECT r, label, is_phrase, len(list_intersect(b.tokens, t.tokens)) / len(t.tokens)::DOUBLE AS containment
  FROM blocks b JOIN templates t ON b.step = t.step
  WHERE len(list_intersect(b.tokens, t.tokens)) >= t.needed),
starts AS (
  SELECT r, t.label, t.words AS phrase, x.words, unnest(range(0, len(x.words))) AS w
  FROM texts x, templates t WHERE t.is_phrase),
places AS (
  SELECT r, label, w FROM starts WHERE words[w + 1 : w + len(phrase)] = phrase),
base AS (
  SELECT r, count(*) AS n_base, min(w) AS first_word, max(w) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY r),
own AS (
  SELECT m.r, list(DISTINCT m.label) FILTER (WHERE NOT m.is_phrase) AS labels, max(containment) AS score
  FROM matched m LEFT JOIN base b ON m.r = b.r
  WHERE NOT m.is_phrase OR list_contains(b.labels, m.label) GROUP BY m.r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
           list_concat(coalesce(b.labels, []), coalesce(o.labels, [])))), ','), '') AS labels,
       coalesce(o.score, 0.0)::DOUBLE AS score
FROM texts t LEFT JOIN base b ON t.r = b.r LEFT JOIN own o ON t.r = o.r
"""


def spans(text: str, pattern: str, kind: str, check: str, group: int = 0) -> str:
    """A list of (start, rank placeholder, kind, end) of the matches that pass ``check`` on ``found``."""
    hits, gaps = f"regexp_extract_all({text}, '{pattern}')", f"regexp_split_to_array({text}, '{pattern}')"
    found = f"regexp_extract_all({text}, '{pattern}', {group})"
    before = f"list_sum(list_transform(({gaps})[1:i], lambda g: length(g)))"
    earlier = f"coalesce(list_sum(list_transform(({hits})[1:i-1], lambda h: length(h))), 0)"
    return f"""CASE WHEN regexp_matches({text}, '{pattern}') THEN
      list_filter(list_transform(range(1, len({hits}) + 1), lambda i: {{
        'start': ({before} + {earlier})::BIGINT, 'kind': '{kind}',
        'stop': ({before} + {earlier} + length(({hits})[i]))::BIGINT, 'found': ({found})[i]}}),
        lambda s: {check.replace("found", "s.found")})
      ELSE [] END"""


def re2(pattern: str) -> str:
    """Without look-behinds and possessive repeats, which only spare work; quotes doubled."""
    for spared in (r"(?<![0-9a-f])",):
        pattern = pattern.replace(spared, "")
    return pattern.replace("}+", "}").replace("++", "+").replace("'", "''")


SECRET_COLUMNS = ",\n    ".join(
    f"{spans('t', re2(pattern), kind, f'length(found) >= {least}', group)} AS s_{kind}"
    for kind, pattern, group, least in RULES
)
LISTED = "[" + ", ".join(f"'{kind}'" for kind, *_ in RULES) + "]"
JOINED = "array_to_string(list_transform({}, lambda s: s.kind || ':' || s.start || ':' || s.stop), ',')"
IN_ORDER = (
    "list_transform(list_sort(list_transform({}, lambda s: {{'at': s.start, "
    f"'rank': list_position({LISTED}, s.kind), 'span': s}}}})), lambda x: x.span)"
)
SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT doc_id, {SECRET_COLUMNS} FROM d),
listed AS (
  SELECT doc_id, {", ".join(f"len(s_{k})::BIGINT AS n_{k}" for k in BASE)},
         {IN_ORDER.format("flatten([" + ", ".join(f"s_{k}" for k in BASE) + "])")} AS base,
         {IN_ORDER.format("flatten([" + ", ".join(f"s_{k}" for k, *_ in RULES) + "])")} AS all_spans
  FROM found)
SELECT doc_id, n_assign, n_access, n_hex,
       sha256(coalesce({JOINED.format("base")}, '')) AS base_sha256,
       coalesce({JOINED.format("all_spans")}, '') AS spans
FROM listed
"""

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
CARD = r"[0-9](?:[\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"[A-Za-z\x{80}-\x{10FFFF}][0-9A-Za-z\x{80}-\x{10FFFF}_''-]*"
DIGITS = "regexp_replace(found, '[^0-9]', '', 'g')"
LUHN = f"""list_sum(list_transform(range(1, length({DIGITS}) + 1), lambda k:
  CASE WHEN (length({DIGITS}) - k) % 2 = 1 THEN (2 * substr({DIGITS}, k, 1)::INTEGER) % 10 + (2 * substr({DIGITS}, k, 1)::INTEGER) // 10
       ELSE substr({DIGITS}, k, 1)::INTEGER END)) % 10 = 0"""
SMALL = """len(list_filter(string_split(found, '.'), lambda part:
  length(ltrim(part, '0')) > 3 OR (ltrim(part, '0') <> '' AND left(ltrim(part, '0'), 3)::INTEGER > 255))) = 0"""
PERSONAL_COLUMNS = ",\n    ".join(
    f"{spans('t', pattern, kind, check)} AS s_{kind}"
    for kind, pattern, check in [
        ("email", EMAIL, "true"),
        ("ip", IP, SMALL),
        ("card", CARD, f"CASE WHEN length({DIGITS}) BETWEEN 13 AND 19 THEN {LUHN} ELSE false END"),
        ("phone", PHONE, f"length({DIGITS}) BETWEEN 9 AND 15"),
    ]
)
OVERLAPPED = "list_contains(lost, lower(found)) AND len(list_filter(base, lambda b: b.start < s.stop AND s.start < b.stop)) = 0"


def terms(text: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({text}, '{TERM}'), lambda x: lower(x)))"


BLANKED = """array_to_string(list_transform(string_split(t, ''), lambda c, i:
  CASE WHEN len(list_filter(any_value(base), lambda b: b.start < i AND i <= b.stop)) > 0 THEN chr(10) ELSE c END), '')"""
PERSONAL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT r, doc_id, t, {PERSONAL_COLUMNS} FROM d),
marked AS (SELECT *, flatten([s_email, s_ip, s_card, s_phone]) AS base FROM found),
held AS (
  SELECT t, count(*) AS copies, list_distinct(any_value(list_transform(base, lambda s: s.kind || ':' || s.found))) AS entities,
         list_filter({terms(BLANKED)},
                     lambda w: length(w) >= 4) AS terms
  FROM marked WHERE len(base) > 0 GROUP BY t),
entities AS (SELECT t, copies, terms, unnest(entities) AS entity FROM held),
pairs AS (
  SELECT entity, term, sum(copies) AS n_both FROM (SELECT copies, entity, unnest(terms) AS term FROM entities)
  GROUP BY entity, term HAVING count(*) >= 3),
n_entity AS (SELECT entity, sum(copies) AS n_e FROM entities GROUP BY entity),
n_term AS (SELECT term, count(*) AS n_t FROM (SELECT unnest({terms("t")}) AS term FROM d) GROUP BY term),
shown AS (
  SELECT entity, term FROM pairs JOIN n_entity USING (entity) JOIN n_term USING (term), (SELECT count(*) AS total FROM d)
  WHERE n_e < total AND log2(n_both * total::DOUBLE / (n_e * n_t)) / log2(total::DOUBLE / n_e) >= 0.9),
lost AS (
  SELECT t, list(DISTINCT term) AS lost FROM (
    SELECT e.t, s.term FROM entities e JOIN shown s ON e.entity = s.entity WHERE list_contains(e.terms, s.term)) GROUP BY t),
termed AS (
  SELECT m.*, CASE WHEN lost IS NULL THEN [] ELSE {spans('t', TERM, 'term', OVERLAPPED)} END AS s_term
  FROM marked m LEFT JOIN lost USING (t))
SELECT doc_id, len(s_email)::BIGINT AS n_email, len(s_ip)::BIGINT AS n_ip, len(s_card)::BIGINT AS n_card,
       len(s_phone)::BIGINT AS n_phone, sha256(coalesce({JOINED.format("base")}, '')) AS base_sha256,
       coalesce({JOINED.format("list_concat(base, s_term)")}, '') AS spans
FROM termed
"""

MASK_ROWS = ", ".join(f"('{m}', {[i for i, bit in enumerate(m) if bit == '1']})" for m in MASKS)

DECONTAMINATION = f"""
WITH masks(mask, picked) AS (VALUES {MASK_ROWS}),
texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{NOT_WORD}'), lambda w: w <> '') AS words
  FROM documents),
items AS (
  SELECT row_number() OVER () AS i, item_id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{NOT_WORD}'), lambda w: w <> '') AS words
  FROM benchmark),
item_seeds AS (
  SELECT i, p, mask, array_to_string(list_transform(picked, lambda k: words[p + k + 1]), ' ') AS seed
  FROM (SELECT i, words, unnest(range(0, len(words) - 11)) AS p FROM items WHERE len(words) >= 12), masks
  UNION ALL
  SELECT i, 0, 'whole', array_to_string(words, ' ') FROM items WHERE len(words) BETWEEN 1 AND 11),
short AS (SELECT DISTINCT len(words) AS n FROM items WHERE len(words) BETWEEN 1 AND 11),
text_seeds AS (
  SELECT r, p, mask, array_to_string(list_transform(picked, lambda k: words[p + k + 1]), ' ') AS seed
  FROM (SELECT r, words, unnest(range(0, len(words) - 11)) AS p FROM texts WHERE len(words) >= 12), masks
  UNION ALL
  SELECT r, p, 'whole', array_to_string(words[p + 1 : p + n], ' ')
  FROM (SELECT r, words, n, unnest(range(0, len(words) - n + 1)) AS p FROM texts, short WHERE len(words) >= n)),
shifts AS (
  SELECT DISTINCT r, i, x.p - y.p AS shift FROM text_seeds x JOIN item_seeds y USING (mask, seed)),
aligned AS (
  SELECT s.r, s.i, shift, unnest(range(greatest(0, -shift), least(len(y.words), len(x.words) - shift))) AS k,
         x.words AS a, y.words AS b
  FROM shifts s JOIN texts x ON s.r = x.r JOIN items y ON s.i = y.i),
sums AS (
  SELECT r, i, shift, k,
         sum(CASE WHEN a[k + shift + 1] = b[k + 1] THEN 1 ELSE -1 END)
           OVER (PARTITION BY r, i, shift ORDER BY k) AS total,
         min(k) OVER (PARTITION BY r, i, shift) AS begin
  FROM aligned),
lows AS (
  SELECT *, least(0, coalesce(min(total) OVER (PARTITION BY r, i, shift ORDER BY k
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low
  FROM sums),
best AS (
  SELECT r, i, shift, min(begin) AS begin, max(total - low) AS score,
         arg_min(k, (low - total) * 1000000 + k) AS last, arg_min(low, (low - total) * 1000000 + k) AS low
  FROM lows GROUP BY r, i, shift),
stretches AS (
  SELECT b.r, b.i, b.shift, b.score, b.last,
         coalesce((SELECT max(s.k) + 1 FROM sums s WHERE s.r = b.r AND s.i = b.i AND s.shift = b.shift
                   AND s.k < b.last AND s.total = b.low), b.begin) AS first
  FROM best b)
SELECT DISTINCT doc_id, item_id, (first + shift)::BIGINT AS doc_start, first::BIGINT AS item_start,
       (last - first + 1)::BIGINT AS n_words, score::BIGINT AS score
FROM stretches s JOIN texts x ON s.r = x.r JOIN items y ON s.i = y.i
WHERE score >= least(13, ceil(0.8 * len(y.words)))
"""

WARC = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', (
         ((16 * (instr('0123456789abcdef', substr(h, (5 * i) // 4 + 1, 1)) - 1)
           + instr('0123456789abcdef', substr(h, (5 * i) // 4 + 2, 1)) - 1)
          >> (3 - (5 * i) % 4)::INTEGER) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d
"""

SHARDING = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, md5(coalesce(text, '')) AS tie,
         ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, tie) AS rank,
         count(*) OVER (PARTITION BY source) AS n
  FROM d),
placed AS (
  SELECT *, count(*) OVER () AS total, row_number() OVER (
      ORDER BY (2 * rank - 1)::DOUBLE / (2 * n)::DOUBLE, source NULLS FIRST, key, doc_id NULLS FIRST, tie) - 1 AS place
  FROM ranked),
cut AS (SELECT *, (place * 40) // total AS shard FROM placed)
SELECT doc_id, strlen(t) + 16 AS size,
       xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
         regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT)),
         lambda c, b: xor(c >> 8, ({crc_table()}::BIGINT[])[xor(c & 255, b) + 1])))::BIGINT AS text_crc32,
       'rows' AS law, shard::INTEGER AS shard, (place - (shard * total + 39) // 40)::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM cut
"""

BLANK = r"[\x20\x09-\x0D]+"
GRID = ", ".join(f"('{rule}', {cut!r}::DOUBLE)" for rule, (_, cuts) in QUALITY_RULES.items() for cut in cuts)
VALUE = " ".join(f"WHEN '{rule}' THEN {value.replace('/ n_words', '/ n_words::DOUBLE')}" for rule, (value, _) in QUALITY_RULES.items())
QUALITY = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANK}'), lambda w: w <> '') AS words
  FROM documents),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM (
    SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts)
  WHERE regexp_replace(line, '{BLANK}', '', 'g') <> '' GROUP BY r),
windows AS (
  SELECT r, k, words[k + 1 : k + 3] AS w
  FROM (SELECT r, words, unnest(range(0, len(words) - 2)) AS k FROM texts WHERE len(words) >= 3)),
often AS (SELECT r, w FROM windows GROUP BY r, w HAVING count(*) > 1),
repeated AS (
  SELECT r, count(DISTINCT k) AS n FROM (
    SELECT r, unnest([k, k + 1, k + 2]) AS k FROM windows JOIN often USING (r, w)) GROUP BY r),
measured AS (
  SELECT t.r, doc_id, coalesce('=' || lang, '') AS stratum, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(l.n, 0) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words
  FROM texts t LEFT JOIN lines l ON t.r = l.r LEFT JOIN repeated p ON t.r = p.r),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
grid(rule, cutoff) AS (VALUES {GRID}),
valued AS (SELECT j.*, rule, cutoff, CASE WHEN n_words > 0 THEN CASE rule {VALUE} END END AS value FROM judged j, grid),
counts AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (WHERE quality = 1) AS good,
         count(*) FILTER (WHERE quality = 1 AND value > cutoff) AS good_rejected,
         count(*) FILTER (WHERE quality <> 1 AND value > cutoff) AS bad_rejected
  FROM valued JOIN labels USING (doc_id) WHERE NOT base_failed AND quality IS NOT NULL GROUP BY ALL),
limits AS (SELECT 0.05::DOUBLE / {len(QUALITY_RULES)} AS risk, (1 - 0.95::DOUBLE) / count(DISTINCT (stratum, rule)) AS level FROM counts),
tested AS (
  SELECT c.*, level, CASE WHEN good_rejected >= good THEN 1.0 ELSE (
      SELECT list_sum(list_transform(range(0, good_rejected + 1), lambda k: exp(
        lgamma(good + 1) - lgamma(k + 1) - lgamma(good - k + 1) + k * ln(risk) + (good - k) * ln(1 - risk))))) END AS p
  FROM counts c, limits),
passed AS (
  SELECT *, max(p) OVER (PARTITION BY stratum, rule ORDER BY cutoff DESC) AS worst, bad_rejected - good_rejected AS gain
  FROM tested),
chosen AS (
  SELECT stratum, rule, cutoff FROM passed WHERE worst <= level AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cutoff DESC) = 1),
failed AS (
  SELECT r, string_agg(rule, ',' ORDER BY rule) AS rules
  FROM valued JOIN chosen USING (stratum, rule, cutoff) WHERE value > cutoff GROUP BY r)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND rules IS NULL AS kept, coalesce(rules, '') AS failed_rules
FROM judged j LEFT JOIN failed f ON j.r = f.r
"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), {ALPHABET}), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces),
grams AS (
  SELECT lang, 1 AS size, unnest(words) AS phrase FROM worded
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM worded
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(words) - 1),
                                        lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))
  FROM worded),
counts AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
parts AS (
  SELECT lang, size, phrase, n AS a, split_part(phrase, ' ', 1) AS w1, split_part(phrase, ' ', 2) AS w2,
         split_part(phrase, ' ', 3) AS w3
  FROM counts WHERE size >= 2 AND n >= 10),
cuts AS (
  SELECT lang, size, phrase, a, 1 AS k, w1 AS first_part, w2 || CASE size WHEN 3 THEN ' ' || w3 ELSE '' END AS rest FROM parts
  UNION ALL
  SELECT lang, size, phrase, a, 2, w1 || ' ' || w2, w3 FROM parts WHERE size = 3),
scored AS (
  SELECT c.*, x.n AS l, y.n AS r, (1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = first_part AND x.size = c.k
  JOIN counts y ON y.lang = c.lang AND y.phrase = rest AND y.size = c.size - c.k),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, size, phrase ORDER BY score, k) = 1),
covering AS (
  SELECT lang, pair, max(a) AS longest FROM (
    SELECT lang, w1 || ' ' || w2 AS pair, a FROM parts WHERE size = 3
    UNION ALL SELECT lang, w2 || ' ' || w3, a FROM parts WHERE size = 3)
  GROUP BY ALL),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN covering v ON v.lang = w.lang AND v.pair = w.phrase AND w.size = 2
  WHERE longest IS NULL OR 100 * longest < 50 * a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

LLM_ORACLES: dict[str, str] = {
    "op1_license_scan": LICENSES,
    "op5_secret_scan": SECRETS,
    "op6_personal_data": PERSONAL,
    "op7_quality": QUALITY,
    "op8_decontamination": DECONTAMINATION,
    "op9_warc": WARC,
    "op10_sharding": SHARDING,
    "op12_collocations": COLLOCATIONS,
}
