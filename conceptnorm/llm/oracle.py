"""DuckDB SQL for the queries of this subpackage that SQL can express.

Hashed n-gram models, random rounding, flows, page parsing, hypervectors and compression are not
SQL: those queries are held against brute force in the tests.
"""

from __future__ import annotations

from conceptnorm.llm.chat import ESCAPES, OTHER, TEMPLATES
from conceptnorm.llm.queries import PROBE
from conceptnorm.llm.secret_scan import BASE, RULES

ORACLE: dict[str, str] = {}

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# documents' windows of 13 words (or of a shorter item's length) against those of the items
_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE["op1_decontamination"] = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item, least(len(w), 13) AS n, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM bw),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
hits AS (SELECT dw.rid, dw.i, dw.n, win.item FROM dw JOIN win ON win.n = dw.n AND win.k = array_to_string(dw.w[dw.i : dw.i + dw.n - 1], ' ')),
cover AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (rid) LEFT JOIN items USING (rid)
"""


def _escaped(column: str) -> str:
    for plain, code in ESCAPES.items():
        column = f"replace({column}, {_quoted(plain)}, {_quoted(code)})"
    return column


def _written() -> str:
    cases = " ".join(f"WHEN {_quoted(role)} THEN {_quoted(before)} || {_escaped('text')} || {_quoted(after)}"
                     for role, (before, after) in TEMPLATES.items())
    role = f"replace({_escaped('role')}, '>', '\\g')"
    return f"CASE role {cases} ELSE {_quoted(OTHER[0])} || {role} || {_quoted(OTHER[1])} || {_escaped('text')} || {_quoted(OTHER[2])} END"


ORACLE["op2_chat_format"] = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_quoted(PROBE)} UNION ALL SELECT -1, 1, 'assistant', {_quoted(PROBE)}),
w AS (SELECT *, {_written()} AS written FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(written)) AS BIGINT) AS formatted_chars, CAST(sum(strlen(written)) AS BIGINT) AS n_tokens
FROM w GROUP BY conv_id
"""

# all pairs that share a shingle, and what their links reach
ORACLE["op7_near_dup"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
meets AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM meets JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * same >= 80 * (x.n + y.n - same)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, sides.b FROM reach JOIN sides ON sides.a = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def _matches(number: int, pattern: str) -> str:
    p = _quoted(pattern)
    return f"""SELECT rid, {number} AS kind_no, unnest(string_split_regex(t, {p})) AS gap, unnest(regexp_extract_all(t, {p})) AS hit,
  unnest(range(len(string_split_regex(t, {p})))) AS i FROM d WHERE regexp_matches(t, {p})"""


_ENOUGH = " ".join(f"WHEN {i} THEN length(regexp_extract(hit, {_quoted(r.pattern)}, {r.group})) >= {r.least}" for i, r in enumerate(RULES))
_KINDS = " ".join(f"WHEN {i} THEN {_quoted(r.kind)}" for i, r in enumerate(RULES))
_SHOWN = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no)"
ORACLE["op10_secret_scan"] = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(_matches(i, r.pattern) for i, r in enumerate(RULES))}),
p AS (SELECT *, sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY rid, kind_no ORDER BY i) AS e FROM m),
f AS (SELECT rid, kind_no, CASE kind_no {_KINDS} END AS kind, e - length(hit) AS s, e FROM p WHERE hit IS NOT NULL AND CASE kind_no {_ENOUGH} END),
g AS (SELECT rid, {_SHOWN} AS spans, {_SHOWN} FILTER (kind_no < {len(BASE)}) AS base,
  {', '.join(f"count(*) FILTER (kind_no = {i}) AS n_{r.kind}" for i, r in enumerate(BASE))} FROM f GROUP BY rid)
SELECT doc_id, {', '.join(f"CAST(coalesce(n_{r.kind}, 0) AS BIGINT) AS n_{r.kind}" for r in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""


# all strings of 400 bytes, by their hexadecimal form
ORACLE["op11_suffix_dedup"] = """
WITH texts AS (
  SELECT row_number() OVER () AS d, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (       -- 400 starts each, as cutting strings out of a long one takes long
  SELECT d, 400 * k AS first, substr(h, 800 * k + 1, 1598) AS part
  FROM (SELECT d, h, unnest(range(0, (len(h) // 2) // 400 + 1)) AS k FROM texts)),
strings AS (
  SELECT d, first + unnest(range(0, len(part) // 2 - 399)) AS i,
         unnest(list_transform(range(0, len(part) // 2 - 399), lambda i: md5_number(substr(part, 2 * i + 1, 800)))) AS s
  FROM parts),
twice AS (SELECT s FROM strings GROUP BY s HAVING count(*) > 1),
starts AS (
  SELECT d, i, i - lag(i) OVER (PARTITION BY d ORDER BY i) AS step FROM strings WHERE s IN (SELECT s FROM twice)),
islands AS (
  SELECT d, i, sum(CASE WHEN step <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY d ORDER BY i) AS k FROM starts),
spans AS (SELECT d, k, min(i) AS a, max(i) + 400 AS b FROM islands GROUP BY d, k),
gaps AS (
  SELECT d, a, b, coalesce(lag(b) OVER (PARTITION BY d ORDER BY k), 0) AS last FROM spans),
removed AS (
  SELECT t.d, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
         string_agg(substr(h, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS kept
  FROM gaps JOIN texts t ON t.d = gaps.d GROUP BY t.d)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN removed ON removed.d = texts.d
"""

ORACLE["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
phrases AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' '))) FROM words
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) FROM words
    UNION ALL SELECT lang, 4, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) FROM words
    UNION ALL SELECT lang, 5, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) FROM words)
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
own AS (
  SELECT * FROM phrases c WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM phrases x WHERE x.lang = c.lang AND x.k > c.k AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' ')
      AND 100 * x.f >= 100 * c.f)),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, j, l.f AS l, r.f AS r, t.n,
         (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM own) c
  JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS cut FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE cut = 1)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
