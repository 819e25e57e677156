"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

from spendlake.llm.decontaminate import MAX_CLEAN_RATIO, WINDOW_WORDS
from spendlake.llm.secret_ledger import RULES

ORACLE: dict[str, str] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_sql() -> str:
    """Matches of each rule with the pieces between them; running lengths give the positions."""
    parts = []
    for rank, rule in enumerate(RULES):
        pattern = _quoted(rule.pattern)
        judged = "m" if rule.group == 0 else f"regexp_extract(m, {pattern}, {rule.group})"
        parts.append(
            f"""SELECT doc_id, '{rule.name}' AS kind, {rank} AS rank, s AS start, s + length(m) AS stop FROM (
  SELECT doc_id, m, sum(length(piece)) OVER w + sum(length(m)) OVER w - length(m) AS s FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, {pattern})) AS m,
           unnest(list_slice(regexp_split_to_array(text, {pattern}), 1,
                             len(regexp_extract_all(text, {pattern})))) AS piece,
           unnest(range(len(regexp_extract_all(text, {pattern})))) AS i
    FROM texts WHERE regexp_matches(text, {pattern}))
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE length({judged}) >= {rule.least}"""
        )
    spans = "\nUNION ALL\n".join(parts)
    listed = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({spans})
SELECT texts.doc_id,
       count(*) FILTER (WHERE kind = 'assign') AS n_assign,
       count(*) FILTER (WHERE kind = 'access') AS n_access,
       count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256({listed} FILTER (WHERE rank < 3), '')) AS base_sha256,
       {listed}, '') AS spans
FROM texts LEFT JOIN spans ON texts.doc_id = spans.doc_id GROUP BY texts.doc_id"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _contamination_sql() -> str:
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH items AS (SELECT item_id, {words} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), {WINDOW_WORDS}) AS width FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, width, array_to_string(list_slice(w, i, i + width - 1), ' ') AS win
  FROM (SELECT item_id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM sized)),
docs AS (SELECT doc_id, {words} AS w FROM documents),
runs AS (SELECT doc_id, width, i, array_to_string(list_slice(w, i, i + width - 1), ' ') AS win FROM (
  SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
  FROM docs CROSS JOIN (SELECT DISTINCT width FROM windows) WHERE len(w) >= width)),
hits AS (SELECT doc_id, item_id, i, runs.width FROM runs JOIN windows ON runs.win = windows.win AND runs.width = windows.width),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + width)) AS pos FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {MAX_CLEAN_RATIO} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered ON docs.doc_id = covered.doc_id LEFT JOIN found ON docs.doc_id = found.doc_id"""


ORACLE["op1_secrets"] = _secret_sql()
ORACLE["op7_decontamination"] = _contamination_sql()
ORACLE["op8_warc"] = """WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest"""
ORACLE["op11_exact_dedup"] = r"""WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
g AS (SELECT text, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g ON t.text = g.text"""

ORACLE["op12_phrases"] = rf"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase FROM (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM worded CROSS JOIN (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang),
cuts AS (SELECT lang, size, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size > 1),
scores AS (
  SELECT c.lang, c.phrase, c.size, c.f AS a, k, l.f AS l, r.f AS r, CAST(n AS BIGINT) AS n,
         CAST((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN totals ON totals.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(w, 1, k), ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(w, k + 1, c.size), ' ')),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, f, array_to_string(list_slice(w, i, i + width - 1), ' ') AS phrase FROM (
    SELECT lang, f, w, width, unnest(range(1, size - width + 2)) AS i FROM (
      SELECT lang, f, size, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS width FROM f WHERE size > 2))),
swallowed AS (SELECT lang, phrase, max(f) AS f FROM inner_phrases GROUP BY lang, phrase),
ranked AS (
  SELECT x.*, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, x.phrase) AS rank
  FROM lowest x LEFT JOIN swallowed s ON s.lang = x.lang AND s.phrase = x.phrase
  WHERE s.f IS NULL OR 100 * s.f < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""

ORACLE["op13_hard_negatives"] = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
         CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT alike
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3"""
