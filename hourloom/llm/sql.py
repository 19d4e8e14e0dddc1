"""The same queries for a single-node SQL engine, where SQL can say them."""

from __future__ import annotations

from hourloom.llm import quality_rules as q

WORDS = r"[^\x20\x09-\x0D]+"
LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All pairs of sets that share a shingle, and the closure of their links.
NEAR = f"""WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all({LOW}, '{WORDS}') AS w FROM documents),
sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END)) AS s FROM words),
vertices AS (SELECT min(doc_id) AS id, s FROM sets WHERE len(s) > 0 GROUP BY s),
entries AS MATERIALIZED (SELECT id, len(s) AS n, unnest(s) AS t FROM vertices),
pairs AS (SELECT a.id AS a, b.id AS b, a.n AS n, b.n AS m, count(*) AS c FROM entries a JOIN entries b ON a.t = b.t AND a.id < b.id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * c >= 85 * (n + m - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
classes AS (SELECT id, least(id, min(b)) AS c, s FROM vertices LEFT JOIN reach ON a = id GROUP BY id, s)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id FROM sets LEFT JOIN classes ON classes.s = sets.s"""

_TESTS = ", ".join(f"('{m}', {float(c)}::DOUBLE)" for m, grid in q.GRID.items() for c in grid)
_MEASURE = "CASE measure " + " ".join(f"WHEN '{m}' THEN {m}" for m in q.MEASURES) + " END"
_EACH = f"({q.RISK}::DOUBLE / {len(q.MEASURES)})"

#: The exact binomial tail as a plain sum; the level is divided by the measures of all strata.
QUALITY = f"""WITH
texts AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
words AS MATERIALIZED (SELECT doc_id, lang, t, regexp_extract_all(t, '{WORDS}') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORDS}')) AS lines FROM texts),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM words WHERE len(w) >= 5),
spots AS (SELECT doc_id, w[i:i + 4] AS x, list(i) AS found_at FROM windows GROUP BY ALL HAVING count(*) > 1),
places AS (SELECT doc_id, unnest(found_at) AS i FROM spots),
covered AS (SELECT doc_id, count(DISTINCT j) AS r FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM places) GROUP BY 1),
base AS (SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '{q.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
  FROM words LEFT JOIN covered USING (doc_id)),
measured AS MATERIALIZED (SELECT *, n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.MOST_REPEATED} * n_words AS base_failed,
  n_symbols / greatest(n_words, 1) AS symbol_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
  n_repeat_words / greatest(n_words, 1) AS repeat_share, word_chars / greatest(n_words, 1) AS mean_word,
  -(word_chars / greatest(n_words, 1)) AS short_word FROM base),
tests AS (SELECT * FROM (VALUES {_TESTS}) v(measure, cutoff)),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY 1 HAVING min(quality) = 1),
counts AS MATERIALIZED (SELECT lang, measure, cutoff, count(*) AS n, count(*) FILTER ({_MEASURE} > cutoff) AS k
  FROM measured JOIN good USING (doc_id), tests WHERE NOT base_failed GROUP BY ALL),
chances AS (SELECT *, CASE WHEN k < n * {_EACH} THEN (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
  + i * ln({_EACH}) + (n - i) * ln(1 - {_EACH}))) FROM range(0, k + 1) v(i)) ELSE 1 END AS chance FROM counts),
limits AS (SELECT lang, measure, min(cutoff) AS cutoff FROM chances
  WHERE chance * (SELECT count(*) FROM (SELECT DISTINCT lang, measure FROM counts)) <= {q.LEVEL} GROUP BY ALL),
rejected AS (SELECT DISTINCT doc_id FROM measured m JOIN limits l ON m.lang IS NOT DISTINCT FROM l.lang WHERE {_MEASURE} > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept FROM measured"""

_PARTS = r"^(?s)(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"


def _host(url: str) -> str:
    part = f"coalesce(regexp_extract({url}, '{_PARTS}', 2), '')"
    return f"translate({part}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _part(url: str, i: int) -> str:
    return f"coalesce(regexp_extract({url}, '{_PARTS}', {i}), '')"


#: Every rule against every url; aliases by the closure of the links with absolute targets.
URLS = f"""WITH RECURSIVE
rules AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')) v(h, p, v)),
found AS (SELECT url AS source, unnest(list_concat(
  regexp_extract_all(html, '(?is)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*>'),
  regexp_extract_all(html, '(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*>'))) AS tag FROM pages),
links AS (SELECT source, regexp_extract(tag, '(?is)(?:href|url)\\s*=\\s*["'']?([a-z]+://[^"''\\s>]+)', 1) AS target FROM found),
named AS (SELECT {_host('source')} || {_part('source', 3)} || {_part('source', 4)} AS a,
  {_host('target')} || {_part('target', 3)} || {_part('target', 4)} AS b FROM links WHERE target <> ''),
both_ways AS (SELECT a, b FROM named UNION SELECT b, a FROM named),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
urls AS (SELECT page_id, {_host('url')} AS host, {_part('url', 3)} AS path, {_part('url', 4)} AS rest FROM pages),
spots AS (SELECT DISTINCT host, path FROM urls UNION SELECT split_part(b, '/', 1),
  CASE WHEN contains(b, '/') THEN regexp_extract(b, '(/[^?]*)', 1) ELSE '' END FROM both_ways),
best AS (SELECT host, path, arg_max(h || p, (length(h || p), length(h))) AS rule, arg_max(v, (length(h || p), length(h))) AS v
  FROM spots JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL),
spoiled AS (SELECT DISTINCT a FROM reach JOIN best ON b = best.host || best.path WHERE v = 'block')
SELECT page_id, urls.host, urls.path, rule, coalesce(v, CASE WHEN urls.host || urls.path || rest IN (SELECT a FROM spoiled) THEN 'block' END, 'allow') AS verdict
FROM urls LEFT JOIN best ON best.host = urls.host AND best.path = urls.path"""

#: The digests of the texts themselves, and the length that the template gives.
CHATS = r"""WITH told AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(role) + length(regexp_replace(text, '(\\*</?turn)', '\\\1', 'g')))::BIGINT AS formatted_chars
FROM told GROUP BY conv_id"""

#: Groups of the normalised texts themselves.
EXACT = r"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
keyed AS (SELECT doc_id, length(t) AS n, sha256(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS h FROM texts)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  row_number() OVER w = 1 AS kept, h AS text_sha256
FROM keyed WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST)"""

_PARTS_16, _BOOK_64 = 16, 64


def _round(last: str, k: int) -> str:
    """Every distance to every entry, the nearest one, and the entries moved to the floored means."""
    return f"""near_{k} AS MATERIALIZED (SELECT vec_id, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT s.vec_id, s.p, b.e, list_sum(list_transform(list_zip(s.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts s JOIN {last} b ON b.p = s.p) GROUP BY ALL),
  moved_{k} AS (SELECT p, e, list(m ORDER BY j) AS v FROM (SELECT p, e, j, floor(sum(x)::HUGEINT / count(*))::BIGINT AS m FROM (
    SELECT n.p, n.e, unnest(range(1, len(s.v) + 1)) AS j, unnest(s.v) AS x FROM near_{k} n JOIN parts s USING (vec_id, p)) GROUP BY ALL) GROUP BY ALL),
  book_{k} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM {last} b LEFT JOIN moved_{k} m ON m.p = b.p AND m.e = b.e)"""


#: Every part against every entry; ids are unique in the given tables.
CODES = f"""WITH sound AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  parts AS MATERIALIZED (SELECT vec_id, i AS p, x[i * len(x) // {_PARTS_16} + 1:(i + 1) * len(x) // {_PARTS_16}] AS v
    FROM sound, range({_PARTS_16}) r(i)),
  book_0 AS MATERIALIZED (SELECT p, e, v FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM sound) USING (vec_id)
    WHERE e < {_BOOK_64}),
  {_round("book_0", 1)}, {_round("book_1", 2)}, {_round("book_2", 3)},
  codes AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near_3 GROUP BY 1)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book_2) AS codebooks_sha256
FROM codes JOIN sound USING (vec_id)"""

ORACLES = {
    "op1_ngram_jaccard_join": NEAR,
    "op2_chat_trees": CHATS,
    "op3_quality_rules": QUALITY,
    "op4_url_filters": URLS,
    "op12_two_pass_bloom_dedup": EXACT,
    "op13_trie_vector_codes": CODES,
}
