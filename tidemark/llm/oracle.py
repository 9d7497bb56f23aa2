"""The same results in DuckDB SQL, where SQL can express them in reasonable time on whole tables."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_OP2 = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT *, row_number() OVER () AS row,
         list_transform(generate_series(1, len(words) - 4), lambda i: array_to_string(words[i:i + 4], ' ')) AS runs
  FROM base
), placed AS (
  SELECT row, unnest(runs) AS run, unnest(generate_series(1, len(runs))) AS pos FROM windows
), again AS (
  SELECT row, pos FROM (SELECT row, pos, count(*) OVER (PARTITION BY row, run) AS n FROM placed) WHERE n > 1
), covered AS (
  SELECT row, count(DISTINCT pos + k) AS n FROM again, generate_series(0, 4) AS g(k) GROUP BY row
), measured AS (
  SELECT doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines,
         len(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, len(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters
  FROM windows LEFT JOIN covered USING (row)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_upper > 50 * n_letters) AS kept
FROM judged
"""

# Every string of 200 bytes by its hash; texts are in hexadecimal digits, two for a byte.
_OP7 = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents
), starts AS (
  SELECT r, unnest(generate_series(0, len(t) // 2 - 200)) AS i,
         unnest(list_transform(generate_series(0, len(t) // 2 - 200), lambda i: hash(substr(t, 2 * i + 1, 400)))) AS h
  FROM docs
), again AS (
  SELECT r, i FROM starts SEMI JOIN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1) USING (h)
), marked AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens FROM again
), numbered AS (
  SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS span FROM marked
), spans AS (
  SELECT r, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY r, span
), pieces AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS behind FROM spans
), kept AS (
  SELECT r, string_agg(substr(t, 2 * behind + 1, 2 * (a - behind)), '' ORDER BY a)
            || substr(any_value(t), 2 * max(b) + 1) AS rest, sum(b - a) AS removed, count(*) AS n
  FROM pieces JOIN docs USING (r) GROUP BY r
)
SELECT doc_id, CAST(len(t) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(rest, t))) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

# The pages of the tables have one article each, of headings and paragraphs.
_OP5 = r"""
WITH articles AS (
  SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS a FROM pages
), plain AS (
  SELECT page_id, url, list_transform(
    regexp_split_to_array(regexp_replace(regexp_replace(a, '</?b>', '', 'g'), '<br>', ' ', 'g'), '</?(p|h1)>'),
    lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))) AS parts
  FROM articles
), texts AS (
  SELECT page_id, url, replace(replace(replace(replace(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS text
  FROM plain
)
SELECT page_id, url, text, CAST(len(text) AS BIGINT) AS n_chars FROM texts
"""



def _op11(rounds: int = 10) -> str:
    """Ten rounds, each a step of its own; a distance and a cluster's number are compared as one whole number."""
    gap = "list_sum(list_transform(generate_series(1, 64), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))::BIGINT"
    steps = []
    for n in range(rounds + 1):
        steps.append(
            f"a{n} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(k.v) AS v, min({gap} * 8 + j) AS m "
            f"FROM kept k, c{n} c GROUP BY r)"
        )
        if n < rounds:
            steps.append(
                f"c{n + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN ("
                "SELECT j, list(f ORDER BY p) AS v FROM (SELECT j, p, ((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS f "
                f"FROM (SELECT m % 8 AS j, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{n}) GROUP BY j, p) GROUP BY j) m ON m.j = c.j)"
            )
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT j, v FROM (
    SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS j, v FROM kept
  ) WHERE j < 8
), {", ".join(steps)}
SELECT vec_id, CAST(m % 8 AS INTEGER) AS cluster, m // 8 AS distance, CAST(sum(m // 8) OVER (PARTITION BY m % 8) AS BIGINT) AS cluster_inertia,
       CAST(sum(m // 8) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON m % 8 = j
"""


# The CRC-32 of a word's bytes by a table of 256 values, worked out bit by bit.
_OP12 = r"""
WITH RECURSIVE bits(b, k, c) AS (
  SELECT b, 0, b FROM range(256) AS g(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY b) AS tb FROM bits WHERE k = 8
), texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL
  SELECT 't', row_number() OVER (), NULL, text FROM benchmark
), words AS MATERIALIZED (
  SELECT side, r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws
  FROM texts
), each AS MATERIALIZED (
  SELECT side, r, unnest(ws) AS w FROM words
), buckets AS MATERIALIZED (
  SELECT w, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(generate_series(0, octet_length(encode(w)) - 1),
      lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
    lambda c, x: xor(tb[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM each), crc
), counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM each JOIN buckets USING (w) GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counts
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain FROM counts, totals
), sums AS (
  SELECT r, sum(gain)::BIGINT AS weight FROM each JOIN buckets USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r
), scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN sums USING (r) WHERE side = 'd'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""

ORACLE: dict[str, str] = {"op2_rules": _OP2, "op5_extract": _OP5, "op7_substrings": _OP7, "op11_centroids": _op11(), "op12_resampling": _OP12}
