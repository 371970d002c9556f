"""DuckDB SQL for the contract queries that SQL can express."""

_OP2 = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
keyed AS (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE common.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON keyed.k = common.k GROUP BY doc_id
"""

#: (kind, pattern, group whose length counts, least length), in the order of the scan
_RULES = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", "xox[baprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("google", "AIza[0-9A-Za-z_-]{35}", 0, 1),
    ("stripe", "(?:sk|rk)_live_[0-9A-Za-z]{16,}", 0, 1),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)


def _op5() -> str:
    found = "\nUNION ALL ".join(
        f"SELECT doc_id, {i} AS o, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, '{p}', 0) AS w, "
        f"regexp_extract_all(t, '{p}', {group}) AS g, string_split_regex(t, '{p}') AS p FROM d"
        for i, (kind, p, group, least) in enumerate(_RULES))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({found}),
u AS (SELECT doc_id, o, kind, least, unnest(w) AS w, unnest(g) AS g, unnest(p[1:len(w)]) AS p, unnest(range(len(w))) AS i
      FROM m WHERE len(w) > 0),
s AS (SELECT doc_id, o, kind, length(g) >= least AS ok, length(w) AS n,
             sum(length(p)) OVER x + coalesce(sum(length(w)) OVER (PARTITION BY doc_id, o ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
      FROM u WINDOW x AS (PARTITION BY doc_id, o ORDER BY i)),
r AS (SELECT doc_id, o, a, kind, kind || ':' || CAST(a AS BIGINT) || ':' || CAST(a + n AS BIGINT) AS span FROM s WHERE ok)
SELECT d.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
       count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY a, o) FILTER (WHERE o < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY a, o), '') AS spans
FROM d LEFT JOIN r ON d.doc_id = r.doc_id GROUP BY d.doc_id
"""


_OP12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same,
             CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score
      FROM v AS a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""

#: CRC-32 of each distinct feature, a byte a step; the table of 256 entries follows from the polynomial.
_OP13 = r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT n, list_reduce(list_prepend(n, range(8)),
                        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS n)),
texts AS (SELECT true AS doc, doc_id AS id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark),
w AS (SELECT doc, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
u AS MATERIALIZED (SELECT doc, id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS f
      FROM w),
d AS MATERIALIZED (SELECT f, hex(encode(f)) AS h, row_number() OVER () AS k FROM (SELECT DISTINCT f FROM u)),
r AS (SELECT k, 0 AS i, 4294967295 AS c FROM d
      UNION ALL
      SELECT r.k, r.i + 1, xor(crc.v, r.c >> 8) FROM r JOIN d ON d.k = r.k AND 2 * r.i < len(d.h)
      JOIN crc ON crc.n = xor(r.c, CAST('0x' || substr(d.h, 2 * r.i + 1, 2) AS BIGINT)) & 255),
b AS MATERIALIZED (SELECT d.f, xor(r.c, 4294967295) % 10000 AS bucket FROM r JOIN d ON d.k = r.k AND 2 * r.i = len(d.h)),
n AS (SELECT bucket, count(*) FILTER (WHERE doc) AS s, count(*) FILTER (WHERE NOT doc) AS t FROM u JOIN b USING (f) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
      FROM n),
m AS (SELECT id, count(*) AS n_features, sum(gain) AS total FROM u JOIN b USING (f) JOIN g USING (bucket) WHERE doc GROUP BY id),
x AS (SELECT w.id AS doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
             coalesce(CAST(floor(CAST(total AS DOUBLE) / n_features) AS BIGINT), 0) AS weight
      FROM w LEFT JOIN m ON m.id = w.id WHERE doc),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE))))
             AS BIGINT) AS score FROM x),
z AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM y WHERE n_words >= 20)
SELECT y.doc_id, y.n_features, y.weight, y.score, CASE WHEN place <= 25 * able // 100 THEN place END AS rank
FROM y LEFT JOIN z ON z.doc_id = y.doc_id
"""

SQL = {"op2_line_dedup": _OP2, "op5_secret_scan": _op5(), "op12_hard_negatives": _OP12,
       "op13_importance_resampling": _OP13}
