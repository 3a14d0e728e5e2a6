"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# Words, lines and 3-word windows of every document; the verdict joins the base
# rules with the limits of sievery.llm.quality.
QUALITY = r"""
WITH w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
  FROM (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))),
p AS (
  SELECT doc_id, count(DISTINCT j) AS n_rep
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_rep, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines
  FROM w LEFT JOIN p USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
FROM f
"""

LINES = r"""
WITH l AS (
  SELECT doc_id, i, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
               generate_subscripts(string_split(t, chr(10)), 1) AS i
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))),
k AS (
  SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (
  SELECT l.doc_id, i, line, k.key IS NOT NULL AND l.doc_id <> k.first AS gone
  FROM l LEFT JOIN k USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

ARCHIVES = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
k AS (
  SELECT h, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY h HAVING count(*) > 1)
SELECT page_id, n AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM p LEFT JOIN k ON p.h = k.h
"""

# CRC-32 of a text, byte by byte with the table of its polynomial: ``tab`` holds the table.
CRC_TABLE = """
tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i)))"""


def crc32(text: str) -> str:
    return ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform("
            f"regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)), "
            "lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)")


# The order of a bucket after Fisher-Yates: row i comes at place j; it stays until the next row
# that draws its place sends it to the end, which is that row's number.
SHARDS = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, {crc32("coalesce(text, '')")} AS crc
  FROM documents, tab),
h AS (
  SELECT *, ('0x' || substr(md5(concat_ws(':', 20241, coalesce(doc_id::VARCHAR, 'null'), size, crc)),
                            1, 15))::BIGINT AS h
  FROM d),
m AS (
  SELECT greatest(1, ceil(count(*) / 1024), ceil(sum(size) / 4194304))::BIGINT AS buckets,
         count(*) AS rows FROM h),
b AS (
  SELECT doc_id, size, crc, h % buckets AS bucket,
         row_number() OVER (PARTITION BY h % buckets ORDER BY doc_id NULLS FIRST, size, crc) - 1 AS i
  FROM h, m),
e AS (
  SELECT *, ('0x' || substr(md5(concat_ws(':', 20241, bucket, i)), 1, 15))::BIGINT % (i + 1) AS j FROM b),
o AS (
  SELECT *, lead(i) OVER (PARTITION BY bucket, j ORDER BY i) AS moved FROM e),
nx AS (
  SELECT bucket, j AS place, min(i) AS next FROM e WHERE i > j GROUP BY bucket, j),
walk AS (
  SELECT bucket, i, moved AS place FROM o WHERE moved IS NOT NULL
  UNION ALL
  SELECT w.bucket, w.i, nx.next FROM walk w JOIN nx ON nx.bucket = w.bucket AND nx.place = w.place),
ends AS (
  SELECT bucket, i, max(place) AS place FROM walk GROUP BY bucket, i),
f AS (
  SELECT bucket, sum(count(*)) OVER (ORDER BY bucket) - count(*) AS before FROM e GROUP BY bucket),
p AS (
  SELECT o.*, (f.before + coalesce(ends.place, o.j))::BIGINT AS p
  FROM o JOIN f USING (bucket) LEFT JOIN ends ON ends.bucket = o.bucket AND ends.i = o.i)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, (p * 16 // rows)::INTEGER AS shard,
       (p - (p * 16 // rows * rows + 15) // 16)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM p, m
"""

def codes(rounds: int = 6, entries: int = 16, parts: int = 8) -> str:
    """Rounds of assignment and floored means, one after the other; a part's nearest entry is the
    least of 16 * distance + entry."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS MATERIALIZED (
  SELECT x.id, x.p, min(d * {entries} + e)::BIGINT AS m FROM (
    SELECT x.id, x.p, c.e, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d
    FROM x JOIN c{r} c ON x.p = c.p AND x.k = c.k GROUP BY x.id, x.p, c.e) x GROUP BY x.id, x.p)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (
  SELECT x.p, (m % {entries})::INTEGER AS e, x.k, sum(v)::BIGINT AS s, count(*) AS n
  FROM x JOIN d{r} d ON d.id = x.id AND d.p = x.p GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, c.k, coalesce((s - ((s % n) + n) % n) // n, c.v)::BIGINT AS v
  FROM c{r} c LEFT JOIN s{r} s ON s.p = c.p AND s.e = c.e AND s.k = c.k)""")
    return f"""
WITH w AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS id,
         list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (
  SELECT id, (k // (n // {parts}))::INTEGER AS p, (k % (n // {parts}))::INTEGER AS k, v FROM (
    SELECT id, len(v) AS n, unnest(v) AS v, unnest(range(len(v))) AS k FROM w)),
c0 AS (SELECT p, id::INTEGER AS e, k, v FROM x WHERE id < {entries}),{",".join(steps)},
f AS (
  SELECT id, string_agg(format('{{:02x}}', m % {entries}), '' ORDER BY p) AS code,
         sum(m // {entries})::BIGINT AS error FROM d{rounds} GROUP BY id),
b AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, k)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM w JOIN f USING (id), b
"""


# Near words are equal without the letter at one place, or one is the other without a letter.
SPELLING = f"""
WITH RECURSIVE {CRC_TABLE},
r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
g AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 6 GROUP BY ALL),
h AS (
  SELECT run, n, {crc32("concat(coalesce(doc_id::VARCHAR, ''), ':', run)")} AS h FROM g, tab),
w AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0
           THEN concat(substr(run, 1, (h % length(run))::BIGINT), substr(run, (h % length(run))::BIGINT + 2))
           ELSE run END AS word, n FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
k AS MATERIALIZED (
  SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS key
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
  UNION ALL SELECT word, n, 0, word FROM w),
p AS MATERIALIZED (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n
  FROM k a JOIN k b ON a.key = b.key AND a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)),
b AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM p GROUP BY word),
o AS (
  SELECT b.word, n_near, best_n, min(other) AS best
  FROM b JOIN p ON p.word = b.word AND p.other_n = b.best_n GROUP BY ALL),
v AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form,
         CASE WHEN best_n >= 5 * w.n THEN best_n END::BIGINT AS form_n
  FROM w LEFT JOIN o USING (word)),
f AS (
  SELECT word, form AS last FROM v WHERE form IS NOT NULL
  UNION ALL
  SELECT f.word, v.form FROM f JOIN v ON v.word = f.last WHERE v.form IS NOT NULL),
l AS (
  SELECT f.word, f.last FROM f JOIN v ON v.word = f.last WHERE v.form IS NULL)
SELECT v.word, form, coalesce(last, v.word) AS root, n, n_near, form_n FROM v LEFT JOIN l ON l.word = v.word
"""


ORACLE: dict[str, str] = {
    "op1_quality_rules": QUALITY,
    "op2_line_dedup": LINES,
    "op6_warc": ARCHIVES,
    "op11_sharding": SHARDS,
    "op12_vector_codes": codes(),
    "op13_spelling_variants": SPELLING,
}
