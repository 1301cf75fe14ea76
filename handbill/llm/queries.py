"""The registered queries of this subpackage, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, langid, lines, minhash, mixing, packing, quality, topk, urls, warc
from .common import crc_mod, documents


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0, k=5)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(documents(spark, sf_dir).select("doc_id", "text"), added=True).select("doc_id", "text", "n_lines", "n_deleted", "words_deleted")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, index = warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return warc.read(path, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


#: Fixed values of the query's contract.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def op8_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(documents(spark, sf_dir), k=3, percent=85)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


QUERIES = {f.__name__: f for f in (op1_quality, op2_topk, op3_fingerprints, op4_lines, op5_warc, op6_packing, op7_urls, op8_near, op9_language, op10_mixing)}

SQL = {
    "op2_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op4_lines": r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM d),
c AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM l),
n AS (SELECT *, lead(line, 1) OVER o AS l1, lead(line, 2) OVER o AS l2, lead(w, 1) OVER o AS w1 FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
m AS (SELECT *, CASE WHEN w >= 50 THEN 1 WHEN w + w1 >= 50 THEN 2 WHEN l2 IS NOT NULL THEN 3 END AS m FROM n),
k AS (SELECT doc_id, pos, m, CASE m WHEN 1 THEN [line] WHEN 2 THEN [line, l1] ELSE [line, l1, l2] END AS body FROM m WHERE m IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) AS nth FROM k),
x AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + m)) AS pos FROM f WHERE nth > 1),
r AS (SELECT c.doc_id, string_agg(line, chr(10) ORDER BY c.pos) FILTER (x.pos IS NULL) AS text, count(*)::INTEGER AS n_lines, count(x.pos)::INTEGER AS n_deleted
      FROM c LEFT JOIN x ON c.doc_id = x.doc_id AND c.pos = x.pos GROUP BY c.doc_id),
a AS (SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted FROM d LEFT JOIN r USING (doc_id)),
p AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+') AS ps FROM a WHERE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) >= 50),
q AS (SELECT doc_id, len(ps) AS size, generate_subscripts(ps, 1) - 1 AS pos, unnest(ps) AS piece FROM p),
w AS MATERIALIZED (SELECT doc_id, size, pos, regexp_extract(piece, '[^\x20\x09-\x0D]+') AS word, regexp_extract(piece, '^[\x20\x09-\x0D]*') AS gap FROM q),
-- a word goes if it is in a passage of 50 words that occurs at an earlier place
v AS (SELECT doc_id, pos, size, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS body FROM w),
vf AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) AS nth FROM v WHERE pos <= size - 50),
fd AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM vf WHERE nth > 1),
-- the pieces that stay: a run takes the white space before it along, but for a line break that the white space after it lacks
k1 AS (SELECT w.*, fd.pos IS NOT NULL AS gone, coalesce(lag(fd.pos IS NOT NULL) OVER (PARTITION BY w.doc_id ORDER BY w.pos), FALSE) AS after FROM w LEFT JOIN fd ON w.doc_id = fd.doc_id AND w.pos = fd.pos WHERE w.doc_id IN (SELECT doc_id FROM fd)),
k2 AS (SELECT *, last_value(CASE WHEN gone AND NOT after THEN pos END IGNORE NULLS) OVER h AS run_at, last_value(CASE WHEN gone AND NOT after THEN gap END IGNORE NULLS) OVER h AS run_gap FROM k1 WINDOW h AS (PARTITION BY doc_id ORDER BY pos)),
k3 AS (SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(CASE WHEN NOT after THEN gap WHEN run_at = 0 THEN '' WHEN contains(run_gap, chr(10)) AND NOT contains(gap, chr(10)) THEN run_gap ELSE gap END || word, '' ORDER BY pos) FILTER (NOT gone) AS body FROM k2 GROUP BY doc_id)
SELECT a.doc_id, CASE WHEN k3.doc_id IS NULL THEN a.text ELSE coalesce(body, '') || regexp_extract(a.text, '[\x20\x09-\x0D]*$') END AS text, n_lines, n_deleted, coalesce(k3.n, 0)::INTEGER AS words_deleted FROM a LEFT JOIN k3 ON a.doc_id = k3.doc_id""",
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, octet_length(encode(body)) AS n, max(page_id) AS top FROM p GROUP BY ALL),
j AS (SELECT p.page_id, m.n, p.h, m.top FROM p JOIN m ON p.h = m.h)
SELECT page_id, n::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (5 * i + 1)::INTEGER, 5))::INTEGER >> s) & 31) + 1, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM j""",
    "op6_packing": r"""
WITH RECURSIVE s AS (SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS n FROM documents),
g AS (SELECT n, count(*) AS c FROM s GROUP BY 1),
h AS (SELECT 0 AS j, 0::BIGINT AS n, 0::HUGEINT AS cnt, 0::HUGEINT AS tot UNION ALL
      SELECT row_number() OVER (ORDER BY n), n, sum(c) OVER (ORDER BY n), sum(c * n) OVER (ORDER BY n) FROM g),
m AS (SELECT max(j) AS m FROM h),
-- the least padding of the first j lengths in so many buckets, and where the last one begins
dp AS (SELECT 0 AS level, 0::BIGINT AS j, 0::HUGEINT AS cost, 0::BIGINT AS origin
       UNION ALL
       SELECT level, j, best.c, -best.i FROM (
         SELECT d.level + 1 AS level, h.j, min({'c': d.cost + h.n * (h.cnt - p.cnt) - (h.tot - p.tot), 'i': -d.j}) AS best
         FROM dp d JOIN h p ON p.j = d.j JOIN h ON h.j > d.j WHERE d.level < 16 GROUP BY d.level, h.j)),
bt AS (SELECT level, j FROM (SELECT level, j FROM dp, m WHERE j = m AND m > 0 ORDER BY cost, level LIMIT 1)
       UNION ALL
       SELECT dp.level - 1, dp.origin FROM bt JOIN dp ON dp.level = bt.level AND dp.j = bt.j WHERE dp.origin > 0),
t AS (SELECT n AS top, (row_number() OVER (ORDER BY n) - 1)::INTEGER AS bucket, coalesce(lag(n) OVER (ORDER BY n), -1) AS low FROM bt JOIN h USING (j)),
r AS (SELECT doc_id, n, bucket, top, greatest(1, 16384 // greatest(top, 1)) AS each, row_number() OVER (PARTITION BY bucket ORDER BY doc_id NULLS FIRST, n) - 1 AS nth FROM s JOIN t ON n > low AND n <= top)
SELECT doc_id, n AS n_tokens, bucket, top AS padded_to, nth // each AS batch, (nth % each)::INTEGER AS slot FROM r""",
    "op7_urls": """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
r(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT h.page_id, h.host, h.path, rhost || rpath AS rule, rverdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
      FROM h LEFT JOIN r ON ('.' || h.host) LIKE ('%.' || rhost) AND starts_with(h.path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM m WHERE k = 1""",
    "op8_near": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
k AS (SELECT dense_rank() OVER (ORDER BY shingle) AS k, doc_id FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM k x JOIN k y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a AS node, a AS seen FROM u UNION SELECT u.b, r.seen FROM r JOIN u ON u.a = r.node),
c AS (SELECT node, min(seen) AS least FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id, coalesce(c.least, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.node = d.doc_id""",
}
