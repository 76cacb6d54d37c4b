"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm import audit, clusters, decontaminate, fingerprint, neighbours, packing, pii, quality, secrets, sharding, simhash, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.byte_shards(_table(spark, sf_dir, "documents"), 24)


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(_table(spark, sf_dir, "documents"), key="an example key; give your own")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents")).drop("findings")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.kmeans(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_toxicity, op3_simhash, op4_fingerprint, op5_warc, op6_sharding, op7_pseudonyms, op8_secrets, op9_quality,
        op10_packing, op11_neighbours, op12_audit, op13_clusters, pipeline,
    )
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: The filters of op12 and the number of each in a mask.
_ORDERS = """
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(letter, bit)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS bit, CAST(coalesce(list_sum(bits[1 : i - 1]), 0) AS INTEGER) AS before
  FROM (SELECT *, unnest(range(1, 6)) AS i FROM orders))"""


def _lloyd(k: int = 16, rounds: int = 3) -> str:
    """Plain rounds of op13: every distance, exact in doubles for these vectors."""
    assign = """a{r} AS MATERIALIZED (
  SELECT v.r, min({{'d': list_inner_product(v.v, v.v) - 2 * list_inner_product(v.v, c.v) + list_inner_product(c.v, c.v), 'c': c.c}}) AS m
  FROM v, c{r} c GROUP BY v.r)"""
    update = """c{s} AS MATERIALIZED (
  SELECT c.c, coalesce(n.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT c, list(x ORDER BY i) AS v FROM (
      SELECT c, i, floor(sum(x) / count(*)) AS x FROM (SELECT a.m.c AS c, unnest(range(1, 65)) AS i, unnest(v.v) AS x FROM a{r} a JOIN v USING (r)) GROUP BY c, i)
    GROUP BY c) n USING (c))"""
    return ",\n".join([assign.format(r=0), *(part for r in range(rounds) for part in (update.format(r=r, s=r + 1), assign.format(r=r + 1)))])


ORACLE_SQL: dict[str, str] = {
    "op12_audit": rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
marks AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d JOIN firsts USING (t)),
hist AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM (
    SELECT part, doc_id, CAST(len(words) < 100 AS INTEGER) + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INTEGER)
      + 4 * CAST(100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS INTEGER) + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
      + 16 * CAST(coalesce(doc_id > least, false) AS INTEGER) AS mask
    FROM w) LEFT JOIN marks USING (doc_id)
  GROUP BY part, mask),
{_ORDERS},
met AS (
  SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM hist, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM met
""",
    "op13_clusters": f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS c, v FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM v WHERE vec_id IS NOT NULL ORDER BY h LIMIT 16)),
{_lloyd()}
SELECT vec_id, a.m.c AS cluster, CAST(a.m.d AS BIGINT) AS distance, CAST(sum(a.m.d) OVER (PARTITION BY a.m.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN c.v], ',')) AS centroid_sha256
FROM a3 a JOIN v USING (r) JOIN c3 c ON c.c = a.m.c
""",
    "op1_decontaminate": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM wins) WHERE len(w) >= size)),
hits AS (SELECT p.doc_id, p.i, p.size, x.item_id FROM places p JOIN wins x ON p.size = x.size AND p.win = x.win),
words AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id),
met AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(met.ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(met.ids, ','), '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN met USING (doc_id)
""",
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS first FROM p),
b AS (SELECT *, array_to_string([lpad(to_base(CAST('0x' || hex[10 * i + 1 : 10 * i + 10] AS BIGINT), 32), 8, '0') FOR i IN range(4)], '') AS digits FROM d)
SELECT page_id, payload_bytes, translate(digits, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM b
""",
}
