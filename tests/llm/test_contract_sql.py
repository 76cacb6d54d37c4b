"""Columns of op4, op6 and op8 that DuckDB can state, and an independent scorer of op9."""

import hashlib
import math
import zlib

import duckdb
import numpy as np
import pytest

from sparquill.llm import quality
from sparquill.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    return c


def _equal(spark, name, columns, duck, sql):
    ours = sorted(map(tuple, QUERIES[name](spark, DATA).select(*columns).collect()))
    assert ours == sorted(duck.execute(sql).fetchall()) and ours


def test_fingerprint_columns(spark, duck):
    """The edited text: the end of each text replaced by the beginning of the next one, by descending id, and after the last the first."""
    sql = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    n AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS next, length(t) // 2 AS k FROM d)
    SELECT doc_id, CAST(length(t) AS BIGINT), sha256(substring(t, 1, length(t) - k) || substring(next, 1, k)) FROM n"""
    _equal(spark, "op4_fingerprint", ["doc_id", "n_chars", "edited_sha256"], duck, sql)


def test_sharding_columns(spark, duck):
    """Sizes and check sums, gapless slots, and shards of nearly equal bytes."""
    rows = QUERIES["op6_sharding"](spark, DATA).collect()
    docs = {d: (t or "").encode() for d, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {d: (len(t) + 8, zlib.crc32(t)) for d, t in docs.items()} and len(rows) == len(docs)
    duck.execute("CREATE OR REPLACE TABLE got AS SELECT * FROM (VALUES " + ", ".join(f"({r.doc_id}, {r['size']}, {r.shard}, {r.slot}, '{r.law}')" for r in rows) + ") t(doc_id, size, shard, slot, law)")
    (law, shards, gaps, low, high, largest) = duck.execute("""
    WITH s AS (SELECT shard, min(law) AS law, count(*) AS n, count(DISTINCT slot) AS slots, min(slot) AS a, max(slot) AS b, sum(size) AS bytes FROM got GROUP BY shard)
    SELECT min(law), count(*), sum(CAST(slots <> n OR a <> 0 OR b <> n - 1 AS INT)), min(bytes), max(bytes), (SELECT max(size) FROM got) FROM s""").fetchone()
    assert law == "bytes" and shards <= 24 and gaps == 0 and high - low <= 2 * largest
    assert duck.execute("SELECT min(shard) >= 0 AND max(shard) < 24 FROM got").fetchone()[0]


def test_secret_counts(spark, duck):
    """Base findings by DuckDB's regular expressions, and their digest from plain positions."""
    sql = r"""
    SELECT doc_id,
      CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 'i'), lambda s: length(s) >= 12)) AS BIGINT),
      CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda s: length(s) >= 18)) AS BIGINT),
      CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda s: length(s) >= 16)) AS BIGINT)
    FROM documents"""
    _equal(spark, "op8_secrets", ["doc_id", "n_assign", "n_access", "n_hex"], duck, sql)
    for r in QUERIES["op8_secrets"](spark, DATA).collect():
        base = [s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest() and len(base) == r.n_assign + r.n_access + r.n_hex


def test_attention_by_hand(spark):
    """Scores of gated attention number by number, from the same parameters and passages."""
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.train(docs, labels)
    sigmoid = lambda x: 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
    hidden, width = model.v.shape[1], model.v.shape[0]

    def score(text):
        weights, values = [], []
        for passage in quality.passages(text):
            h = [(float(x) - float(m)) / float(s) for x, m, s in zip(quality.encode(passage), model.mean, model.scale)]
            gates = [math.tanh(sum(h[i] * model.v[i][j] for i in range(width))) * sigmoid(sum(h[i] * model.u[i][j] for i in range(width))) for j in range(hidden)]
            weights.append(sum(g * w for g, w in zip(gates, model.w)))
            values.append(sum(x * c for x, c in zip(h, model.c)))
        top = max(weights)
        parts = [math.exp(w - top) for w in weights]
        return sigmoid(sum(p * v for p, v in zip(parts, values)) / sum(parts) + model.b)

    some = docs.orderBy("doc_id").limit(25).collect()
    got = {r.doc_id: r.s for r in quality.with_score(docs, model, "s").collect()}
    assert np.allclose([got[r.doc_id] for r in some], [score(r.text or "") for r in some], atol=1e-5)
    assert all(b"".join(quality.passages(r.text or "")) == (r.text or "").encode() for r in some)
