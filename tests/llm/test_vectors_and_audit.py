"""op11 to op13 against plain versions, and their edge cases."""

import hashlib
import math
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparquill.llm import audit, clusters, neighbours
from sparquill.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, id long, v int, cell string, query string, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2, "c", "q", 0.5) for i, v in rows], VECTORS)


# -- nearest neighbours -------------------------------------------------------


def cosine(a, b):
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def plain_nearest(rows, k, every):
    good = {(i, tuple(np.float32(v).astype(float))) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for i, v in good:
        if i % every == 0:
            near = sorted((-round(cosine(np.array(v), np.array(w)), 12), j) for j, w in good if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return sorted(out)


def asked(spark, rows, every, **options):
    found = neighbours.nearest(vectors(spark, rows), F.col("id") % every == 0, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in found.collect())


def test_nearest_of_odd_vectors(spark):
    """Nulls, zeros, non-finite, other lengths, extreme sizes, copies, repeated rows and ids with two vectors; no test is missed when nearly certain."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(12)] + [(100, rows[0][1])] * 3 + [(7, rows[9][1]), (10, rows[11][1])]
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [math.nan] + [1.0] * 7), (204, [math.inf] + [1.0] * 7), (205, [None] + [1.0] * 7), (None, [1.0] * 8)]
    rows += [(210, [1.0, 2.0]), (211, [2.0, 1.0]), (220, [-x for x in rows[0][1]]), (221, [1e-30 * x for x in rows[1][1]]), (222, [1e30 * x for x in rows[2][1]])]
    assert asked(spark, rows, 10, k=5, m=4, certainty=1 - 1e-9, cell_rows=8, sample_rows=400) == plain_nearest(rows, 5, 10)


def test_nearest_of_few(spark):
    assert asked(spark, [], 50) == [] and asked(spark, [(50, [1.0, 0.0])], 50) == []
    assert asked(spark, [(50, [1.0, 0.0]), (1, [0.0, 1.0])], 50) == [(50, 1, 1, 0.0)]


def test_copies_of_a_third(spark):
    """Queries and candidates that are one vector: the smallest ids, the query's own left out."""
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.standard_normal(4).tolist()) for i in range(600)]
    got = asked(spark, rows, 50, m=4, cell_rows=64)
    for q in (0, 150, 300, 450):
        assert [r[2] for r in got if r[0] == q] == [i for i in range(0, 99, 3) if i != q][:5]


def test_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    rows += [(1000 + i, (np.array(v) + np.random.default_rng(i).normal(0, 0.05, len(v))).tolist()) for i, v in rows]
    got, true = asked(spark, rows, 10, cell_rows=128), plain_nearest(rows, 5, 10)
    assert len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in true}) >= 0.95 * len(true)
    exact = {(q, v): s for q, _, v, s in plain_nearest(rows, len(rows), 10)}
    assert all(abs(exact[q, v] - s) < 1e-9 for q, _, v, s in got)


def test_chi_square():
    # published upper quantiles
    assert [round(neighbours.chi_square_quantile(p, m), 3) for p, m in ((0.95, 2), (0.99, 4), (0.95, 12), (0.5, 10))] == [5.991, 13.277, 21.026, 9.342]
    with pytest.raises(ValueError):
        neighbours.chi_square_quantile(0.9, 3)


def test_query_is_whole(spark):
    n = spark.read.parquet(f"{DATA}/embeddings.parquet").where("vec_id % 50 = 0").count()
    assert QUERIES["op11_neighbours"](spark, DATA).count() == 5 * n


# -- filter audit -------------------------------------------------------------


def plain_audit(docs, labels):
    """Every order applied to the documents one step after another."""
    good, toxic = ({i for i, *y in labels if i is not None and y[k] == 1} for k in (0, 1))
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))

    def fails(i, t):
        words = (t or "").encode().split()
        return {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t or "") > 10 * len(t or ""),
            "D": any(c in "#$%&*|" for c in t or ""), "E": i is not None and least[t or ""] < i,
        }

    rows, out = [(i, p or "", fails(i, t)) for i, t, p in docs], {}
    for part in {p for _, p, _ in rows}:
        shapley, steps = dict.fromkeys("ABCDE", 0), []
        for order in map("".join, permutations("ABCDE")):
            left = [(i, f) for i, p, f in rows if p == part]
            whole = left
            for k, letter in enumerate(order):
                gone, left = [i for i, f in left if f[letter]], [(i, f) for i, f in left if not f[letter]]
                failing = [f for _, f in whole if f[letter]]
                redundant = sum(any(f[x] for x in order[:k]) for f in failing)
                shapley[letter] += len(gone)
                steps.append([order, k + 1, letter, len(left), len(gone), redundant, sum(sum(f.values()) == 1 for f in failing), sum(i in good for i in gone), sum(i in toxic for i in gone)])
        out |= {(part, o, k): (*counts, shapley[letter]) for o, k, letter, *counts in steps}
    return out


AUDITED = "doc_id long, text string, lang string, mask int, part string, n long, digest string, salt long, good int, toxic int"


@pytest.mark.parametrize("empty", [False, True])
def test_audit_of_odd_documents(spark, empty):
    words = " ".join(f"w{i}" for i in range(100))
    texts = ["", None, words, "A B C", words + " #", "same same " * 80, "  \t\n\x0b\x0c\r ", words, words, "a\xa0b c " * 70, "ÄÖÜ Ab" * 3, words * 300, "", words.upper()]
    docs = [] if empty else [(i, t, ("en", None, "", "de")[i % 4]) for i, t in enumerate(texts)]
    docs += [] if empty else [(2, words, "en"), (2, words, "en"), (None, words, "en"), (None, None, None), (5, words, "fr"), (-3, "A B C", "de")]
    labels = [(0, 1, 0), (1, 0, 1), (2, 1, 1), (2, 0, None), (7, 1, 1), (8, None, 1), (None, 1, 1), (99, 1, 1), (12, 1, 0), (13, 1, 1)]
    found = audit.audit(spark.createDataFrame([(*d, 1, "x", 2, "y", 3, 4, 5) for d in docs], AUDITED), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in found} == plain_audit(docs, labels) and len(found) == (0 if empty else 600 * 4)


# -- clustering ---------------------------------------------------------------


def plain_kmeans(rows, k=16, rounds=3):
    """Lloyd's rounds in Python's integers."""
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    now = [v for _, v in sorted((x for x in kept if x[0] is not None), key=lambda x: (sha(x[0]), x[1]))[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(now))
    for _ in range(rounds):
        groups = [[v for _, v in kept if nearest(v)[1] == j] for j in range(len(now))] if now else []
        now = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, now)]
    final = [(i, *nearest(v)[::-1]) for i, v in kept] if now else []
    inertia = lambda j=None: sum(d for _, c, d in final if j in (None, c))
    return sorted(((i, c, d, inertia(c), inertia(), hashlib.sha256(",".join(map(str, now[c])).encode()).hexdigest()) for i, c, d in final), key=str)


def odd_vectors():
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 0.3, (5, 64))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.02, 64)).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [rows[3]] * 4 + [(None, rows[4][1])]
    return rows + [(300, None), (301, []), (302, [1.0] * 63), (303, [math.nan] * 64), (304, [math.inf] * 64), (305, [None] * 64), (306, [0.0] * 64), (307, [-3.5] * 64)]


@pytest.mark.parametrize("rows", [odd_vectors(), odd_vectors()[:5], [], [(None, [1.0] * 64)], [(1, [2.0] * 64)] * 3])
def test_kmeans(spark, rows):
    found = clusters.kmeans(vectors(spark, rows))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_kmeans(rows)


def test_bounds_are_exact():
    """Ten rounds with ties on a small lattice, for every number of stored bounds."""
    rng = np.random.default_rng(1)
    v = rng.integers(-3, 4, (400, 4))
    for bounds in range(7):
        c = v[:8].copy()
        cluster, d2, ids, lows, rest = clusters.scan(v, c, bounds)
        for _ in range(10):
            old, sums = c, [v[cluster == j] for j in range(8)]
            c = np.array([s.sum(0) // len(s) if len(s) else o for s, o in zip(sums, old)])
            cluster, d2, ids, lows, rest, _ = clusters.step(v, c, np.sqrt(((c - old) ** 2).sum(1)) * (1 + 1e-9), cluster, ids, lows, rest)
            plain = ((v[:, None] - c) ** 2).sum(2)
            assert (cluster == plain.argmin(1)).all() and (d2 == plain.min(1)).all()


def test_large_components_are_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        clusters.kmeans(vectors(spark, [(1, [1e9] * 64)])).collect()
