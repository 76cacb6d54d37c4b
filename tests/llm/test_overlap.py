"""Near copies by shingle overlap against all pairs."""

import random
import re

from pyspark.sql import functions as F

from sparquill.llm import overlap

DATA = "/root/testdata/sf0.001"


def _set(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _roots(texts):
    sets, root = {d: _set(t) for d, t in texts.items()}, {d: d for d in texts}
    near = [(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))]
    while any(root[a] != root[b] for a, b in near):
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    return root


def _got(docs, **options):
    return {r.doc_id: r.component_id for r in overlap.near_components(docs, **options).collect()}


def test_near_copies_against_all_pairs(spark):
    rng = random.Random(4)
    line, texts = " ".join(f"c{i}" for i in range(12)), {}
    for i in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 20, 60, 200]))]
        for _ in range(5):
            texts[len(texts)] = f"{line} {' '.join(words)}"
            words = words[:]
            words[rng.randrange(len(words))] = f"v{len(texts)}"
    texts |= {1000: None, 1001: " ", 1002: "a b", 1003: "A  b"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expect = _roots(texts)
    assert _got(docs) == _got(docs, sample=1) == expect and 44 < len(set(expect.values())) < 150


def test_stage_drops_all_near_copies(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    root = _roots({r.doc_id: r.text for r in docs.collect()})
    kept = corpus_pipeline.drop_near_copies(spark, docs, DATA)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(d for d in root if root[d] == d)
    assert root[145] == 6 and root[177] == 1
    several = spark.createDataFrame([(1, "a b c d"), (7, "a b c d"), (7, "e f g h i"), (9, "e f g h i"), (None, "a b c d")], "doc_id long, text string")
    assert set(_got(several).values()) == {1} and overlap.keep_first(several).where(F.col("doc_id").isNull()).count() == 1
    assert overlap.near_components(several.limit(0)).count() == 0
