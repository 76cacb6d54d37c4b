"""The sample that the quality classifier is fitted on."""

import numpy as np

from sparquill.llm import quality


def test_passage_bound():
    assert quality.passage_bound([(1, 10), (100, 2)], 30) == 10 and quality.passage_bound([(1, 10), (100, 2)], 300) == 100
    assert quality.passage_bound([], 5) == 1 and quality.passage_bound([(3, 9)], 5) == 1
    text = " ".join(f"{i:07d}" for i in range(4000))
    whole, some = quality.bag(text), quality.bag(text, 5)
    at = [int(np.flatnonzero((whole == x).all(axis=1))[0]) for x in some]
    assert len(some) == 5 and at == sorted(at) and at[0] < len(whole) // 5 and at[-1] >= len(whole) * 4 // 5


def test_a_long_document_with_a_low_id_does_not_crowd_out_the_others(spark):
    rows = [(i, "plain words of a text " * 8 if i % 2 else "p###l w@@@s 12 " * 8) for i in range(200)] + [(-2, "p###l w@@@s 12 " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(-2, 0)], "doc_id long, quality int")
    scored = quality.quality(docs, labels, max_passages=250).collect()
    assert all(r.predicted == (r.doc_id % 2 if r.doc_id >= 0 else 0) for r in scored)
