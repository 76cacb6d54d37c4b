"""Connected groups of overlapping boxes: the sweep, and keys beyond one task, against all pairs."""

import random

from sparquill.operators import folds


def _plain(boxes: dict) -> dict:
    """The smallest number of each box's group, by all pairs of a key."""
    root = {b: b for b in boxes}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in boxes:
        for b in boxes:
            (p, q), (r, s) = (boxes[a][:2], boxes[a][2:]), (boxes[b][:2], boxes[b][2:])
            if a[0] == b[0] and a < b and p[0] <= s[0] and r[0] <= q[0] and p[1] <= s[1] and r[1] <= q[1]:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {b: find(b)[1] for b in boxes}


def _random(rng, n, span, size, key=0):
    out = {}
    for i in range(n):
        x, y = rng.randrange(span), rng.randrange(span)
        out[key, i] = (x, y, x + rng.choice([0, 1, size, 3 * size]), y + rng.choice([0, 1, size, 2 * size]))
    return out


def test_sweep():
    rng = random.Random(3)
    for trial in range(400):
        boxes = _random(rng, rng.randrange(1, 40), rng.choice([8, 30, 90]), rng.choice([1, 4, 9]))
        columns = list(zip(*boxes.values()))
        got = folds._components([i for _, i in boxes], *(list(c) for c in columns))
        assert dict(zip(boxes, got)) == _plain(boxes), trial


def test_sweep_of_boxes_over_each_other():
    """Boxes that all overlap do not pile up: a hundred thousand of them take seconds, not hours."""
    n = 100_000
    got = folds._components(list(range(n)), list(range(n)), [i % 7 for i in range(n)], [2 * n] * n, [7 + i % 5 for i in range(n)])
    assert set(got) == {0}


def test_large_keys(spark):
    rng = random.Random(5)
    boxes = _random(rng, 300, 150, 4) | _random(rng, 20, 30, 4, key=1) | {(2, i): (5, 5, 9, 9) for i in range(90)} | {(3, i): (5, 3 * i, 5, 3 * i + (3 if i % 10 else 1)) for i in range(120)}
    boxes |= {(4, i): (0, i, 1000, i) for i in range(60)} | {(4, 100 + i): (7 * i, 0, 7 * i, 100) for i in range(30)}
    df = spark.createDataFrame([(*b, *map(float, r)) for b, r in boxes.items()], "page int, box int, x0 double, y0 double, x1 double, y1 double")
    expect = _plain(boxes)
    for most in (10**6, 50, 16):
        got = {(r.page, r.box): r.component for r in folds.overlap_components(df, "page", "box", most).collect()}
        assert got == expect, most
    assert folds.overlap_components(df.limit(0), "page", "box", 5).count() == 0
