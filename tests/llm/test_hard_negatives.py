"""Hard negatives against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import hard_negatives as hn


def plain(rows, every=100, n_positives=5, k=10):
    clean = set()
    for vec_id, vec, label in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id is not None and vec_id % 7 == 0 else label
        clean.add((vec_id, label, tuple(math.floor(256 * x) for x in vec)))
    out = []

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2]))

    def order(x):
        return -x[0], x[1][0] is None, x[1][0] or 0

    for a in clean:
        if a[0] is None or a[0] % every:
            continue
        scored = [(score(a, b), b) for b in clean if b != a]
        for p, pos in sorted((x for x in scored if x[1][1] == a[1]), key=order)[:n_positives]:
            fit = [x for x in scored if x[1][1] != a[1] and 30 * p <= 100 * x[0] <= 90 * p]
            out += [(a[0], pos[0], r, b[0], p, s) for r, (s, b) in enumerate(sorted(fit, key=order)[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, key int")
    return sorted((tuple(r) for r in hn.hard_negatives(df, **kw).collect()), key=str)


def vectors(seed, n, width=6, labels=3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(labels, width))
    return [(int(i), [float(np.float32(x)) for x in centres[i % labels] + random.normal(size=width) * 0.7], int(i % labels)) for i in range(n)]


@pytest.mark.parametrize("sizes", [(8192, 4096), (64, 8)])
def test_equals_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(hn, "CANDIDATES", sizes[0])
    monkeypatch.setattr(hn, "ANCHORS", sizes[1])
    monkeypatch.setattr(hn, "STEP", 16)
    monkeypatch.setattr(hn, "MEMBERS", 4)
    rows = vectors(1, 400)
    got = found(spark, rows, every=10)
    assert got == plain(rows, every=10) and len(got) > 500


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rows = vectors(2, 120)
    rows += [(1000 + i, rows[3][1], 0) for i in range(30)] + [(1100 + i, rows[4][1], 1) for i in range(30)]  # many equal vectors
    rows += [rows[0], rows[0], (0, rows[5][1], 2)]  # a repeated row, an id used twice
    rows += [(2000, None, 1), (2001, [1.0] * 6, None), (2100, [1.0, None] * 3, 1), (2200, [float("nan")] * 6, 1), (2300, [float("inf")] * 6, 1)]
    rows += [(2400, [0.0] * 6, 1), (2500, [], 1), (2600, [1.0, 2.0], 1), (2700, [-x for x in rows[3][1]], 0), (None, rows[3][1], 1), (None, rows[3][1], 0)]
    rows += [(-100, rows[7][1], 1), (-7, rows[8][1], 9)]
    got = found(spark, rows)
    assert got == plain(rows) and got


def test_empty_and_lonely(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1)]) == []
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float((i * 37 % 91) * 2**14 + i), float(i % 5) * 2**13], i % 2) for i in range(60)]
    assert found(spark, rows, every=20) == plain(rows, every=20)


def test_a_walk_stops_early():
    random = np.random.default_rng(5)
    x = random.normal(size=(5000, 8)) + np.array([4.0] + [0] * 7) * random.choice([-1, 1], (5000, 1))
    table = pa.table({"vec_id": np.arange(5000), "key": np.arange(5000), "label": np.zeros(5000, np.int64), "vec": [np.floor(256 * v).astype("<i8").tobytes() for v in x]})
    b = hn.Vectors(table, 8)
    a = hn.Vectors(table.slice(0, 64), 8)
    seen = []

    def fits(needs, rows, score):
        seen.append(score.size)
        return np.ones(score.shape, bool)

    best = hn.Best(64, 5, np.full(64, -(2**63)))
    hn.walk(a, b, np.arange(64), best, fits)
    top = np.sort(a.v @ b.v.T, axis=1)[:, -5:]
    assert [sorted(best.score[best.need == i].tolist()) for i in range(64)] == top.tolist()
    assert sum(seen) < 64 * 5000 * 0.7
