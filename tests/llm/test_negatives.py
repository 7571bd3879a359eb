import math

import numpy as np
import pytest

from gapweave.llm import negatives


def brute(rows, every=50):
    by = {}
    for key, v, label in rows:
        if key is None or label is None or not v or any(x is None or not math.isfinite(x) or abs(x) >= negatives.LARGEST for x in v):
            continue
        one = ((label + 1) % 10 if key % 7 == 0 else label, [math.floor(256 * x) for x in v])
        by[key] = min(by.get(key, one), one)
    out = set()
    for a, (label, v) in by.items():
        if a % every:
            continue
        scores = {k: sum(x * y for x, y in zip(v, w)) for k, (_, w) in by.items() if k != a and len(w) == len(v)}
        order = sorted(scores, key=lambda k: (-scores[k], k))
        for p in [k for k in order if by[k][0] == label][:5]:
            good = [k for k in order if by[k][0] != label and 50 * scores[p] <= 100 * scores[k] <= 95 * scores[p]]
            out |= {(a, p, i + 1, k, scores[p], scores[k]) for i, k in enumerate(good[:3])}
    return out


def result(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, id string")
    found = negatives.hard_negatives(df, **settings).collect()
    out = {(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in found}
    assert len(out) == len(found)
    return out


def clustered(count, seed, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = []
    for k in range(count):
        v = centres[rng.integers(12)] * rng.choice([0.3, 1.0, 2.0]) + rng.choice([0.0, 0.1, 0.6]) * rng.standard_normal(dim)
        rows.append((k, [float(x) for x in v], int(rng.integers(0, 10))))
    return rows


@pytest.mark.parametrize("settings", [{}, {"block": 40, "fanout": 4}, {"block": 16, "fanout": 3, "sample": 60}])
def test_against_brute_force(spark, settings):
    rows = clustered(700, 4)
    want = brute(rows, 10)
    assert len(want) > 500
    assert result(spark, rows, every=10, **settings) == want


def test_whole_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert result(spark, rows, block=64, fanout=4) == brute(rows)


def test_one_vector_in_a_third_of_the_rows(spark):
    rows = clustered(400, 5)
    rows += [(1000 + k, rows[0][1], k % 3) for k in range(250)]
    assert result(spark, rows, every=25, block=32, fanout=4) == brute(rows, 25)


def test_tree_leaves_out_subtrees_and_no_row():
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((30, 8)) * 2000
    rows = (centres[rng.integers(30, size=3000)] + 40 * rng.standard_normal((3000, 8))).astype(np.int64)
    tree = negatives.Tree(rows[:500], float((rows.astype(float) ** 2).sum(axis=1).max()), 60, 4)
    leaves = tree.place(rows, widen=True)
    assert (tree.place(rows) == leaves).all()
    scores = rows[:50] @ rows.T
    visited = 0
    low, high = np.quantile(scores, 0.9, axis=1), np.quantile(scores, 0.95, axis=1)
    seen = np.zeros((50, tree.leaves), bool)
    for leaf, who in tree.visits(rows[:50], [np.array([x]) for x in low], [np.array([x]) for x in high]):
        seen[who, leaf] = True
        visited += len(who)
    for k in range(50):
        assert seen[k, np.unique(leaves[(scores[k] >= low[k]) & (scores[k] <= high[k])])].all()
    assert visited < 0.6 * 50 * tree.leaves


def test_odd_rows(spark):
    x = [1.0, 2.0, 3.0]
    rows = [(0, x, 1), (1, x, 1), (1, x, 1), (2, [2.0, 1.0, 2.0], 2), (3, None, 1), (4, [], 1), (5, [1.0, None, 2.0], 1), (6, [math.nan] * 3, 1),
            (8, [math.inf, 0.0, 0.0], 1), (9, x, None), (None, x, 1), (10, [1.0, 2.0], 1), (50, [1.0, 1.0], 1), (11, [1.0, 0.9], 5),
            (12, [1e300, 0.0, 0.0], 1), (13, [-1.0, -2.0, -3.0], 1), (15, [0.0] * 3, 1), (16, [200000.0, 1.0, 1.0], 2), (100, [-5.0, 1.0, 1.0], 9), (17, x, 9)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows[:0]) == set()
    assert result(spark, [r for r in rows if r[0] == 3]) == set()
