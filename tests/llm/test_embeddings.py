import math

import numpy as np
import pytest

from gapweave.llm import embeddings
from gapweave.llm.embeddings import Settings


def brute(rows, threshold=0.95):
    usable = {k: v for k, v in rows if k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = sorted(usable)
    links, root = dict.fromkeys(ids, 0), {k: k for k in ids}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    units = {k: np.array(usable[k]) / np.linalg.norm(usable[k]) for k in ids}
    pairs = set()
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if len(usable[a]) == len(usable[b]) and units[a] @ units[b] >= threshold:
                pairs.add((a, b))
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (links[k], find(k)) for k in ids}, pairs


def clustered(count, seed, dim=32):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((count // 8, dim))
    rows = []
    for k in range(count):
        spread = rng.choice([0, 0.1, 0.25, 2.0])
        v = centres[rng.integers(len(centres))] * rng.uniform(0.5, 2) + spread * rng.standard_normal(dim)
        rows.append((k, [float(x) for x in v.astype(np.float32)]))
    return rows


def result(spark, rows, settings=Settings()):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df, settings=settings).collect()}


def test_one_cell_against_brute_force(spark):
    rows = clustered(400, 1)
    want, _ = brute(rows)
    assert result(spark, rows, Settings(recall=0.99999)) == want


@pytest.mark.parametrize("settings", [Settings(cell=8, block=40), Settings(cell=400, block=30), Settings(cell=64, block=100)])
def test_cells_and_blocks_find_links_once(spark, settings):
    rows = clustered(600, 2)
    want, pairs = brute(rows)
    got = result(spark, rows, settings)
    assert all(got[k][0] <= want[k][0] for k in want)  # no link twice, none below the threshold
    assert sum(n for n, _ in got.values()) >= 0.98 * 2 * len(pairs)


def test_whole_table_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want, pairs = brute(rows)
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(df, settings=Settings(cell=16, block=64)).collect()}
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * 2 * len(pairs)
    assert len(got) == len(rows)


def test_odd_rows(spark):
    x = [1.0, 2.0, 3.0]
    rows = [(1, x), (2, x), (2, x), (3, [2.0, 4.0, 6.0]), (4, None), (5, []), (6, [0.0] * 3), (7, [1.0, None, 3.0]), (8, [float("nan"), 1.0, 1.0]),
            (9, [float("inf"), 1.0, 1.0]), (None, x), (10, [1.0, 2.0]), (11, [1e-300, 2e-300, 3e-300]), (12, [1e300, 2e300, 3e300])]
    df = spark.createDataFrame([(*r, 0, 5) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    got = embeddings.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert by[1] == (5, 1, True) and by[2] == (5, 1, False) and by[3] == (5, 1, False) and by[11] == (5, 1, False) and by[12] == (5, 1, False)
    assert all(by[k] == (0, k, True) for k in (4, 5, 6, 7, 8, 9, 10))
    assert by[None] == (0, None, False)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
