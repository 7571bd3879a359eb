import random

import xxhash

from gapweave.llm import simhash
from gapweave.llm.components import components


def brute_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    rows = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, tau):
    """Smallest key of each print's component."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= tau:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_whole_query_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    prints = {r["doc_id"]: brute_print(r["text"]) for r in docs.collect()}
    got = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["fp"] % (1 << 64) for r in got} == prints
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(prints, 2)


def crafted(count, seed):
    rng = random.Random(seed)
    out = set()
    while len(out) < count:
        base = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            out.add(base)
            for _ in range(rng.randrange(0, 4)):
                base ^= 1 << rng.randrange(64)
    return sorted(out)


def check_links(spark, prints, most, tau=2, segments=7):
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = simhash.fingerprint_components(df, tau, segments, most).collect()
    root = {r["fp"] % (1 << 64): r["root"] for r in got}
    want = brute_components(dict(enumerate(prints)), tau)
    groups = {}
    for k, c in want.items():
        groups.setdefault(c, set()).add(root[prints[k]])
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_pigeonring_misses_no_link(spark):
    check_links(spark, crafted(300, 1), most=64)


def test_crowded_buckets_are_exact(spark):
    check_links(spark, crafted(300, 2), most=1)


def test_other_distances_and_rings(spark):
    check_links(spark, crafted(200, 3), most=64, tau=3, segments=5)
    check_links(spark, crafted(200, 4), most=64, tau=1, segments=4)


def test_odd_rows(spark, texts, no_texts):
    got = simhash.near_duplicates(texts).collect()
    assert len(got) == texts.count()
    assert {r["component_id"] for r in got if r["fp"] == 0} == {2}
    assert {r["component_id"] for r in got if r["doc_id"] == 9} == {1}
    assert simhash.near_duplicates(no_texts).count() == 0
    kept = simhash.keep_one(texts)
    assert kept.columns == texts.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(["1", "2", "5", "None", "6", "7", "8"])
    assert simhash.keep_one(no_texts).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (300, 300)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 200: 200, 201: 200}
    assert components(edges.limit(0)).count() == 0
