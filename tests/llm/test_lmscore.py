import math
import zlib
from collections import Counter

from gapweave.llm import lmscore


def brute(rows):
    """Scores of (key, text) rows from plain counts."""
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for _, t in rows]
    held = [k is None or zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows]
    words, pairs, texts = Counter(), Counter(), 0
    for w, h in zip(tokens, held):
        if not h:
            words.update(w)
            pairs.update(zip([None, *w], w))
            texts += 1
    n, v = sum(words.values()), len(words)
    out = []
    for (k, _), w, h in zip(rows, tokens, held):
        base = score = 0.0
        for before, x in zip([None, *w], w):
            p = (words[x] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            c = texts if before is None else words[before]
            spare = lmscore.STRENGTH * c**lmscore.POWER
            score += math.log10((pairs[before, x] + spare * p) / (c + spare)) if c else math.log10(p)
        out.append((str(k), h, len(w), sum(words[x] > 0 for x in w), n, base, score))
    return sorted(out)


def scored(df, **settings):
    return sorted(
        (str(r[0]), *tuple(r)[1:]) for r in lmscore.score_corpus(df, **settings).collect()
    )


def test_against_plain_counts(spark, folder, texts):
    for df, size in ((spark.read.parquet(f"{folder}/documents.parquet"), 50_000), (texts, 1 << 20), (texts, 100)):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        got, want = scored(df, block_bytes=size), brute(rows)
        assert [r[:5] for r in got] == [r[:5] for r in want]
        for a, b in zip(got, want):
            assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


def test_better_than_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    base, score = lmscore.score_corpus(docs).filter("held_out").selectExpr("sum(base_score)", "sum(score)").first()
    assert score > base


def test_probabilities_add_up_to_one():
    words, pairs, texts = Counter(a=3, b=1, end=2), Counter({("a", "a"): 1, ("a", "b"): 1, ("a", "end"): 1}), 2
    n, v = sum(words.values()), len(words)
    chance = {w: (words[w] + 0.1) / (n + 0.1 * (v + 1)) for w in [*words, "unknown"]}
    assert math.isclose(sum(chance.values()), 1)
    spare = lmscore.STRENGTH * words["a"] ** lmscore.POWER
    assert math.isclose(sum((pairs["a", w] + spare * p) / (words["a"] + spare) for w, p in chance.items()), 1)


def test_empty_table(spark, no_texts):
    assert lmscore.score_corpus(no_texts).count() == 0


def test_planes_round_trip():
    import numpy as np

    for values in (np.zeros(0, "<u8"), np.array([1, 2**63, 7], "<u8"), np.array([5, 0], "<u4")):
        assert lmscore.unplanes(lmscore.planes(values), values.dtype.str).tolist() == values.tolist()


def test_requests_grow_with_the_texts_not_with_the_square_of_the_blocks():
    texts = [" ".join(f"w{k}-{i}" for i in range(20)) for k in range(40)]
    rows = {}
    for shards in (20, 2_000, 200_000):
        rows[shards] = sum(len(list(lmscore.Block([t], [True], shards).requests())) for t in texts)
    assert rows[2_000] <= rows[200_000] <= 40 * (21 + 21)  # distinct words and bigrams


def test_walk_follows_arcs_and_failure_arcs():
    block = lmscore.Block(["a b", "b zz a", None], [True, False, True], 1)
    total = lmscore.Totals(tokens=4, types=3, texts=2)
    model = lmscore.Automaton.build(block, block.word_counts.astype("<u8"), block.arc_counts.astype("<u8"), total)
    def chance(c):
        return (c + 0.1) / (4 + 0.1 * 4)

    def back(c):
        return lmscore.STRENGTH * c**lmscore.POWER / (c + lmscore.STRENGTH * c**lmscore.POWER)

    # start fails to b, b fails to the unknown zz at the root, the root reads a, a fails to the end
    want = math.log10(back(2) * chance(1) * back(1) * chance(0) * chance(1) * back(1) * chance(2))
    assert math.isclose(model.walk(block)[1], want)
    assert model.walk(lmscore.Block([], [], 1)) == []
