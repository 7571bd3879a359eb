import random
from collections import Counter

from pyspark.sql import functions as F

from gapweave.llm import quality


def brute(text):
    text = text or ""
    w = text.encode().split()
    w = [x.decode() for x in w]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in quality.SYMBOLS), len(lines) - len(set(lines)), len(covered)


def random_texts():
    rng = random.Random(3)
    out = []
    for _ in range(150):
        n, k = rng.randrange(0, 120), rng.choice([1, 2, 5, 60])
        out.append("".join(rng.choice(["a", "b", "c", "d#", "é", "x|"][: max(1, k)]) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(n)))
    phrase = " ".join(f"p{i}" for i in range(9))
    out += [f"{phrase} q {phrase}", f"{phrase} {phrase} {phrase}", phrase, "a " * 8, "a " * 9, "\n\n", None, ""]
    return out


def test_measures_against_brute_force(spark):
    texts = random_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:6] for r in quality.quality_table(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_odd_rows(spark, texts, no_texts):
    rows = quality.quality_table(texts).collect()
    assert len(rows) == texts.count()
    assert {r["kept"] for r in rows if r["n_words"] == 0} == {False}
    assert quality.quality_table(no_texts).count() == 0
    kept = quality.keep_good(texts)
    assert kept.columns == texts.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 9}
    assert quality.keep_good(no_texts).count() == 0


def test_order_changes_no_verdict(spark):
    df = spark.createDataFrame(list(enumerate(random_texts())), "doc_id long, text string")

    def rejected(order):
        t = F.col("text")
        return {r[0] for r in df.filter(quality.first_rejection(t, quality.words(t), order).isNotNull()).select("doc_id").collect()}

    assert rejected(quality.RULES) == rejected(tuple(reversed(quality.RULES)))
    measured = quality.measure(df)
    assert [m.gain for m in measured] == sorted((m.gain for m in measured), reverse=True)


def test_plan_is_native(spark, folder):
    plan = quality.quality_table(spark.read.parquet(f"{folder}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
