import random
import zlib

from gapweave.llm import toxicity


def test_held_out_accuracy(spark):
    """Labels of junk texts are partly noise; the clean texts of the table must stay, most toxic ones must go."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_table(docs, labels)
    rows = got.join(labels.filter("quality = 1"), "doc_id").filter("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) > 0.85 * len(toxic)
    assert sum(clean) < 0.015 * len(clean)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def test_model_learns_a_word_and_repeats_itself():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijk", k=5)) for _ in range(400)]
    good = [" ".join(rng.choices(words, k=30)) for _ in range(200)]
    bad = [" ".join(rng.choices(words, k=15) + ["zorkish"] + rng.choices(words, k=15)) for _ in range(60)]
    model = toxicity.fit(good + bad, [0] * 200 + [1] * 60)
    assert model.score("such a zorkish thing") > 0.7 > 0.3 > model.score("a fine day")
    again = toxicity.fit(good + bad, [0] * 200 + [1] * 60)
    assert again.score("such a zorkish thing") == model.score("such a zorkish thing")
    long = "a fine day " * 300000 + " zorkish"
    assert model.score(long) > model.score("a fine day " * 300000)


def test_without_labels_or_with_one_kind(spark, texts, no_texts):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        rows = toxicity.toxicity_table(texts, labels).collect()
        assert len(rows) == texts.count() and all(0 <= r["score"] <= 1 for r in rows)
        kept = toxicity.keep_clean(texts, labels)
        assert kept.columns == texts.columns and kept.count() == texts.count()
    assert toxicity.toxicity_table(no_texts, one).count() == 0


def test_features_of_pieces_equal_the_whole(monkeypatch):
    text = "The quick brown fox jumps over the lazy dog. Ünï 文字 " * 20
    whole = toxicity.features(text).tolist()
    monkeypatch.setattr(toxicity, "_STEP", 37)
    assert toxicity.features(text).tolist() == whole
    assert toxicity.features(text.upper().replace("ÜNÏ", "Ünï")).tolist() == whole


def test_only_copies_of_one_text_and_label_are_left_out():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(5000)]
    passage = rng.choices(words, k=30)
    apart = [" ".join(rng.choices(words, k=60) + passage) for _ in range(20)]  # a third is common to all
    assert toxicity._without_copies(apart, [0] * 20) == list(range(20))
    assert toxicity._without_copies([*apart, apart[3], apart[5] + " more"], [0] * 22) == list(range(20))
    assert toxicity._without_copies([*apart, apart[3]], [0] * 20 + [1]) == list(range(21))
    assert toxicity._without_copies([None, "", "a", "a"], [0, 0, 0, 1]) == [0, 2, 3]
