import numpy as np
from test_quality import brute as measures
from test_simhash import brute_components, brute_print

import corpus_pipeline
from gapweave.llm import quality, toxicity


def accepted(text):
    words, chars, symbols, doubled, repeated = measures(text)
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    w = (text or "").encode().split()
    stutters = sum(a == b for a, b in zip(w, w[1:]))
    return not (words < 20 or 100 * repeated > 30 * words or 100 * symbols > 10 * words or 100 * doubled > 50 * len(lines)
                or 100 * stutters > 30 * words or chars < 2 * words or chars > 40 * words)


def test_stages_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "simhash_near_dedup", "packing"]
    columns = docs.columns
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, folder)
        assert out.columns == columns
        got = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "quality_rules":
            want = {k for k, t in kept.items() if accepted(t)}
        elif name == "toxicity":
            model = toxicity.fit(*toxicity.training_rows(docs, spark.read.parquet(f"{folder}/labels.parquet")))
            want = {k for k, t in kept.items() if model.score(t) < toxicity.THRESHOLD}
        else:
            want = set(brute_components({k: brute_print(t) for k, t in kept.items()}, 2).values())
        assert set(got) == want and all(got[k] == kept[k] for k in got)
        kept = got
        docs = spark.createDataFrame(out.collect(), out.schema)
    packed = corpus_pipeline.STAGES[3][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in packed} == set(kept)
    assert sum(r["length"] for r in packed) == sum(r["doc_tokens"] for r in packed if r["start"] == 0)
    assert all(len(np.frombuffer(r["ids"], "<u4")) == r["length"] for r in packed)


def test_odd_rows_pass_through(spark, texts, no_texts, folder):
    for docs in (texts, no_texts):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, folder).count()
    assert quality.keep_good(texts).columns == texts.columns


def test_run_gives_pieces(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
