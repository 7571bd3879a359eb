import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gapweave.llm import spelling


def brute_counts(rows):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 97 == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1 :]
            if len(low) >= 5:
                found[low] += 1
    return {w: n for w, n in found.items() if n >= 3}


def edits(word, alphabet):
    for i in range(len(word) + 1):
        for c in alphabet:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1 :]
        if i < len(word):
            yield word[:i] + word[i + 1 :]


def brute_variants(counts):
    alphabet = sorted(set("".join(counts)))
    near = {w: {v for v in edits(w, alphabet) if v in counts and v != w} for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def got(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_variants(brute_counts([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert len(want) > 1000 and any(v[0] for v in want.values()) and any(v[1] != v[0] for v in want.values() if v[0])
    assert got(spelling.spelling_variants(docs)) == want


@pytest.mark.parametrize("alphabet,shortest,longest", [("ab", 5, 8), ("abcdé", 5, 7), ("a", 5, 30)])
def test_dense_words_against_brute_force(spark, monkeypatch, alphabet, shortest, longest):
    monkeypatch.setattr(spelling, "HOT", 7)  # salts
    rng = np.random.default_rng(len(alphabet))
    words = {"".join(rng.choice(list(alphabet), rng.integers(shortest, longest + 1))) for _ in range(400)}
    counts = {w: int(rng.integers(3, 60)) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling.variants(df, spelling.neighbours(df))) == brute_variants(counts)


def test_long_words_meet_without_the_tries(spark):
    rng = np.random.default_rng(3)
    counts = {}
    for n in (46, 47, 48, 49, 50, 3000):
        base = "".join(rng.choice(list("abc"), n))
        at = int(rng.integers(0, n))
        for k, w in enumerate((base, base[:at] + base[at + 1 :], base[:at] + "z" + base[at + 1 :], base[:at] + "y" + base[at:], base + "q", "q" + base)):
            counts[w] = 3 + 5 * k
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling.variants(df, spelling.neighbours(df))) == brute_variants(counts)


def test_deletion_hashes_name_the_shorter_word():
    for word in ("a", "ab", "banana", "x" * 40 + "y"):
        hashes = spelling.deletion_hashes(word)
        assert hashes[0] == spelling.deletion_hashes(word)[0]
        assert hashes[1:] == [spelling.deletion_hashes(word[:i] + word[i + 1 :])[0] for i in range(len(word))]


def test_odd_rows(spark, texts, no_texts):
    want = brute_variants(brute_counts([(r["doc_id"], r["text"]) for r in texts.collect()]))
    assert got(spelling.spelling_variants(texts)) == want
    assert spelling.spelling_variants(no_texts).count() == 0
    rows = spark.createDataFrame([(None, "Straße STRASSE straßé ÀÀÀÀÀ àààààà " * 4, 1), (None, None, 2)], "doc_id long, text string, n int")
    assert got(spelling.spelling_variants(rows)) == brute_variants(brute_counts([(r["doc_id"], r["text"]) for r in rows.collect()]))
