import re

import pytest

from gapweave.llm import leaks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, length=10):
    """Every window looked for at every word."""
    windows = {}
    for item, text in items:
        w = WORD.findall(fold(text))
        for i in range(max(len(w) - length + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + length]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        matches = list(WORD.finditer(fold(text)))
        w = [m[0] for m in matches]
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                who = windows.get(tuple(w[i : i + n]))
                if who is not None:
                    hit.update(range(i, i + n))
                    found |= who
        characters = {c for k in hit for c in range(matches[k].start(), matches[k].end())}
        out.append((doc, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None)), frozenset(characters)))
    return sorted(out, key=str)


def got(df, texts):
    out = []
    for r in df.collect():
        text = texts[r["doc_id"]] or ""
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        assert spans == sorted(spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        # a span begins and ends with a hit word
        assert all(WORD.match(fold(text), a) and WORD.match(fold(text), b - 1) for a, b in spans)
        inside = {m.start() + k for a, b in spans for m in WORD.finditer(fold(text)) if a <= m.start() < b for k in range(len(m[0]))}
        out.append((r["doc_id"], r["n_words"], sum(s["words"] for s in r["spans"]), tuple(r["items"]), frozenset(inside)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_words", [leaks.BLOCK_WORDS, 900])
def test_whole_table_against_brute_force(spark, block_words):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute(rows, [(r["item_id"], r["text"]) for r in items.collect()])
    assert any(w[2] for w in want)
    assert got(leaks.find_leaks(docs, items, block_words=block_words), dict(rows)) == want


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short ITEM"), (3, None), (4, " .,"), (None, "no id"),
         (1, "another text of item one"), (5, "short item"), (6, "Ünï 文字 🙂"), (7, "b b b b b b b b b b b b")]
TEXTS = [(1, "x one, TWO three-four five six seven eight nine ten. eleven y"), (2, "short  item short\nitem"), (3, None), (4, ""),
         (5, "no id no"), (6, "🙂 ünï 文字 🙂 文字"), (7, "b " * 40), (8, "one two three four five six seven eight nine"),
         (9, "ten eleven short short item"), (10, "another text of item one another text of item two"), (11, "Ünï"),
         (12, "filler words " * 30000 + "short item")]


@pytest.mark.parametrize("block_words", [leaks.BLOCK_WORDS, 12])
def test_odd_rows(spark, block_words):
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id int, text string, doc_id string")
    docs = spark.createDataFrame([(*r, "x", 1) for r in TEXTS], "doc_id long, text string, items string, row int")
    found = leaks.find_leaks(docs, items, block_words=block_words)
    assert got(found, dict(TEXTS)) == brute(TEXTS, ITEMS)
    assert leaks.find_leaks(docs.limit(0), items, block_words=block_words).count() == 0
    none = leaks.find_leaks(docs, items.limit(0), block_words=block_words).collect()
    assert len(none) == len(TEXTS) and not any(r["spans"] or r["items"] for r in none)


def test_rows_that_repeat_are_scanned_each(spark):
    docs = spark.createDataFrame([(1, "short item"), (1, "short item"), (None, "short item")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    for block_words in (leaks.BLOCK_WORDS, 12):
        assert [r["items"] for r in leaks.find_leaks(docs, items, block_words=block_words).collect()] == [["2", "5"]] * 3
