import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from gapweave.llm import bpe, packing, tokencounts
from gapweave.llm.bpe import BytePairs
from gapweave.llm.queries import BYTE_RANKS, WORD_TOKENIZER
from gapweave.llm.wordtokens import WordTokens


@pytest.fixture(scope="module")
def twin():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pairs():
    return BytePairs.shared(BYTE_RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(WORD_TOKENIZER)
    t.encode_special_tokens = True
    return t


def odd_strings():
    rng = random.Random(5)
    alphabet = [chr(i) for i in range(0x250)] + list("　  ​’ß中文字한글🙂👍🏽́Σİ") + ["'s", "'LL", "  ", "\r\n", "a" * 7]
    out = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(400)]
    return out + ["", " ", "a" * 3000, "ab" * 2000, "".join(rng.choices("abcde", k=5000)), "<|endoftext|>", " the" * 50]


def test_encoder_equals_tiktoken(twin, pairs):
    for text in odd_strings():
        ids = pairs.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == twin.encode_ordinary(text)
        assert pairs.decode(ids) == text.encode()


def test_memo_turns_change_nothing(twin, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 3)
    small = BytePairs(BYTE_RANKS, P.PATTERN)
    for text in odd_strings()[:50]:
        assert np.frombuffer(small.encode(text), "<u4").tolist() == twin.encode_ordinary(text)


def test_round_trip_rows(spark, folder, texts, no_texts, twin):
    for df in (texts, spark.read.parquet(f"{folder}/documents.parquet")):
        want = sorted(
            (str(r["doc_id"]), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256((r["text"] or "").encode()).hexdigest())
            for r in df.collect() for ids in [twin.encode_ordinary(r["text"] or "")]
        )
        got = sorted((str(r[0]), *tuple(r)[1:]) for r in bpe.round_trip(df, BYTE_RANKS, P.PATTERN).collect())
        assert got == want
    assert bpe.round_trip(no_texts, BYTE_RANKS, P.PATTERN).count() == 0
    decoded = bpe.decode_ids(bpe.encode_texts(texts, BYTE_RANKS, P.PATTERN), BYTE_RANKS, P.PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in decoded) == sorted((r["text"] or "").encode() for r in texts.collect())


def test_words_equal_whole_texts(whole):
    words = WordTokens(WORD_TOKENIZER)
    strings = [*odd_strings(), None]
    for text, ids in zip(strings, words.encode(strings)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids


def check_packing(rows, ids_of, length=packing.LENGTH):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids_of)
    for key, found in pieces.items():
        found.sort(key=lambda r: r["start"])
        ids, at = ids_of[key], 0
        for r in found:
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    short = 0
    for found in sequences.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= length
        short += at < length
    return short


def test_packing_loses_no_token(spark, folder, whole):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids_of = {r["doc_id"]: [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    rows = packing.pack_texts(docs.repartition(3), WORD_TOKENIZER).collect()
    assert check_packing(rows, ids_of) <= 3
    for r in rows:
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids_of[r["doc_id"]][r["start"] : r["start"] + r["length"]]


def test_packing_odd_rows(spark, texts, no_texts):
    rows = packing.pack_texts(texts.coalesce(1), WORD_TOKENIZER).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 1
    assert sum(r["start"] == 0 for r in rows) == texts.count()
    assert packing.pack_texts(no_texts, WORD_TOKENIZER).count() == 0


def test_pools_fill_sequences_and_balance_cost():
    rng = random.Random(1)
    lengths = [rng.randrange(1, 900) for _ in range(400)]
    docs = [(k, np.arange(n, dtype="<u4").tobytes()) for k, n in enumerate(lengths)]
    out = list(packing.pack(iter(docs), 1000, pool_tokens=20000))
    assert [s.used for s in out[:-1]] == [1000] * (len(out) - 1)
    assert sum(s.used for s in out) == sum(lengths)
    cost = packing.Cost()
    pool = packing.pack_pool([packing.Piece(k, 0, n, n, b"\0" * 4 * n) for k, n in enumerate(lengths)], 1000)
    costs = [sum(cost(p.length) for p in s.pieces) for s in pool[:-1]]
    assert max(costs) < 1.25 * min(costs)
    assert packing.pack_pool([], 1000) == [] and list(packing.pack(iter([]), 1000)) == []


def slow_counts(fields, twin, rule):
    """Token by token, section by section."""
    parts = [(f or "") + ("\n" if k < len(fields) - 1 else "") for k, f in enumerate(fields)]
    spans, at = [], 0
    for k, part in enumerate(parts):
        lines = part.splitlines(keepends=True) if k == len(parts) - 1 and False else None
        if k == len(parts) - 1:
            pieces = part.split("\n")
            lines = [p + "\n" for p in pieces[:-1]] + ([pieces[-1]] if pieces[-1] or len(pieces) == 1 else [])
        for n, line in enumerate(lines if lines is not None else [part]):
            spans.append([k, n, at, at + len(line), 0])
            at += len(line)
    rendered = "".join(parts)
    raw, byte = rendered.encode(), 0
    char_of = [k for k, c in enumerate(rendered) for _ in c.encode()]
    for token in twin.encode_ordinary(rendered):
        size = len(twin.decode_single_token_bytes(token))
        chars = sorted(set(char_of[byte : byte + size]))
        byte += size
        shares = [sum(s[2] <= c < s[3] for c in chars) for s in spans]
        hit = [k for k, n in enumerate(shares) if n]
        spans[{"first": hit[0], "last": hit[-1], "most": max(hit, key=lambda k: shares[k])}[rule]][4] += 1
    assert byte == len(raw)
    return [tuple(s) for s in spans]


@pytest.mark.parametrize("rule", tokencounts.RULES)
def test_attribution_against_token_by_token(twin, pairs, rule):
    cases = [["src", "en", t] for t in odd_strings()[:150]] + [[None, "x \n", "\n\n\n a\n\n"], ["", "", ""], ["a", "b", None], ["only\n\n\n"]]
    for fields in cases:
        got = tokencounts.count_document(fields, pairs, rule)
        assert [tuple(r) for r in got.tolist()] == slow_counts(fields, twin, rule)


def test_attribution_rows(spark, folder, texts, no_texts, twin):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = tokencounts.token_counts(docs, BYTE_RANKS, P.PATTERN).groupBy("doc_id").sum("n_tokens").collect()
    want = {r["doc_id"]: len(twin.encode_ordinary(f"{r['source']}\n{r['lang']}\n{r['text']}")) for r in docs.collect()}
    assert {r[0]: r[1] for r in got} == want
    assert tokencounts.token_counts(texts, BYTE_RANKS, P.PATTERN).filter("doc_id = 5").count() == 2 * 3
    assert tokencounts.token_counts(no_texts, BYTE_RANKS, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        tokencounts.token_counts(texts, BYTE_RANKS, P.PATTERN, rule="none")
