"""The memo of words is looked up, not walked: walking it cost as much as many new words, for every few texts."""

import random

from gapweave.llm.queries import WORD_TOKENIZER
from gapweave.llm.wordtokens import WordTokens, cores_and_rests


class Unwalked(dict):
    def __iter__(self):
        raise AssertionError("the whole memo was walked")


def test_older_words_are_looked_up():
    words = WordTokens(WORD_TOKENIZER)
    want = words.encode(["Alt und neu, neu."])
    words.older = Unwalked(words.memo)
    words.memo = {}
    words.parts = {}
    assert words.encode(["Alt und neu, neu."]) == want


def test_words_are_parted_as_one_by_one():
    words = ["Haus", "Haus.", "...", "a1!", "STRASSE,;", "Σας", "İx", "éa", "É%%%", "x-", "&"]
    cores, rests = cores_and_rests(words)
    assert cores == ["haus", "haus", "...", "a1!", "strasse", "Σας", "İx", "éa", "é", "x-", "&"]
    assert rests == ["", ".", "", "", ",;", "", "", "", "%%%", "", ""]


def test_a_small_memo_gives_the_ids_of_a_large_one():
    draw = random.Random(5)
    texts = [" ".join(draw.choice("Ab cÉ.,%ß1") * draw.randint(1, 4) for _ in range(40)) for _ in range(60)]
    large, small = WordTokens(WORD_TOKENIZER), WordTokens(WORD_TOKENIZER, memo_words=20)
    assert [small.encode([t])[0] for t in texts] == large.encode(texts)
    plain = large.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert [[int.from_bytes(b[i : i + 4], "little") for i in range(0, len(b), 4)] for b in large.encode(texts)] == [p.ids for p in plain]
