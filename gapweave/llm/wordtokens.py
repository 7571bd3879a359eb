"""Ids of a tokenizer that never joins across white space, word by word.

White space ends a pre-token and normalisation works character by character,
so a text's ids are its words' ids in order.  Words come back again and again:
a bounded memo holds their ids as bytes, and only words outside it go through
the tokenizer, many at a time with a mark between them that none of them
holds.  Strings of special tokens count as ordinary text.
"""

from __future__ import annotations

import os
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_WORDS = 160_000
TOGETHER = 64
#: Marks that normalisation neither makes nor changes.
MARKS = "|~^¦§¬"
_BEHIND = ".,;:!?%*#$&"


def cores_and_rests(words: list[str]) -> tuple[list[str], list[str]]:
    """Words in lower case without the punctuation behind them, and that punctuation.

    A letter and such a mark never share a pre-token, and both cases of a
    letter have one id, so the parts' ids side by side are the word's.  Words
    whose lower case is not plain stay as they are.
    """
    cores = [c if (c := w.rstrip(_BEHIND)) and c[-1].isalpha() else w for w in words]
    rests = [w[len(c) :] for w, c in zip(words, cores)]
    return [c.lower() if c.isascii() or _plain(c) else c for c in cores], rests


def _plain(core: str) -> bool:
    return is_normalized("NFC", core) and "\u03a3" not in core and "\u0130" not in core


class WordTokens:
    """``encode`` gives ids as little-endian unsigned 32-bit bytes, as the whole text would."""

    _loaded: dict[tuple[str, int], WordTokens] = {}

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.memo_words = memo_words
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    @classmethod
    def shared(cls, path: str, memo_words: int = MEMO_WORDS) -> WordTokens:
        """One instance for each Python worker."""
        if (path, memo_words) not in cls._loaded:
            cls._loaded[path, memo_words] = cls(path, memo_words)
        return cls._loaded[path, memo_words]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words outside the memo: of their cores, and of what follows them."""
        cores, rests = cores_and_rests(words)
        parts = {*cores, *rests}
        learned = self._encode_words(list(parts.difference(self.parts)))  # difference() walks the set, not the memo
        if len(self.parts) + len(learned) > self.memo_words:
            self.parts = {x: self.parts[x] for x in parts if x in self.parts}
        self.parts.update(learned)
        ids = self.parts
        return {w: ids[core] + ids[rest] for w, core, rest in zip(words, cores, rests)}

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        for at in range(0, len(words), 64 * TOGETHER):
            some = words[at : at + 64 * TOGETHER]
            blob = " ".join(some)
            mark = next((m for m in MARKS if m not in blob and len(self._ids([m])[0]) == 1), None)
            if mark is None:
                out.update((w, np.array(ids, "<u4").tobytes()) for w, ids in zip(some, self._ids(some)))
                continue
            # a mark after every word; long strings cost more per word than short ones
            runs = [f" {mark} ".join([*some[k : k + TOGETHER], ""]) for k in range(0, len(some), TOGETHER)]
            ids = np.array(list(chain.from_iterable(self._ids(runs))), "<u4")
            data, start = ids.tobytes(), 0
            for word, end in zip(some, (4 * np.flatnonzero(ids == self._ids([mark])[0][0])).tolist(), strict=True):
                out[word] = data[start:end]
                start = end + 4
        return out

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        # Arrow splits, numbers and joins the words of all texts; Python sees each distinct word once
        found = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = found.values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist() takes eight times as long
        known = list(map(self.memo.get, words))
        unknown = [w for w, ids in zip(words, known) if ids is None]
        older = self.older
        if len(self.memo) + len(unknown) > self.memo_words:
            # words of this call stay; the others are kept for one more turn
            self.older, self.memo = self.memo, {w: ids for w, ids in zip(words, known) if ids is not None}
        new = {w: older[w] for w in unknown if w in older}
        new |= self._learn([w for w in unknown if w not in new])
        self.memo |= new
        ids = pa.array([new[w] if ids is None else ids for w, ids in zip(words, known)], pa.large_binary()).take(coded.indices)
        _, ends, body = ids.buffers()
        cuts = np.frombuffer(ends, np.int64, len(ids) + 1)[found.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        data = memoryview(body or b"")
        return [bytes(data[start:end]) for start, end in zip(cuts, cuts[1:])]
