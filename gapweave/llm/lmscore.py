"""Texts scored by a weighted backoff automaton of bigrams.

Tokens are the words of a text and one end.  Training counts ``c`` give the
smoothed probabilities

    P(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    P(w | h) = (c(h w) + k(h) P(w)) / (c(h) + k(h)),   k(h) = STRENGTH * c(h) ** POWER

``h`` is the word before, or the start; both distributions add up to one.  In
the automaton every word seen in training (and the start) is a state.  A
bigram seen in training is an arc with log P(w | h); for any other word the
failure arc leads to the root at log k(h) / (c(h) + k(h)), and the root reads
the word at log P(w).  Words that training has not seen lead to the root.

The model grows with the corpus and is never held whole.  Texts are dealt into
blocks.  A block asks for the counts of its own distinct words and bigrams:
words sorted, bigrams as sorted 64-bit hashes, one request for each shard of
the hash range that holds any of them, so there are never more requests than
n-grams of the texts.  A shard adds the training counts of all blocks and
answers each with counts in the order asked.  The block then builds the
automaton of its own n-grams and walks each text from left to right, carrying
a state.  Words are counted as themselves, so the base score is exact; two
bigrams with one hash would share a count.

Null and empty texts are one end.  Rows with a null key are held out.  Rows
that repeat are read each.  Blocks and shards grow in number with the bytes of
the texts; a very frequent word is one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import byte_words, reachable, words

ADD = 0.1
STRENGTH, POWER = 4.0, 0.8
BLOCK_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = b"\n"  # no word holds a line feed
_START = np.uint64(0x243F6A8885A308D3)
_MIX, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(31)


def planes(values: np.ndarray) -> bytes:
    """Integers with equal bytes side by side, so that the shuffle's compression finds the zeros."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _steps(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)))


def _unsteps(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, "<u8"), dtype=np.uint64)


class Block:
    """The n-grams of some texts: distinct words by hash and text, distinct bigrams by hash."""

    def __init__(self, texts: list[str | None], train: list[bool], shards: int):
        number: dict[bytes, int] = {}
        ids: list[int] = []
        self.lengths = np.empty(len(texts), np.int64)
        for k, text in enumerate(texts):
            found = byte_words(text)
            found.append(END)
            self.lengths[k] = len(found)
            ids += [number.setdefault(w, len(number)) for w in found]
        words = list(number)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
        # words by hash, equal hashes by text: the order of requests and answers
        order = np.array(sorted(range(len(words)), key=lambda k: (hashes[k], words[k])), np.int64) if len(
            np.unique(hashes)) < len(words) else np.argsort(hashes, kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        self.words = [words[k] for k in order]
        self.hashes = hashes[order]
        self.tokens = place[np.array(ids, np.int64)] if ids else np.zeros(0, np.int64)
        del ids, number, words
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.trained = np.repeat(np.array(train, bool), self.lengths)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = len(self.words)  # the start
        pairs, arc = np.unique(before * (len(self.words) + 1) + self.tokens, return_inverse=True)
        context = np.append(self.hashes, _START)
        head, tail = pairs // (len(self.words) + 1), pairs % (len(self.words) + 1)
        key = (context[head] * _MIX ^ (context[head] >> _TURN)) + context[tail]
        key = (key ^ (key >> _TURN)) * _MIX
        keys, slot = np.unique(key ^ (key >> _TURN), return_inverse=True)
        self.keys, self.pairs, self.slot, self.arc = keys, pairs, slot, arc
        self.word_counts = np.bincount(self.tokens[self.trained], minlength=len(self.words)).astype("<u4")
        self.arc_counts = np.bincount(slot[arc[self.trained]], minlength=len(keys)).astype("<u4")
        width = max(1, -(-(1 << 64) // shards))
        edges = np.array([min(k * width, (1 << 64) - 1) for k in range(1, shards)], np.uint64)
        self.word_cuts = [0, *np.searchsorted(self.hashes, edges).tolist(), len(self.words)]
        self.arc_cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]

    def requests(self) -> Iterator[tuple]:
        """(shard, words, their counts, bigram hashes, their counts), one for every shard asked for anything."""
        for s, (a, b, c, d) in enumerate(zip(self.word_cuts, self.word_cuts[1:], self.arc_cuts, self.arc_cuts[1:])):
            if a < b or c < d:
                yield (s, b" ".join(self.words[a:b]), planes(self.word_counts[a:b]), _steps(self.keys[c:d]), planes(self.arc_counts[c:d]))


REQUEST = "shard int, block long, words binary, word_counts binary, keys binary, key_counts binary"
ANSWER = "block long, shard int, word_counts binary, key_counts binary"


def _requests(shards: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        block = Block(group.column("t").to_pylist(), group.column("train").to_pylist(), shards)
        rows = [(s, key[0].as_py(), *rest) for s, *rest in block.requests()]
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        names = ["shard", "block", "words", "word_counts", "keys", "key_counts"]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def answer(group: pa.Table) -> pa.Table:
    """Add up what the blocks counted, and answer each in its own order."""
    shard = group.column("shard")[0].as_py()
    totals: dict[bytes, int] = {}
    asked = []
    for words, counts in zip(group.column("words").to_pylist(), group.column("word_counts").to_pylist()):
        found = words.split(b" ") if words else []
        asked.append(found)
        for w, n in zip(found, unplanes(counts, "<u4").tolist()):
            totals[w] = totals.get(w, 0) + n
    keys = [_unsteps(k) for k in group.column("keys").to_pylist()]
    distinct, slot = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([unplanes(c, "<u4") for c in group.column("key_counts").to_pylist()])
    sums = np.bincount(slot, weights=counts, minlength=len(distinct)).astype("<u8")
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    rows = []
    for block, found, at in zip(group.column("block").to_pylist(), asked, np.split(slot, cuts)):
        mine = np.array([totals[w] for w in found], "<u8")
        rows.append((block, shard, planes(mine), planes(sums[at])))
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    names = ["block", "shard", "word_counts", "key_counts"]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


@dataclass(frozen=True)
class Totals:
    """What training holds: tokens with the ends, distinct tokens, texts."""

    tokens: int
    types: int
    texts: int


@dataclass(frozen=True)
class Automaton:
    """States are the block's words, then the start, then the root; log10 weights.

    Arcs are numbered as the block numbers its bigrams, so a place of a text
    knows the arc from the word before; it leads to the state of its word.
    """

    arcs: np.ndarray  # weight of each bigram's arc, NaN where there is none
    failure: np.ndarray  # weight of each state's failure arc to the root
    root: np.ndarray  # weight of each word at the root
    seen: np.ndarray  # words that are states; the root reads others back to itself

    @classmethod
    def build(cls, block: Block, word_counts: np.ndarray, arc_counts: np.ndarray, total: Totals) -> Automaton:
        chance = (word_counts + ADD) / (total.tokens + ADD * (total.types + 1))
        seen = np.append(word_counts, total.texts).astype(np.float64)
        spare = STRENGTH * seen**POWER
        share = np.where(seen > 0, spare / np.maximum(seen + spare, 1e-300), 1.0)
        counts = arc_counts[block.slot]
        kept = np.flatnonzero(counts > 0)
        s, w = block.pairs[kept] // (len(block.words) + 1), block.pairs[kept] % (len(block.words) + 1)
        weight = np.log10((counts[kept] + spare[s] * chance[w]) / (seen[s] + spare[s]))
        arcs = np.full(len(block.pairs), np.nan)
        arcs[kept] = weight
        return cls(arcs, np.append(np.log10(share), 0.0), np.log10(chance), word_counts > 0)

    def walk(self, block: Block) -> list[float]:
        """Log probability of each text: from the start, an arc for each token, over the failure arc where there is none."""
        start = len(self.root)
        after = np.where(self.seen, np.arange(start), start + 1)  # the state that a word leads to
        failure = self.failure
        scores = []
        for a, b in zip(block.starts.tolist(), (block.starts + block.lengths).tolist()):
            tokens = block.tokens[a:b]
            state, score = failure[start], 0.0  # a state is known by its failure arc
            arcs, alone, reached = self.arcs[block.arc[a:b]], self.root[tokens], failure[after[tokens]]
            for arc, word, following in zip(arcs.tolist(), alone.tolist(), reached.tolist()):
                if arc == arc:
                    score += arc
                else:
                    score += state + word
                state = following
            scores.append(score)
        return scores


def _score(shards: int, total: Totals):
    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        train = texts.column("train").to_pylist()
        block = Block(texts.column("t").to_pylist(), train, shards)
        answers = answers.sort_by("shard")
        word_counts = np.concatenate([unplanes(x, "<u8") for x in answers.column("word_counts").to_pylist()])
        arc_counts = np.concatenate([unplanes(x, "<u8") for x in answers.column("key_counts").to_pylist()])
        model = Automaton.build(block, word_counts, arc_counts, total)
        scores = model.walk(block)
        base = np.add.reduceat(model.root[block.tokens], block.starts)
        known = np.add.reduceat(model.seen[block.tokens].astype(np.int64), block.starts)
        return pa.table({
            "key": texts.column("key"), "held_out": pa.array([not x for x in train]), "n_tokens": block.lengths, "n_known": known,
            "train_tokens": np.full(len(scores), total.tokens), "base_score": base, "score": pa.array(scores, pa.float64()),
        })

    return run


def training_totals(slim: DataFrame) -> Totals:
    """Counted over all training texts, by word, so that no block has to hear from every shard."""
    plain = F.length("t") == F.octet_length("t")  # then the fast way lowers A-Z alone, too
    spoken = F.explode(words(F.when(plain, F.lower("t")).otherwise(F.translate("t", UPPER, LOWER))))
    counts = slim.filter("train").select(spoken.alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    texts = slim.filter("train").count()  # each is one end more
    return Totals(tokens + texts, types + (texts > 0), texts)


def score_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, held_out: int = 0,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    Training texts are those whose crc32 of the key as text, modulo ``folds``,
    is not ``held_out``.
    """
    train = F.coalesce(F.crc32(F.col(key).cast("string")) % folds != held_out, F.lit(False))
    slim = df.select(F.col(key).alias("key"), F.col(text).alias("t"), train.alias("train"))
    size = slim.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    total = training_totals(slim)
    blocks = max(1, -(-size // block_bytes))
    shards = max(1, -(-blocks // 2))
    # the key is a hash, so no source or copy gathers in one block; repeated rows spread by their text at least
    dealt = reachable(slim).withColumn("block", F.pmod(F.xxhash64("key", "t"), F.lit(blocks)))
    asked = dealt.groupBy("block").applyInArrow(_requests(shards), REQUEST)
    answers = asked.groupBy("shard").applyInArrow(answer, ANSWER)
    kind = slim.schema["key"].dataType.simpleString()
    schema = f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(shards, total), schema)
    return scored.withColumnRenamed("key", key)
