"""Byte-level BPE with a hierarchical-bitmap rank queue.

The bytes of a pre-token form a linked list.  Every neighbouring pair whose
bytes are a token waits in the bucket of that token's rank; a bitmap of two
levels of 256-bit words marks ranks with waiting pairs, so the lowest comes by
find-first-set.  A merge changes the two pairs beside it; their old entries
stay behind and are skipped when met.  A step costs a few word operations
however long the pre-token is.

Pre-tokens come back again and again, so a bounded memo holds their ids.
Null and empty texts have no ids.  Every text is encoded whole, row by row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import reachable, slices

MEMO_PIECES = 700_000
#: Longer pre-tokens hardly come back; they are not kept.
MEMO_LETTERS = 64


_BITS = [1 << k for k in range(256)]


class BytePairs:
    """Encoder and decoder for a rank file (one base64 token and its rank a line)."""

    _loaded: dict[tuple[str, str], BytePairs] = {}

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.pattern = regex.compile(pattern)
        self.leaf = [0] * (len(self.tokens) // 256 + 1)  # 256 ranks a word
        self.buckets: dict[int, list[int]] = {}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def shared(cls, path: str, pattern: str) -> BytePairs:
        """One instance for each Python worker."""
        if (path, pattern) not in cls._loaded:
            cls._loaded[path, pattern] = cls(path, pattern)
        return cls._loaded[path, pattern]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token; of equal ranks the leftmost pair merges first."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        rank_of, bits = ranks.get, _BITS
        # empty between pre-tokens: every entry is popped
        leaf, buckets, top = self.leaf, self.buckets, 0
        n = len(piece)
        after = list(range(1, n + 1))  # start of the next symbol
        before = list(range(-1, n))  # start of the symbol before
        waiting = [-1] * n  # rank of the pair that starts here; an entry of another rank is stale
        for i in range(n - 1):
            rank = rank_of(piece[i : i + 2])
            if rank is not None:
                waiting[i] = rank
                bucket = buckets.get(rank)
                if bucket is None:
                    buckets[rank] = [i]
                    top |= bits[rank >> 8]
                    leaf[rank >> 8] |= bits[rank & 255]
                else:
                    bucket.append(i)  # ascending, so it stays a heap
        while top:
            high = (top & -top).bit_length() - 1
            word = leaf[high]
            rank = high << 8 | (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                word &= word - 1
                leaf[high] = word
                if not word:
                    top &= top - 1
            if waiting[i] != rank:
                continue
            j = after[i]
            after[i] = end = after[j]
            waiting[j] = waiting[i] = -1
            if end < n:
                before[end] = i
                new = rank_of(piece[i : after[end]])
                if new is not None:
                    waiting[i] = new
                    bucket = buckets.get(new)
                    if bucket is None:
                        buckets[new] = [i]
                        top |= bits[new >> 8]
                        leaf[new >> 8] |= bits[new & 255]
                    else:
                        heappush(bucket, i)
            left = before[i]
            if left >= 0:
                new = rank_of(piece[left:end])
                if new is None:
                    waiting[left] = -1
                else:
                    waiting[left] = new
                    bucket = buckets.get(new)
                    if bucket is None:
                        buckets[new] = [left]
                        top |= bits[new >> 8]
                        leaf[new >> 8] |= bits[new & 255]
                    else:
                        heappush(bucket, left)
        out, i = [], 0
        while i < n:
            j = after[i]
            out.append(ranks[piece[i:j]])
            i = j
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        memo, older, out = self.memo, self.older, []
        for piece in self.pattern.findall(text):
            ids = memo.get(piece)
            if ids is None:
                ids = older.get(piece)
                if ids is None:
                    found = self.merge(piece.encode("utf-8", "surrogatepass"))
                    ids = pack(f"<{len(found)}I", *found)
                if len(piece) <= MEMO_LETTERS:
                    if len(memo) >= MEMO_PIECES:  # what came back since the last turn stays
                        self.memo, self.older = memo, older = {}, memo
                    memo[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_texts(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``into``: the ids of every text, little-endian unsigned 32-bit."""
    return _mapped(df, text, keep, f"{into} binary",
                   lambda texts: [[BytePairs.shared(path, pattern).encode(t) for t in texts]])


def decode_ids(df: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "decoded",
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``into``: the bytes that the ids stand for."""
    return _mapped(df, ids, keep, f"{into} binary",
                   lambda found: [[BytePairs.shared(path, pattern).decode(x or b"") for x in found]])


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_tokens`` and the digests of the ids and of the bytes decoded from them, for every text."""

    def digests(texts: list[str | None]) -> list[list]:
        pairs = BytePairs.shared(path, pattern)
        rows = []
        for t in texts:
            ids = pairs.encode(t)
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(pairs.decode(ids)).hexdigest()))
        return [list(c) for c in zip(*rows)]

    return _mapped(df, text, (key,), "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def _mapped(df: DataFrame, column: str, keep: tuple[str, ...], added: str, work) -> DataFrame:
    slim = df.select(*keep, F.col(column).alias("_value"))
    spark_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    names = [x.split()[0] for x in added.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in added.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_value"):
                columns = work(part.column("_value").to_pylist())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *arrays], [*keep, *names])

    return reachable(slim).mapInArrow(run, f"{spark_types}, {added}")
