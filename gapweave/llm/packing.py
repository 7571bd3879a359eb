"""Cost-balanced packing of tokenised documents into sequences.

A piece of ``n`` tokens costs ``linear * n + quadratic * n * n`` (the rest of a
layer, and attention that stays inside the piece).  Documents are packed pool
by pool as a task streams its rows: pieces that fill a sequence leave at once,
and the rests of a pool go, longest first, to the sequence of lowest cost that
has room.  A pool opens just as many sequences as its tokens fill; what finds
no room whole is cut over the cheapest sequences with room.  Only the last
sequence of a pool can be short, and its pieces move into the next pool, so a
task pads at most one sequence.

The pool bounds memory (``POOL_TOKENS``), not the input: every document goes
through some pool.  Null and empty texts are documents of one token (the end
id).  Rows that repeat are packed each.  A null id stays null.  Only id and
text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gapweave.llm.shared import reachable, slices
from gapweave.llm.wordtokens import MEMO_WORDS, WordTokens

LENGTH = 2048
POOL_TOKENS = 1 << 21
END = 1


@dataclass(frozen=True)
class Cost:
    linear: float = 1.0
    quadratic: float = 1.0 / 4096

    def __call__(self, n: float) -> float:
        return self.linear * n + self.quadratic * n * n


@dataclass(slots=True)
class Piece:
    key: int | None
    start: int
    length: int
    total: int
    ids: bytes  # little-endian unsigned 32-bit

    def split(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.key, self.start, n, self.total, self.ids[: 4 * n]),
                Piece(self.key, self.start + n, self.length - n, self.total, self.ids[4 * n :]))


@dataclass(slots=True)
class Sequence:
    pieces: list[Piece] = field(default_factory=list)
    used: int = 0


def pack_pool(pieces: list[Piece], length: int = LENGTH, cost: Cost = Cost()) -> list[Sequence]:
    """Sequences of ``length`` tokens, all full but perhaps one; costs as even as the order allows."""
    total = sum(p.length for p in pieces)
    count = -(-total // length)
    out = [Sequence() for _ in range(count)]
    costs, room = np.zeros(count), np.full(count, length, np.int64)
    if count:
        room[-1] = total - (count - 1) * length  # so that the others end full

    def put(piece: Piece, k: int) -> None:
        out[k].pieces.append(piece)
        out[k].used += piece.length
        room[k] -= piece.length
        costs[k] += cost(piece.length)

    # the sort is stable: ties keep the order of the rows
    for piece in sorted(pieces, key=lambda p: -p.length):
        k = int(np.argmin(np.where(room >= piece.length, costs, np.inf)))
        if room[k] >= piece.length:
            put(piece, k)
            continue
        while piece is not None:
            k = int(np.argmin(np.where(room > 0, costs, np.inf)))
            head, tail = piece.split(int(room[k])) if room[k] < piece.length else (piece, None)
            put(head, k)
            piece = tail
    return out


def pack(documents: Iterable[tuple[int | None, bytes]], length: int = LENGTH, cost: Cost = Cost(),
         pool_tokens: int = POOL_TOKENS) -> Iterator[Sequence]:
    """Sequences for (key, ids) of whole documents; only the last may be short."""
    pool: list[Piece] = []
    held = 0

    def flush(last: bool) -> Iterator[Sequence]:
        nonlocal pool, held
        packed, pool, held = pack_pool(pool, length, cost), [], 0
        for sequence in packed:
            if sequence.used == length or last:
                yield sequence
            else:
                pool.extend(sequence.pieces)
                held += sequence.used

    for key, ids in documents:
        rest = Piece(key, 0, len(ids) // 4, len(ids) // 4, ids)
        while rest.length >= length:
            full, rest = rest.split(length)
            yield Sequence([full], length)
        if rest.length:
            pool.append(rest)
            held += rest.length
        if held >= pool_tokens:
            yield from flush(False)
    yield from flush(True)


SCHEMA = "key {key}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack_texts(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH,
               cost: Cost = Cost(), end: int = END, with_ids: bool = True, memo_words: int = MEMO_WORDS) -> DataFrame:
    """One row per piece: ``key, start, length, ids, doc_tokens, sequence_id, offset`` and ``ids_crc32``.

    A task packs the rows it reads, so nothing is shuffled; ``sequence_id`` is
    the task's number and a count, the same when the task runs again.
    ``with_ids=False`` leaves the ids out (NULL).  ``memo_words`` bounds the words
    whose ids a worker remembers (about 250 bytes each, in two generations).
    """
    slim = df.select(F.col(key).alias("key"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens.shared(tokenizer, memo_words)
        tail = np.array([end], "<u4").tobytes()

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                for part in slices(batch, "t", 3 << 20):
                    for k, ids in zip(part.column("key").to_pylist(), words.encode(part.column("t"))):
                        yield k, ids + tail

        first = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = [kind, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for n, sequence in enumerate(pack(documents(), length, cost)):
            offset = 0
            for p in sequence.pieces:
                rows.append((p.key, p.start, p.length, p.ids if with_ids else None, p.total, first + n, offset,
                             zlib.crc32(p.ids)))
                offset += p.length
            if len(rows) >= 2000:
                yield batch()
                rows = []
        yield batch()

    key_type = slim.schema["key"].dataType
    schema = SCHEMA.format(key=key_type.simpleString()) + ", ids_crc32 long"
    names = ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
    kind = to_arrow_type(key_type)
    return reachable(slim).mapInArrow(run, schema).withColumnRenamed("key", key)
