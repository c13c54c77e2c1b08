"""Harmonic packing of documents into training sequences."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from paperloom.llm.tokens import encoded

PIECE = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
ROWS = 1024


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Cut `n` tokens into whole sequences and then into ever smaller reciprocal classes.

    Of a rest, the largest capacity / k that it holds is cut off, rounded down; what is left is less
    than a k-th of it, so the rests shrink quadratically.
    """
    whole, rest = divmod(n, capacity)
    out = [capacity] * whole
    while rest:
        length = capacity // (capacity // (rest + 1) + 1)
        out.append(length)
        rest -= length
    return out


class Bins:
    """The open bin of each class of one worker; class k takes the pieces of capacity / k tokens, always as many."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next, self.open = capacity, first, {}

    def close(self, pieces: list[tuple]) -> Iterator[tuple]:
        sequence, at = self.next, 0
        self.next += 1
        for doc_id, start, length, n, piece in pieces:
            yield doc_id, start, length, n, sequence, at, piece
            at += length

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        n, start = len(ids) // 4, 0
        for length in piece_lengths(n, self.capacity):
            held = self.open.setdefault(length, [])
            held.append((doc_id, start, length, n, ids[4 * start:4 * (start + length)]))
            start += length
            if len(held) == self.capacity // length:
                yield from self.close(self.open.pop(length))

    def rest(self) -> Iterator[tuple]:
        """What is left in open bins, cut anew: full sequences, then ones of a power of two."""
        pieces = [p for held in self.open.values() for p in held][::-1]
        left = sum(p[2] for p in pieces)
        while pieces:
            size = min(self.capacity, 1 << left.bit_length() - 1)
            left, taken = left - size, []
            while size:
                doc_id, start, length, n, ids = pieces.pop()
                if length > size:
                    pieces.append((doc_id, start + size, length - size, n, ids[4 * size:]))
                    length, ids = size, ids[:4 * size]
                taken.append((doc_id, start, length, n, ids))
                size -= length
            yield from self.close(taken)


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of every document.

    A document, its ids and `end_id`, is cut into pieces whose lengths are capacity / k, rounded down.
    A bin takes pieces of one length, always as many as it holds; what a bin lacks to `capacity` is
    less than one of its pieces. Each task packs the rows of its own partition and holds at most one
    open bin per length, some ninety in all; nothing is shuffled. What is open at the end of a
    partition is cut anew into full sequences and some of a power of two, which need no padding.
    `sequence_id` is unique; its upper bits are the task's number.

    A null or empty text is the end id alone. Null ids and repeated rows are packed like any row.
    An empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, rows = Bins(capacity, TaskContext.get().partitionId() << 40), []
        for doc_id, ids in encoded(batches, tokenizer, end_id):
            rows.extend(bins.add(doc_id, ids))
            if len(rows) >= ROWS:
                yield batch(rows)
                rows = []
        rows.extend(bins.rest())
        if rows:
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        names = [c.split()[0] for c in PIECE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), KINDS)], names=names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, PIECE)
