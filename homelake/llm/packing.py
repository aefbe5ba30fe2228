"""Harmonic packing of documents into sequences (operator 2).

A document is cut into pieces of the sizes capacity // k, the largest that fits first; what is
left when it is small goes whole into the class of lengths in (capacity / (k + 1), capacity / k].
Each class fills its bins with exactly k pieces. Every task packs what it reads, without any
exchange; the bins that are still open at its end are joined into a stream and cut at the
capacity, and the last part of the stream at powers of two, which need no padding.

Defined results: null text is an empty document, whose one token is the end mark; a text of any
length is cut as often as needed; repeated rows are packed each; an empty table gives no rows;
other columns of the input are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import column
from .tokens import word_tokenizer

CAPACITY = 2048
END = 1
#: Class from which a rest is packed whole: its padding is at most 1 / (k + 1) of it.
FINE = 32
WIDTH = 4  # bytes of an id
# Given back at once: rows, and bytes of their ids.
_ROWS, _BYTES = 5000, 2 << 20

PIECES = (
    "doc_id {}, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "bin_class int, padded_length int, ids binary"
)


class Packer:
    """Open bins of one task: at most ``capacity`` tokens for each class."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, fine: int = FINE):
        self.capacity, self.fine = capacity, fine
        self.next = first_sequence
        self.bins: dict[int, list] = defaultdict(list)
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, doc_id, ids: bytes) -> None:
        total, at = len(ids) // WIDTH, 0
        while at < total:
            k, size = self.fit(total - at)
            piece = (doc_id, at, size, total, ids[at * WIDTH : (at + size) * WIDTH])
            at += size
            bin_ = self.bins[k]
            bin_.append(piece)
            if len(bin_) == k:
                self.close(bin_, k)
                self.bins[k] = []

    def fit(self, rest: int) -> tuple[int, int]:
        """Class and size of the next piece of a document with ``rest`` tokens left."""
        if rest >= self.capacity:
            return 1, self.capacity
        k = self.capacity // rest
        if k >= self.fine or self.capacity // k == rest:
            return k, rest
        return k + 1, self.capacity // (k + 1)

    def close(self, pieces: list, k: int) -> None:
        offset, filled = 0, sum(p[2] for p in pieces)
        padded = filled if filled & (filled - 1) == 0 else self.capacity
        for doc_id, start, size, total, ids in pieces:
            self.rows.append((doc_id, start, size, total, self.next, offset, k, padded, ids))
            offset += size
        self.next += 1
        self.bytes += filled * WIDTH

    def full(self) -> bool:
        """If the rows are to be given back."""
        return len(self.rows) >= _ROWS or self.bytes >= _BYTES

    def taken(self) -> list[tuple]:
        done, self.rows, self.bytes = self.rows, [], 0
        return done

    def finish(self) -> None:
        """Close the open bins: their pieces one after another, cut wherever a sequence is full."""
        stream = [p for k in sorted(self.bins) for p in self.bins[k]]
        left = sum(p[2] for p in stream)
        now, room = [], 0
        for doc_id, start, size, total, ids in stream:
            at = 0
            while at < size:
                if room == 0:
                    room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                    left -= room
                take = min(room, size - at)
                now.append((doc_id, start + at, take, total, ids[at * WIDTH : (at + take) * WIDTH]))
                at += take
                room -= take
                if room == 0:
                    self.close(now, 0)
                    now = []
        self.bins.clear()


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    fine: int = FINE,
) -> DataFrame:
    """One row per piece with its ids (little-endian unsigned 32-bit numbers).

    ``tokenizer`` is the path of a vocabulary file on the executors. ``bin_class`` is the number
    of pieces of a bin of that class, 0 for the joined rest of a task. Sequence ids are unique.
    """
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    kind = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = word_tokenizer(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 40, capacity, fine)
        mark = end.to_bytes(WIDTH, "little")
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "bin_class", "padded_length", "ids"]
        types = None

        def out():
            columns = list(zip(*packer.taken(), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            types = [batch.schema.field(0).type, *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.binary()]
            for key, content in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(key.as_py(), words.encode(content.as_py()) + mark)
                if packer.full():
                    yield out()
        packer.finish()
        if packer.rows:
            yield out()

    return rows.mapInArrow(run, PIECES.format(kind.simpleString()))
