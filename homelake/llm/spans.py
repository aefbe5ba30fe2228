"""Substring deduplication by level-wise doubling (operator 9).

A window is ``window`` consecutive words of one document; every word covered by a window whose
word sequence also starts anywhere else is removed. Only windows that repeat at a short length
are looked at at twice that length, and so on up to the window's own length.

Levels below the last look at anchors alone: of the short windows that a long one holds, the one
with the smallest hash. Two places with the same long window have the same anchor in it, so none
is lost, and few short windows are looked at. Equal texts are looked at once: of a text with copies
every window starts elsewhere, so all its words go if it has a window at all.

Defined results: null text has no words and keeps none; documents shorter than a window keep all;
repeated rows are places of their own; a word sequence that starts twice in one document counts as
repeated; an empty table gives no rows; other columns are not read. Hashes of the last level have
96 bits, those before only choose candidates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import column, release, stored

WINDOW = 35
#: Length of the windows of the first level; later levels double it up to the window.
FIRST = 9
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BYTE_ODD = (0xD1B54A32D192ED03, 0xABC98388FB8FAC03)
_CHUNK = 1 << 20  # bytes hashed at a time


def joined_words(text: str | None) -> bytes:
    """The words of a text, joined by one space."""
    return b" ".join(text.encode("utf-8", "surrogatepass").split()) if text else b""


class _ByteTables:
    """A number for each byte, and powers of an odd number as far as the longest word needs."""

    def __init__(self, which: int):
        self.base = _BYTE_ODD[which]
        self.numbers = np.random.default_rng(which).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.numbers[32] = 0  # between words
        self.up = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, len(self.up), 1 << 64))])


_BYTES = [_ByteTables(i) for i in range(2)]


def word_starts(words: bytes) -> np.ndarray:
    """Where each of the words, joined by spaces, begins."""
    if not words:
        return np.empty(0, np.int64)
    spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    return np.concatenate([np.zeros(1, np.int64), spaces + 1])


def word_hashes(words: bytes, starts: np.ndarray, which: int) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial of its bytes, all words of a chunk at once."""
    tables = _BYTES[which]
    content = np.frombuffer(words, np.uint8)
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        end = max(first + 1, int(np.searchsorted(starts, starts[first] + _CHUNK)))
        own = starts[first:end]
        until = starts[end] if end < len(starts) else len(content) + 1
        sizes = np.diff(own, append=until)
        tables.reach(int(sizes.max()))
        part = content[own[0] : until]
        places = np.arange(len(part)) - np.repeat(own - own[0], sizes)[: len(part)]
        out[first:end] = np.add.reduceat(tables.numbers[part] * tables.up[places], own - own[0])
        first = end
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2 ** 64, as far as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            step = len(self.up)
            for name, base in (("up", self.base), ("down", self.inverse)):
                now = getattr(self, name)
                setattr(self, name, np.concatenate([now, now * np.uint64(pow(base, step, 1 << 64))]))


_POWERS = [_Powers(b) for b in _ODD]


def window_hashes(hashes: np.ndarray, length: int, which: int) -> np.ndarray:
    """A hash of each window of ``length`` words: a polynomial in an odd number, then mixed."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64)
    powers = _POWERS[which]
    powers.reach(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers.down[:n], out=sums[1:])
    out = (sums[length:] - sums[:-length]) * powers.up[: n - length + 1]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def anchors(hashes: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window: where its anchor of ``length`` words starts, and the anchor's hash. Of equal
    hashes the first counts; the anchor of the full length is the window itself."""
    short = window_hashes(hashes, length, 0)
    span = window - length + 1
    if len(short) < span:
        return np.empty(0, np.int64), short[:0]
    if span == 1:
        return np.arange(len(short)), short
    # Places of the smallest hash of 2, 4, 8 and so on; two of them make up the span.
    at, size = np.arange(len(short)), 1
    while size < span:
        step = min(size, span - size)
        left, right = at[:-step], at[step:]
        at = np.where(short[right] < short[left], right, left)
        size += step
    return at, short[at]


def levels(first: int, window: int) -> list[int]:
    """Lengths of the windows looked at: doubled each time, the last one the window itself."""
    if window < 2:
        raise ValueError("a window has at least two words")
    out = [min(first, (window + 1) // 2)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def _spread(marks: np.ndarray, length: int) -> np.ndarray:
    """Positions covered by windows of ``length`` that start where ``marks`` is set."""
    steps = np.zeros(len(marks) + 1, np.int64)
    at = np.flatnonzero(marks)
    np.add.at(steps, at, 1)
    np.add.at(steps, np.minimum(at + length, len(marks)), -1)
    return np.cumsum(steps[:-1]) > 0


def _first_pass(first: int, window: int):
    """Of every document: number of words, digest of all of them, and the first level's anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, found = [], [], []
            for text in batch.column(2):
                words = joined_words(text.as_py())
                starts = word_starts(words)
                counts.append(len(starts))
                digests.append(hashlib.sha256(words).hexdigest())
                at, hashes = anchors(word_hashes(words, starts, 0) if len(starts) >= window else np.empty(0, np.uint64), first, window)
                found.append(hashes[np.unique(at, return_index=True)[1]].view(np.int64))
            lists = pa.ListArray.from_arrays(
                np.cumsum([0, *map(len, found)]).astype(np.int32), pa.array(np.concatenate(found)) if found else pa.array([], pa.int64())
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(counts, pa.int64()), pa.array(digests, pa.string()), lists],
                ["text_id", "doc_id", "n_words", "whole_sha256", "anchors"],
            )

    return run


def _surviving(hashes: np.ndarray, found: list, steps: list[int], window: int) -> np.ndarray:
    """Mask of the windows whose anchors repeat at each level so far."""
    alive = np.ones(max(0, len(hashes) - window + 1), bool)
    for length, repeated in zip(steps, found, strict=True):
        alive &= np.isin(anchors(hashes, length, window)[1].view(np.int64), np.array(repeated or [], np.int64))
    return alive


def _next_level(steps: list[int], length: int, window: int):
    """(row_key, hash[, high]) of the anchors of ``length`` in windows that survive the levels before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for batch in batches:
            for key, text, *found in zip(*batch.columns, strict=True):
                words = joined_words(text.as_py())
                starts = word_starts(words)
                hashes = word_hashes(words, starts, 0)
                alive = _surviving(hashes, [f.as_py() for f in found], steps, window)
                if not alive.any():
                    continue
                at, own = anchors(hashes, length, window)
                places, first = np.unique(at[alive], return_index=True)
                row = [np.full(len(places), key.as_py(), np.int64), own[alive][first].view(np.int64)]
                if length == window:
                    high = window_hashes(word_hashes(words, starts, 1), window, 1)[places]
                    row.append((high & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32))
                held.append(tuple(row))
                count += len(places)
                if count >= 100_000:
                    yield _batch(held)
                    held, count = [], 0
        if held:
            yield _batch(held)

    return run


def _batch(held: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(c)) for c in zip(*held, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["row_key", "hash", "high"][: len(columns)])


def _repeated(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(row_key, lists of hashes) of what occurs more than once over all rows.

    Counts are formed before the exchange; the join back is between two written tables, so that
    the partition of a very common window can be split.
    """
    many = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    many = stored(many.select(*[F.col(k).alias(f"many_{k}") for k in keys]), "repeated")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"many_{k}"))
    kept = rows.join(many, on, "left_semi")
    out = stored(kept.groupBy("row_key").agg(*[F.collect_list(k).alias(f"{name}_{k}") for k in keys]), "places")
    release(many)
    return out


def _covered(words: bytes, starts: np.ndarray, low: np.ndarray, high: np.ndarray, window: int) -> np.ndarray:
    """Mask of the words in a window whose 96-bit hash is among those given."""
    own = window_hashes(word_hashes(words, starts, 0), window, 0).view(np.int64)
    more = (window_hashes(word_hashes(words, starts, 1), window, 1) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    # Of equal low parts, which are nearly always one, each high part is compared.
    marks = np.zeros(len(own), bool)
    at = np.searchsorted(low, own)
    left = np.flatnonzero(at < len(low))
    while len(left):
        left = left[low[at[left]] == own[left]]
        marks[left[high[at[left]] == more[left]]] = True
        at[left] += 1
        left = left[at[left] < len(low)]
    return _spread(np.concatenate([marks, np.zeros(window - 1, bool)]), window)


def _without(words: bytes, starts: np.ndarray, gone: np.ndarray) -> bytes:
    """The words that stay, joined by spaces; runs of them are copied whole."""
    if not gone.any():
        return words
    edges = np.flatnonzero(np.diff(~gone, prepend=False, append=False))
    ends = np.append(starts[1:] - 1, len(words))
    return b" ".join([words[starts[a] : ends[b - 1]] for a, b in edges.reshape(-1, 2).tolist()])


def _final(window: int):
    """(text_id, n_removed, kept text) from the repeated hashes of whole windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                removed, kept = [], []
                for text, low, high in zip(*part.columns[1:], strict=True):
                    words = joined_words(text.as_py())
                    starts = word_starts(words)
                    gone = _covered(words, starts, low.values.to_numpy(), high.values.to_numpy(), window)
                    removed.append(int(gone.sum()))
                    kept.append(_without(words, starts, gone))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["text_id", "n_removed", "kept"],
                )

    return run


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, first: int = FIRST
) -> tuple[DataFrame, DataFrame]:
    """Two tables: (text_id, doc_id, n_words, whole_sha256, copies) of every document, and (text_id,
    n_removed, kept) of texts that lose words; ``kept`` is the text left, words joined by a space.
    Texts with copies that are not in the second table lose all words if they have a window."""
    steps = levels(first, window)
    content = F.coalesce(column(text), F.lit(""))
    plain = docs.select(F.md5(content).alias("text_id"), column(doc_id).alias("doc_id"), content.alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    schema = f"text_id string, doc_id {kind}, n_words long, whole_sha256 string, anchors array<long>"
    every = stored(plain.mapInArrow(_first_pass(steps[0], window), schema), "words")
    # One row for each text, with the document that stands for it.
    texts = every.groupBy("text_id").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"), F.first("anchors").alias("anchors")
    )
    texts = stored(texts.withColumn("row_key", F.xxhash64("text_id")), "distinct")
    found = _repeated(texts.select("row_key", F.explode("anchors").alias("hash")), ["hash"], "f0")
    one = texts.select("row_key", F.col("text_id").alias("own_id"), F.col("doc_id").alias("own_doc")).join(found, "row_key")
    same = (F.col("text_id") == F.col("own_id")) & F.col("doc_id").eqNullSafe(F.col("own_doc"))
    lists = ["f0_hash"]
    current = stored(plain.join(one, same).select("row_key", "text_id", "text", *lists), "texts")
    release(found)
    for at, length in enumerate(steps[1:], 1):
        last = length == window
        keys = ["hash", "high"] if last else ["hash"]
        rows = current.select("row_key", "text", *lists).mapInArrow(
            _next_level(steps[:at], length, window), "row_key long, hash long" + (", high int" if last else "")
        )
        rows = stored(rows, "windows")
        found = _repeated(rows, keys, f"f{at}")
        release(rows)
        if not last:
            lists.append(f"f{at}_hash")
            narrower = stored(current.join(found, "row_key"), "texts")
            release(current, found)
            current = narrower
    name = f"f{len(steps) - 1}"
    kept = current.join(found, "row_key").select("text_id", "text", f"{name}_hash", f"{name}_high")
    kept = stored(kept.mapInArrow(_final(window), "text_id string, n_removed long, kept string"), "kept")
    release(current, found)
    copies = stored(texts.where("copies > 1").select(F.col("text_id").alias("copied_id"), "copies"), "copied")
    whole = every.join(copies, F.col("text_id") == F.col("copied_id"), "left").select(
        "text_id", "doc_id", "n_words", "whole_sha256", F.coalesce("copies", F.lit(1)).alias("copies")
    )
    return whole, kept


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row."""
    every, kept = remove_repeats(docs, doc_id, text, window, first)
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    lost = stored(kept.select(F.col("text_id").alias("lost_id"), "n_removed", digest).dropDuplicates(["lost_id"]), "lost")
    gone = (F.col("copies") > 1) & (F.col("n_words") >= window)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return every.join(lost, F.col("text_id") == F.col("lost_id"), "left").select(
        "doc_id",
        "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, nothing).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )
