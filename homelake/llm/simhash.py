"""SimHash near-duplicates with bit-sliced comparison (operator 6).

Fingerprints are grouped by shared bit blocks (at most ``radius`` differing bits leave at least
``blocks - radius`` of the blocks equal). Within a group, bit b of all fingerprints is stored as
one vertical plane, 64 fingerprints a machine word. Planes are compared with themselves shifted,
so one pass updates the distances of all neighbours at that shift with carry-save counters, and
it is abandoned once every distance exceeds the radius.

Defined results: null or wordless text has fingerprint zero, which links like any other; a text
with fewer words than a shingle is one shingle; repeated rows share a fingerprint and a
component; a null doc_id is in the component of its fingerprint but never names it unless no
other id is there; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .shared import Forest, column, components, in_tiles, map_groups, stored

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Rows of one group that are compared in one task; larger groups are compared in pieces.
TILE = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the text's word shingles, as an unsigned number."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[len(words) - n :].tolist()
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    """The fingerprint as a signed number of the same bits."""
    values = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
    return pd.Series(values.view(np.int64))


def block_widths(n: int, radius: int) -> list[int]:
    """Widths of the blocks whose equality is asked for, by the number of fingerprints.

    Every choice of ``blocks - radius`` blocks is one way to meet. More blocks give longer keys:
    the fewest are taken with which keys are about as many as fingerprints. Results are the same
    for any number.
    """
    blocks = radius + 2
    while blocks < min(radius + 4, 64) and 64 // blocks * (blocks - radius) < max(1, n).bit_length():
        blocks += 1
    return [64 // blocks + (i < 64 % blocks) for i in range(blocks)]


def _keys(widths: list[int], radius: int):
    """Keys of a fingerprint: each choice of blocks, packed, after the number of the choice."""
    starts = np.concatenate([[0], np.cumsum(widths)[:-1]]).tolist()
    out = []
    for at, chosen in enumerate(combinations(range(len(widths)), len(widths) - radius)):
        value = F.lit(0).cast("long")
        for i in chosen:
            mask = (1 << widths[i]) - 1
            value = F.shiftleft(value, widths[i]).bitwiseOR(F.shiftrightunsigned("fp", starts[i]).bitwiseAND(F.lit(mask)))
        out.append(F.struct(F.lit(at).cast("short").alias("way"), value.alias("bits")))
    return F.array(*out)


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of fingerprints: row b holds bit b of each, 64 to a word, with a spare word."""
    n = len(values)
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    out = np.zeros((64, n // 64 + 2), np.uint64)
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    out.view(np.uint8).reshape(64, -1)[:, : packed.shape[1]] = packed
    return out


def _shifted(planes: np.ndarray, lag: int) -> np.ndarray:
    """Planes in which position p holds what is at p + lag."""
    words, bits = divmod(lag, 64)
    rest = planes[..., words:]
    if not bits:
        return rest
    out = rest >> np.uint64(bits)
    out[..., :-1] |= rest[..., 1:] << np.uint64(64 - bits)
    return out


def within_radius(planes: np.ndarray, lag: int, alive: np.ndarray, radius: int) -> np.ndarray:
    """Word mask of positions p, among ``alive``, whose fingerprint is close to that at p + lag.

    Distances are counted in bit-sliced form: three planes at a time go through a full adder
    (carry-save), and the sums ripple into counters. A counter that passes the radius clears its
    bit of ``alive``; when none is left, the remaining planes are not looked at.
    """
    other = _shifted(planes, lag)
    width = min(other.shape[1], len(alive))
    other, alive = other[:, :width], alive[:width].copy()
    levels = radius.bit_length() + 1
    counters = [np.zeros(width, np.uint64) for _ in range(levels)]
    lost = np.zeros(width, np.uint64)

    def add(carry, level):
        for k in range(level, levels):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        np.bitwise_or(lost, carry, out=lost)

    def beyond():
        """Bits of positions whose count is over the radius."""
        over, equal = lost.copy(), ~np.zeros(width, np.uint64)
        for k in range(levels - 1, -1, -1):
            if radius >> k & 1:
                equal = equal & counters[k]
            else:
                over |= equal & counters[k]
                equal = equal & ~counters[k]
        return over

    for b in range(0, 63, 3):
        x, y, z = (planes[b + i, :width] ^ other[b + i] for i in range(3))
        half = x ^ y
        add(half ^ z, 0)
        add((x & y) | (half & z), 1)
        if b % 12 == 9:
            alive &= ~beyond()
            if not alive.any():
                return alive
    add(planes[63, :width] ^ other[63], 0)
    return alive & ~beyond()


def _bits(mask: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(mask.view(np.uint8), bitorder="little"))


def link_groups(values: np.ndarray, sizes: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect all close fingerprints of each group; groups lie one after another.

    Of the links found, only those are kept that join two parts that were apart.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.concatenate([np.arange(starts[g], starts[g] + sizes[g]) for g in order]) if len(sizes) else np.empty(0, int)
    values, sizes = values[place], sizes[order]
    n = len(values)
    planes = _planes(values)
    left = np.concatenate([np.arange(s - 1, -1, -1) for s in sizes]) if n else np.empty(0, int)
    forest, roots = Forest(n), np.arange(n)
    reach = n
    for lag in range(1, int(sizes.max(initial=1))):
        # Larger groups come first, so what still has a partner at this shift is a leading part.
        reach = int(sizes[: int(np.searchsorted(-sizes, -lag, "left"))].sum()) if lag > 1 else reach
        words = reach // 64 + 2
        mask = np.zeros(words * 64, np.uint8)
        mask[:reach] = left[:reach] >= lag
        alive = np.packbits(mask, bitorder="little").view(np.uint64)
        part = planes[:, : min(planes.shape[1], words + lag // 64 + 1)]
        close = _bits(within_radius(part, lag, alive, radius))
        new = close[roots[close] != roots[close + lag]] if len(close) else close
        for p in new.tolist():
            forest.join(p, p + lag)
        if len(new):
            roots = forest.roots()
    return [(int(place[i]), int(place[j])) for i, j in forest.joins]


def _linker(radius: int):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        way, bits = table["way"].to_numpy(), table["bits"].to_numpy()
        a, b, values = table["tile_a"].to_numpy(), table["tile_b"].to_numpy(), table["fp"].to_numpy()
        change = (np.diff(way) != 0) | (np.diff(bits) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        sizes = np.diff(np.concatenate([starts, [len(values)]]))
        many = np.repeat(sizes > 1, sizes)
        values, sizes = values[many], sizes[sizes > 1]
        links = link_groups(values.view(np.uint64), sizes, radius)
        if links:
            i, j = np.array(links).T
            yield pa.RecordBatch.from_pydict({"a": values[i], "b": values[j]})

    return work


def link(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(fp, component) for distinct fingerprints ``fp``: the smallest of those linked to it, as
    signed numbers; fingerprints without a link are left out."""
    widths = block_widths(prints.count(), radius)
    keyed = prints.select("fp", F.explode(_keys(widths, radius)).alias("key"))
    keyed = keyed.select("fp", "key.way", "key.bits", F.struct("key.way", "key.bits").alias("key"))
    tiled = in_tiles(keyed, "key", "fp", tile).drop("key")
    edges = map_groups(tiled, ["way", "bits", "tile_a", "tile_b"], _linker(radius), "a long, b long")
    return components(edges).withColumnsRenamed({"node": "fp"})


def group(rows: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Stored rows (doc_id, fp, ...) with ``component`` (smallest fingerprint of the group) and
    ``component_id`` (its smallest doc_id)."""
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    linked = stored(link(distinct.select("fp"), radius, tile), "linked")
    own = stored(distinct.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "own")
    # Both sides of the join are written tables: the partition of a large component can be split.
    named = stored(own.groupBy("component").agg(F.min("first_id").alias("component_id")), "named")
    classes = stored(own.select("fp", "component").join(named, "component"), "classes")
    return rows.join(classes, "fp")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(column(doc_id).alias("doc_id"), fingerprint_of(column(text)).alias("fp"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint as 16 hexadecimal digits, component_id) for every row."""
    rows = stored(fingerprints(docs, doc_id, text), "simhash")
    out = group(rows, radius)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest id; all columns unchanged.

    Of different texts under that id, the first in order of fingerprint and hash stays; of rows
    that repeat it with the same text, any one. Null ids come after all others.
    """
    key, mark = F.coalesce(F.concat(F.lit("i"), column(doc_id).cast("string")), F.lit("n")), F.xxhash64(column(text))
    rows = stored(
        docs.select(
            column(doc_id).alias("doc_id"), key.alias("key"), mark.alias("mark"), fingerprint_of(column(text)).alias("fp")
        ),
        "simhash",
    )
    first = group(rows, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    best = first.groupBy("component").agg(F.min(F.struct("fp", "mark", "key")).alias("best"))
    kept = stored(best.select(F.col("best.key").alias("__kept_key"), F.col("best.mark").alias("__kept_mark")), "kept")
    marked = docs.withColumns({"__key": key, "__mark": mark})
    chosen = marked.join(kept, (F.col("__key") == F.col("__kept_key")) & (F.col("__mark") == F.col("__kept_mark")), "left_semi")
    return chosen.dropDuplicates(["__key", "__mark"]).select(*[column(c) for c in docs.columns])
