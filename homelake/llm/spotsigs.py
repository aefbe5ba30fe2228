"""Document fingerprints with SpotSigs (operator 8).

A signature is a chain of content words that follows an occurrence of a common word (its anchor).
Other anchors are one word in ``EXTRA``, by a hash of the word alone, for texts with few common
words; the first words and the last ones are a signature each. This rule is the same for every text,
whatever the number of its signatures. A document's fingerprint is the set of its signatures, and
two documents are compared by the Jaccard similarity of their sets. For near-duplicates, sets are partitioned by length, indexed by
their rarest signatures, and compared with bounds that stop early.

Defined results: null text is empty; a chain that reaches beyond the
text is none, and first and last words are filled up where there are fewer; a text without words has a single signature, of the text itself, so that equal
fingerprints of texts without words mean equal texts; texts of any length are
fingerprinted whole; an empty table gives no rows; other columns are not read. In the order of
documents, rows that repeat an id are ordered by text; a null id has no place in the order, and
such a document is its own next; so is the only one of a table.
"""

from __future__ import annotations

import base64
import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Forest, column, components, in_tiles, map_groups, partitions, stored

# Common words of the languages at hand.
COMMON = (
    "the of and to a in is that it for was on are as with be at this by from or an not have "
    "der die und den von das mit sich des auf für ist im dem nicht ein eine als auch es an zu "
    "de la le et les du un en est que une pour qui dans au par sur pas avec il "
    "el y los se del por las con no una su para al lo más"
).split()
CHAIN = 3
EXTRA = 2
THRESHOLD = 0.8
TILE = 1024
_MANY = 200_000
_ANCHOR, _NOTHING, _BOTH = 1, 2, 3  # what a word is, in the two low bits of its number
_START, _END = 4, 8  # stand before the first and the last words


class _Words(dict):
    """Numbers of words: a hash with the kind of word in its low bits."""

    def __init__(self, common):
        super().__init__()
        self.common = frozenset(common)

    def __missing__(self, raw: str) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) > _MANY:
            self.clear()
        word = "".join(filter(str.isalnum, raw))
        value = xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) & ~3
        extra = _BOTH if (value >> 2) % EXTRA == 0 else 0
        value |= _NOTHING if not word else _ANCHOR if word in self.common else extra
        self[raw] = value
        return value


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    """32-bit hashes of chains, from the numbers of their words in order."""
    out = np.full(len(parts[0]), 0x9E3779B97F4A7C15, np.uint64)
    for part in parts:
        out = (out ^ part) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out.astype(np.uint32)


def signatures(text: str | None, words: _Words, chain: int = CHAIN) -> np.ndarray:
    """The sorted set of signatures of a text, as 32-bit numbers."""
    text = text or ""
    numbers = np.array([words[w] for w in text.lower().split()], np.uint64)
    numbers = numbers[(numbers & np.uint64(3)) != _NOTHING]
    if not len(numbers):
        from xxhash import xxh3_64_intdigest

        return np.array([xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) & 0xFFFFFFFF], np.uint32)
    kind, rest = numbers & np.uint64(3), np.zeros(chain, np.uint64)
    told = kind != _ANCHOR
    content = numbers[told]
    before = np.cumsum(told)  # content words up to each word
    at = np.flatnonzero((kind == _ANCHOR) | (kind == _BOTH))
    at = at[before[at] + chain <= len(content)] if len(content) else at[:0]
    chains = _mixed([numbers[at], *(content[before[at] + i] for i in range(chain))])
    outer = np.array([[_START, *np.concatenate([numbers, rest])[:chain]], [_END, *np.concatenate([rest, numbers])[-chain:]]], np.uint64)
    return np.unique(np.concatenate([chains, _mixed(list(outer.T))]))


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 where their lengths alone rule ``at_least`` out."""
    small, large = sorted((len(a), len(b)))
    if small < at_least * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both) if large else 1.0


def written(found: np.ndarray) -> str:
    return base64.b64encode(found.astype("<u4").tobytes()).decode()


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows (range, tail, doc_id, text): ranges of ids, each ended by a copy of the next one's first.

    One exchange of whole texts. What the driver sees is one id for each range.
    """
    spark = docs.sparkSession
    wanted = 4 * partitions(spark)
    known = docs.where("doc_id is not null")
    bounds = sorted(set(known.approxQuantile("doc_id", [i / wanted for i in range(1, wanted)], 0.1 / wanted)))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series([bisect_left(bounds, v) for v in ids])

    own = range_of("doc_id")
    firsts = {r["range"]: r["first"] for r in known.groupBy(own.alias("range")).agg(F.min("doc_id").alias("first")).collect()}
    order = sorted(firsts)
    before = {firsts[r]: order[i - 1] for i, r in enumerate(order)}

    @F.pandas_udf("array<struct<range:int,tail:int>>")
    def places(ids: pd.Series, spread: pd.Series) -> pd.Series:
        out = []
        for v, any_range in zip(ids, spread, strict=True):
            if pd.isna(v):
                out.append([(-1 - int(any_range), 0)])
                continue
            here = [(bisect_left(bounds, v), 0)]
            out.append(here if v not in before else [*here, (before[v], 1)])
        return pd.Series(out)

    spread = F.pmod(F.xxhash64("text"), F.lit(wanted))
    placed = docs.withColumn("place", F.explode(places("doc_id", spread)))
    rows = placed.select("place.range", "place.tail", "doc_id", "text")
    return rows.repartition(partitions(spark), "range").sortWithinPartitions("range", "tail", "doc_id", "text")


def against_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike they are.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next): the
    edit replaces the last half by the beginning of the next document in order of id.
    """
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(COMMON)
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = None

        def result(row, following):
            key, content, own = row
            changed = edited(content, following[1])
            theirs = signatures(changed, words, chain)
            digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
            likes = likeness(own, theirs), likeness(own, following[2])
            return key, len(content), digest, written(own), written(theirs), *likes

        def batch_of(held):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names
            )

        held, last, last_range = [], None, None
        for batch in batches:
            types = [batch.schema.field(2).type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            for where, tail, key, content in zip(*batch.columns, strict=True):
                where, content = where.as_py(), content.as_py() or ""
                row = (key.as_py(), content, signatures(content, words, chain))
                if last is not None and where == last_range:
                    held.append(result(last, row))
                if where < 0:
                    held.append(result(row, row))
                # Of rows that end a range only the first counts, and it is told in its own range.
                last = None if where < 0 or tail.as_py() else row
                last_range = where
                if len(held) >= 500:
                    yield batch_of(held)
                    held = []
        if held:
            yield batch_of(held)

    return _in_order(rows).mapInArrow(
        run,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """(doc_id, signatures) for every row: sorted sets of numbers."""
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))

    @F.pandas_udf("array<long>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = _Words(COMMON)
        for texts in batches:
            yield pd.Series([signatures(t, words, chain).astype(np.int64) for t in texts])

    return rows.select("doc_id", of("text").alias("signatures"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, tile: int = TILE
) -> DataFrame:
    """(doc_id, component_id) for every row: the smallest id reachable over similarities of at
    least ``threshold``.

    A set of length n goes to the length class floor(log(n) / log(1 / threshold)); sets that are
    similar enough lie in the same class or in neighbouring ones. In each class, sets meet at the
    signatures that are rarest, of which similar ones must share one of the first
    n - ceil(threshold * n) + 1.
    """
    rows = stored(fingerprints(docs, doc_id, text), "signatures")
    rows = rows.withColumn("entry", F.md5(F.array_join(F.col("signatures").cast("array<string>"), ",")))
    entries = stored(
        rows.groupBy("entry").agg(F.first("signatures").alias("signatures"), F.min("doc_id").alias("first_id")), "entries"
    )
    n = F.size("signatures")
    step = math.log(1 / threshold)
    exploded = entries.select("entry", n.alias("n"), F.explode("signatures").alias("signature"))
    common = stored(exploded.groupBy("signature").agg(F.count("*").alias("df")), "signature_counts")
    ranked = Window.partitionBy("entry").orderBy("df", "signature")
    kept = F.col("n") - F.ceil(threshold * F.col("n") - 1e-9) + 1
    prefix = exploded.join(common, "signature").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= kept)
    level = F.floor(F.log("n") / step + 1e-9).cast("int")
    prefix = prefix.select(
        "entry", "signature", F.explode(F.array(F.struct(level.alias("level"), F.lit(True).alias("home")), F.struct((level + 1).alias("level"), F.lit(False).alias("home")))).alias("p")
    ).select("entry", F.struct("p.level", "signature").alias("key"), "p.home")
    shared = prefix.groupBy("key").agg(F.count_if("home").alias("homes"), F.count("*").alias("all")).where("homes > 0 and all > 1")
    shared = stored(shared.select(F.col("key").alias("shared_key")), "shared")
    met = prefix.join(shared, F.col("key") == F.col("shared_key"), "left_semi")
    tiled = in_tiles(met, "key", "entry", tile).join(entries.select("entry", "signatures"), "entry")
    tiled = tiled.select("key.level", "key.signature", "tile_a", "tile_b", "home", "entry", "signatures")

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [table[k].to_numpy() for k in ("level", "signature", "tile_a", "tile_b")]
        change = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            change |= k[1:] != k[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
        names, home = table["entry"].to_pylist(), table["home"].to_numpy(zero_copy_only=False)
        sets = [np.array(s, np.uint32) for s in table["signatures"].to_pylist()]
        out = []
        for a, b in zip(starts, starts[1:], strict=False):
            order = sorted(range(a, b), key=lambda i: len(sets[i]))
            forest = Forest(b - a)
            for x, i in enumerate(order):
                for j in order[x + 1 :]:
                    if len(sets[i]) < threshold * len(sets[j]):
                        break  # later ones are longer still
                    if (home[i] or home[j]) and forest.root(i - a) != forest.root(j - a):
                        if likeness(sets[i], sets[j], threshold) >= threshold:
                            forest.join(i - a, j - a)
            out += [(names[a + i], names[a + j]) for i, j in forest.joins]
        if out:
            left, right = zip(*out, strict=True)
            yield pa.RecordBatch.from_pydict({"a": list(left), "b": list(right)})

    edges = map_groups(tiled, ["level", "signature", "tile_a", "tile_b"], work, "a string, b string", rows=4096)
    linked = stored(components(edges).withColumnsRenamed({"node": "entry"}), "linked")
    own = entries.select("entry", "first_id").join(linked, "entry", "left").withColumn("component", F.coalesce("component", "entry"))
    own = stored(own, "own")
    named = stored(own.groupBy("component").agg(F.min("first_id").alias("component_id")), "named")
    classes = stored(own.join(named, "component").select(F.col("entry").alias("class"), "component_id"), "classes")
    return rows.join(classes, F.col("entry") == F.col("class")).select("doc_id", "component_id")
