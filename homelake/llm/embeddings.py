"""Embedding near-duplicates with an inverted multi-index (operator 7).

Vectors are scaled to length one and cut in halves; each half has its own codebook, and the pairs
of codes form a grid of cells. A vector lies in its nearest cell and, as a query, visits cells in
the order of their distance (multi-sequence traversal) until the target recall is reached. What
meets in a cell with the same label is then verified by the cosine in double precision.

How far to go: for a partner within the threshold's distance t, each half moves by at most t, and
its cell's border with the nearest one lies across at a known distance. A cell is visited while
these two distances together are below t times ``reach``. ``reach`` = 1 reaches every partner;
for a difference that is spread over all directions, its part across a border is about
t / sqrt(half), so ``reach`` = z / sqrt(half) with the normal quantile z of the target recall.

Only the cell of the larger number of two is visited by the vector of the other, so each pair is
met once. Equal vectors are one entry with a weight; groups of any size are compared in tiles.

Defined results: null, zero and non-finite vectors, and null labels, link with nothing, nor do
vectors of different length; equal vectors link (cosine 1); a null vec_id is the last to name a
component; repeated ids count as vectors each; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Forest, column, components, in_tiles, map_groups, stored

THRESHOLD = 0.98
TARGET_RECALL = 0.9999
#: Vectors that the codebooks are learned from, in order of a hash: the bound of the sample.
SAMPLE = 8192
#: Vectors of one label that a cell should hold, and the largest codebook of a half.
PER_CELL, MOST_CODES = 64, 256
TILE = 2048


def codebook(halves: np.ndarray, codes: int, rounds: int = 8) -> np.ndarray:
    """Centres of k-means; empty ones keep their place. Starts from rows spread over the sample."""
    centres = halves[np.linspace(0, len(halves) - 1, codes).astype(int)].copy()
    for _ in range(rounds):
        own = _distances(halves, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, halves)
        counts = np.bincount(own, minlength=codes)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return np.unique(centres, axis=0)


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    out = (rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1)[None]
    return np.maximum(out, 0)


def unit(vector) -> np.ndarray | None:
    """A vector of length one in double precision, or None if it has no direction."""
    if vector is None or len(vector) == 0 or any(v is None for v in vector):
        return None
    values = np.asarray(vector, np.float64)
    largest = np.abs(values).max()
    if not np.isfinite(values).all() or largest == 0:
        return None
    values = values / largest
    return values / math.sqrt(float(values @ values))


def borders(half: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distance from a half to the border between its own cell and each other one."""
    squared = _distances(half[None], centres)[0]
    own = int(squared.argmin())
    apart = np.sqrt(((centres - centres[own]) ** 2).sum(axis=1))
    out = (squared - squared[own]) / np.where(apart > 0, 2 * apart, 1)
    out[own] = 0.0
    return out


def traverse(first: np.ndarray, second: np.ndarray, limit: float) -> Iterator[tuple[int, int]]:
    """Cells in order of their distance first ** 2 + second ** 2, up to limit ** 2.

    The multi-sequence order: both halves' codes are sorted, and a cell is queued once the cells
    before it in either sequence have been taken.
    """
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    queue, seen = [(float(first[rows[0]] ** 2 + second[columns[0]] ** 2), 0, 0)], {(0, 0)}
    while queue:
        distance, i, j = heapq.heappop(queue)
        if distance > limit**2:
            return
        yield int(rows[i]), int(columns[j])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(rows) and b < len(columns) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(queue, (float(first[rows[a]] ** 2 + second[columns[b]] ** 2), a, b))


class Index:
    """The codebooks of one vector length, and the reach of queries."""

    def __init__(self, sample: np.ndarray, n: int, threshold: float, target_recall: float):
        self.cut = max(1, sample.shape[1] // 2)
        parts = [sample[:, : self.cut], sample[:, self.cut :]]
        codes = int(min(MOST_CODES, len(sample), max(1, round(math.sqrt(n / PER_CELL)))))
        self.books = [codebook(p, codes) if p.shape[1] else np.zeros((1, 0)) for p in parts]
        distance = math.sqrt(max(0.0, 2 - 2 * threshold))
        spread = NormalDist().inv_cdf((1 + min(target_recall, 1 - 1e-12)) / 2) / math.sqrt(self.cut)
        self.limit = distance * min(1.0, spread if target_recall < 1 else 1.0) + 1e-9

    def cells(self, vector: np.ndarray) -> list[int]:
        """Numbers of the visited cells; the first is the vector's own."""
        far = [borders(h, b) for h, b in zip((vector[: self.cut], vector[self.cut :]), self.books, strict=True)]
        width = len(self.books[1])
        return [i * width + j for i, j in traverse(far[0], far[1], self.limit)]


def learn(rows: DataFrame, threshold: float, target_recall: float, sample: int = SAMPLE) -> dict[int, Index]:
    """An index for each vector length, from a bounded number of vectors of each."""
    sizes = {r["size"]: r["n"] for r in rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).collect()}
    out = {}
    for size, n in sorted(sizes.items()):
        own = rows.where(F.size("vector") == size)
        part = F.pmod(F.xxhash64("entry"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, 1.5 * sample / n))
        chosen = own.where(part).orderBy(F.xxhash64("entry"), "entry").limit(sample).select("vector").toPandas()
        vectors = [v for v in map(unit, chosen["vector"]) if v is not None]
        if vectors:
            out[size] = Index(np.stack(vectors), n, threshold, target_recall)
    return out


def _visitor(indexes: dict[int, Index], spark):
    sent = spark.sparkContext.broadcast(indexes)

    @F.pandas_udf("array<int>")
    def visited(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            out = []
            for vector in vectors:
                index = sent.value.get(len(vector))
                cells = index.cells(unit(vector)) if index else [0]
                out.append([cells[0], *(c for c in cells[1:] if c > cells[0])])
            yield pd.Series(out)

    return visited


def _verifier(threshold: float):
    """Links of each group of a cell: their number for each entry, and those that connect it."""

    def group(names, vectors, weights, home, own, tile_a, n_tiles):
        units = np.stack([unit(v) for v in vectors])
        n, links, forest = len(names), np.zeros(len(names), np.int64), Forest(len(names))
        # Rows of one tile meet in several pieces; they count in that with the next tile.
        low, high = int(tile_a), int(own.max(initial=0))
        inside = {t for t in (low, high) if n_tiles == 1 or {t, (t + 1) % n_tiles} == {low, high}}
        counted = np.isin(own, list(inside))
        for at in range(0, n, 512):
            rows = slice(at, min(n, at + 512))
            near = units[rows] @ units.T >= threshold
            near &= home[rows, None] | home[None]
            near &= (own[rows, None] != own[None]) | counted[None]
            near &= np.arange(n)[None] > np.arange(n)[rows, None]
            links[rows] += near @ weights
            links += weights[rows] @ near
            for i, j in zip(*np.nonzero(near), strict=True):
                forest.join(at + int(i), int(j))
        return links, forest.joins

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [table[k].to_numpy(zero_copy_only=False) for k in ("label", "size", "cell", "tile_a", "tile_b")]
        change = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            change |= k[1:] != k[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
        names, vectors = table["entry"].to_pylist(), table["vector"]
        weights, home = table["n"].to_numpy(), table["home"].to_numpy(zero_copy_only=False)
        own, tiles = table["own_tile"].to_numpy(), table["n_tiles"].to_numpy()
        out: list[tuple] = []
        for a, b in zip(starts, starts[1:], strict=False):
            if b - a < 2 or not home[a:b].any():
                continue
            part = vectors.slice(a, b - a).to_pylist()
            links, joins = group(names[a:b], part, weights[a:b], home[a:b], own[a:b], keys[3][a], int(tiles[a]))
            out += [(names[a + i], None, int(links[i])) for i in np.flatnonzero(links)]
            out += [(names[a + i], names[a + j], 0) for i, j in joins]
        if out:
            a, b, n = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], ["a", "b", "n"])

    return work


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    target_recall: float = TARGET_RECALL,
    tile: int = TILE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    own = vectors.select(column(vec_id).alias("vec_id"), column(vector).alias("vector"), column(label).cast("string").alias("label"))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("label").isNotNull() & fine & F.exists("vector", lambda v: v != 0)
    entry = F.when(F.coalesce(usable, F.lit(False)), F.md5(F.concat_ws("/", "label", F.col("vector").cast("string"))))
    rows = own.withColumn("entry", entry)
    entries = stored(
        rows.where("entry is not null").groupBy("entry").agg(
            F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("n"), F.min("vec_id").alias("first_id")
        ),
        "entries",
    )
    visited = _visitor(learn(entries, threshold, target_recall), vectors.sparkSession)
    met = entries.select("entry", "label", "vector", "n", F.posexplode(visited("vector")).alias("at", "cell"))
    met = met.select(
        "entry", "label", "vector", "n", "cell", F.size("vector").alias("size"), (F.col("at") == 0).alias("home")
    ).withColumn("key", F.struct("label", "size", "cell"))
    tiled = in_tiles(met, "key", "entry", tile).drop("key")
    found = map_groups(
        tiled, ["label", "size", "cell", "tile_a", "tile_b"], _verifier(threshold), "a string, b string, n long", rows=8192
    )
    found = stored(found, "links")
    parts = components(found.where("b is not null").select("a", "b"))
    linked = stored(parts.select(F.col("node").alias("entry"), "component"), "linked")
    counts = found.where("b is null").groupBy(F.col("a").alias("entry")).agg(F.sum("n").alias("links"))
    named = entries.select("entry", "n", "first_id").join(linked, "entry", "left").join(counts, "entry", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "entry")), "named")
    # Both sides of the join are written tables: the partition of a large component can be split.
    first = stored(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "first_ids")
    classes = stored(
        named.join(first, "component").select(
            F.col("entry").alias("class"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
        ),
        "classes",
    )
    out = rows.select("vec_id", "entry").join(classes, F.col("entry") == F.col("class"), "left")
    alone = F.col("class").isNull()
    out = out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
