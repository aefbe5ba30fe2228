"""Hard negatives by a vertical scan with bounds (operator 11).

Vectors lie in fragments: blocks of some thousand rows, stored column by column with the least and the
greatest value of each dimension. For an anchor, a fragment's columns are read in the order of the
anchor's descending magnitudes. After every few columns each row has a partial score, and what the
remaining columns can add or take at most follows from their least and greatest values. Rows whose
bounds show that they are not wanted leave the candidates; those still there when the last column is
read have their exact score.

Two scans: the first finds each anchor's positives, its best rows of the same label; the second
finds for each of them the best rows of other labels whose score lies in the positive's window. A
fragment gives back what may be among its best few, and a window function takes the best of all.

Scores are exact: columns are read as floating-point numbers of a width at which every partial sum is a
whole number without rounding, or as Python's numbers where none is wide enough. Anchors and fragments
meet in cells of ``GROUP`` fragments and about ``BLOCK`` anchors, dealt by hashes of row numbers: every
anchor meets every fragment, a task holds the fragments of one cell, and no label or id is hot.

Defined results: rows with a null label, a null vector, or a null or non-finite component, scaled or not,
take no part; vectors are compared with those of their own length only; a null id is no anchor and
comes last in ties; repeated ids are rows of their own, and equal scores and ids are ordered by the
row's place in the written fragments; an anchor without positives, and a positive without rows in its
window, give no rows; a score beyond 64 bits counts as the nearest 64-bit number; vectors of any length
are read whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import column, stored

#: Rows of a fragment, fragments and anchors of a cell.
FRAGMENT, GROUP, BLOCK = 4096, 8, 256
#: Columns read between two looks at the bounds.
STEP = 8
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_ROWS = 1 << 20  # more than a fragment has: places are fragment numbers times this and a row's number

FRAGMENTS = "fragment long, dims int, width string, columns binary, ids binary, labels binary, anchors binary"


def _packed(rows: int):
    """Fragments of what a task reads: blocks of columns for each length of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 20
        held: dict[int, list[tuple]] = {}

        def fragment(dims: int, size: int) -> pa.RecordBatch:
            nonlocal number
            ids, labels, anchors, matrix = (np.concatenate(c) for c in zip(*held[dims], strict=True))
            held[dims] = [(ids[size:], labels[size:], anchors[size:], matrix[size:])]
            matrix = matrix[:size]
            width = "f4" if np.abs(matrix).max(initial=0) <= 1 << 24 else "f8"
            columns = np.ascontiguousarray(matrix.T).astype(f"<{width}").tobytes()
            row = [number, dims, width, columns, ids[:size].tobytes(), labels[:size].tobytes(), anchors[:size].tobytes()]
            number += 1
            kinds = [pa.int64(), pa.int32(), pa.string(), *[pa.binary()] * 4]
            names = [n.split()[0] for n in FRAGMENTS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            ids, labels, anchors, lists = batch.columns
            # Ids and whether they are null, side by side.
            ids = np.stack([ids.fill_null(0).to_numpy(), np.asarray(ids.is_null())], axis=1).astype(np.int64)
            labels, anchors = labels.to_numpy(), anchors.to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            for dims in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dims)
                matrix = np.floor(flat[starts[own][:, None] + np.arange(dims)]) if dims else np.empty((len(own), 0))
                held.setdefault(dims, []).append((ids[own], labels[own], anchors[own], matrix))
                while (count := sum(len(h[0]) for h in held[dims])) >= rows:
                    yield fragment(dims, rows)
        for dims in held:
            if count := sum(len(h[0]) for h in held[dims]):
                yield fragment(dims, count)

    return run


class Fragment:
    """Columns of some rows, with the least and greatest value of each."""

    def __init__(self, number: int, dims: int, width: str, columns: bytes, ids: bytes, labels: bytes, anchors: bytes):
        self.ids, null_ids = np.frombuffer(ids, np.int64).reshape(-1, 2).T
        self.null_ids = null_ids.astype(bool)
        self.labels = np.frombuffer(labels, np.int64)
        self.anchors = np.flatnonzero(np.frombuffer(anchors, bool))
        n = len(self.ids)
        self.places = number * _ROWS + np.arange(n)
        self.columns = np.frombuffer(columns, f"<{width}").reshape(dims, n)
        self.low = self.columns.min(axis=1).astype(np.float64)
        self.high = self.columns.max(axis=1).astype(np.float64)
        self._wide: dict[str, np.ndarray] = {}

    def exact(self, anchor: np.ndarray) -> np.ndarray:
        """The columns in the narrowest kind in which no partial sum with ``anchor`` is rounded."""
        most = float(np.abs(anchor) @ np.maximum(np.abs(self.low), np.abs(self.high)))
        kind = "f4" if most < 1 << 23 and np.abs(anchor).max(initial=0) < 1 << 23 else "f8" if most < 1 << 52 else "O"
        if kind == self.columns.dtype.str[1:]:
            return self.columns
        if kind not in self._wide:
            wide = self.columns.astype(np.float64)
            # Python's whole numbers, of any size.
            self._wide[kind] = wide if kind == "f8" else np.frompyfunc(int, 1, 1)(wide) if kind == "O" else wide.astype("f4")
        return self._wide[kind]

    def scan(self, anchor: np.ndarray, rows: np.ndarray, narrowed) -> tuple[np.ndarray, np.ndarray]:
        """Candidates that are left of ``rows``, and their scores with ``anchor``.

        ``narrowed(rows, low, high)`` gives the mask of candidates to keep, from bounds of their scores.
        """
        columns = self.exact(anchor)
        whole = columns.dtype == object
        weights = np.frompyfunc(int, 1, 1)(anchor) if whole else anchor.astype(columns.dtype)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])
        least, greatest = ends.min(axis=0)[order], ends.max(axis=0)[order]
        # What the columns from each place on can take and add.
        take = np.append(np.cumsum(least[::-1])[::-1], 0.0)
        add = np.append(np.cumsum(greatest[::-1])[::-1], 0.0)
        scores = np.zeros(len(rows), object if whole else columns.dtype)
        all_rows = len(rows) == columns.shape[1]
        for at in range(0, len(order), STEP):
            now = order[at : at + STEP]
            part = columns[now] if all_rows else columns[now[:, None], rows]
            scores = scores + (weights[now] @ part if len(rows) else 0)
            after = min(at + STEP, len(order))
            known = scores.astype(np.float64)
            slack = 0.0 if not whole else 1e-9 * (np.abs(known) + add[after] - take[after])
            low, high = known + take[after] - slack, known + add[after] + slack
            keep = narrowed(rows, np.clip(low, float(_LEAST), float(_MOST)), np.clip(high, float(_LEAST), float(_MOST)))
            if not keep.all():
                rows, scores, all_rows = rows[keep], scores[keep], False
            if not len(rows):
                break
        # Scores beyond 64 bits count as the nearest number of 64 bits.
        return rows, np.frompyfunc(lambda s: max(_LEAST, min(_MOST, s)), 1, 1)(scores) if whole else scores

    def first(self, rows: np.ndarray, scores: np.ndarray, most: int) -> list[tuple]:
        """(score, id, place) of the first rows: higher scores, then smaller ids, null ids last."""
        if len(rows) > most and scores.dtype != object:
            cut = np.partition(scores, len(rows) - most)[len(rows) - most]
            near = np.flatnonzero(scores >= cut)
            rows, scores = rows[near], scores[near]
        found = [
            (int(s), None if self.null_ids[r] else int(self.ids[r]), int(self.places[r]))
            for r, s in zip(rows.tolist(), scores.tolist(), strict=True)
        ]
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0, f[2]))[:most]


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th greatest value; minus infinity if there are less."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def positives_in(fragment: Fragment, anchor: np.ndarray, label: int, place: int, most: int) -> list[tuple]:
    """The first ``most`` rows of the anchor's label, without the anchor's own."""
    rows = np.flatnonzero((fragment.labels == label) & (fragment.places != place))
    rows, scores = fragment.scan(anchor, rows, lambda rows, low, high: high >= _kth(low, most))
    return fragment.first(rows, scores, most)


def negatives_in(fragment: Fragment, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], most: int) -> list[list[tuple]]:
    """For each window (least, greatest score), the first ``most`` rows of other labels in it."""
    rows = np.flatnonzero(fragment.labels != label)
    least = np.array([float(w[0]) for w in windows])[:, None]
    greatest = np.array([float(w[1]) for w in windows])[:, None]

    def narrowed(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        possible = (high >= least) & (low <= greatest)
        certain = (low >= least) & (high <= greatest)
        for w in range(len(windows)):
            possible[w] &= high >= _kth(low[certain[w]], most)
        return possible.any(axis=0)

    rows, scores = fragment.scan(anchor, rows, narrowed)
    out = []
    for low, high in windows:
        inside = np.flatnonzero((scores >= low) & (scores <= high)) if len(rows) else np.empty(0, np.int64)
        out.append(fragment.first(rows[inside], scores[inside], most))
    return out


def window_of(positive: int, low: int, high: int = 100) -> tuple[int, int] | None:
    """Scores n with low * positive <= 100 * n <= high * positive; None if there are none."""
    least, greatest = -(-low * positive // 100), high * positive // 100
    return (least, greatest) if least <= greatest else None


_FOUND = "anchor long, positive int, score long, vec_id long, place long"


def _scanned(most: int, low: int, high: int):
    """What each fragment of a cell has for each of its anchors. Rows come cell by cell, fragments
    first; an anchor with scores asks for the rows in their windows, one without for its positives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fragments = None, []
        for batch in batches:
            out = []
            for row in zip(*batch.columns, strict=True):
                dims, group, block, *fields, place, label, vector, scores = (f.as_py() for f in row)
                if cell != (dims, group, block):
                    cell, fragments = (dims, group, block), []
                if place is None:
                    fragments.append(Fragment(fields[0], dims, *fields[1:]))
                    continue
                anchor = np.frombuffer(vector, "<f8")
                windows = {n: w for n, s in enumerate(scores or (), 1) if (w := window_of(s, low, high))}
                for fragment in fragments:
                    if scores is None:
                        out.extend((place, 0, *f) for f in positives_in(fragment, anchor, label, place, most))
                    elif windows:
                        each = negatives_in(fragment, anchor, label, list(windows.values()), most)
                        out.extend((place, n, *f) for n, found in zip(windows, each, strict=True) for f in found)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3]
            columns = list(zip(*out, strict=True)) or [()] * 5
            names = [n.split()[0] for n in _FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, dims, vec_id, label, vector) of the anchors in fragments."""
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            number, dims, *fields = (f.as_py() for f in row)
            found = Fragment(number, dims, *fields)
            at = found.anchors
            vectors = np.ascontiguousarray(found.columns[:, at].T.astype("<f8"))
            columns = [
                pa.array(found.places[at]), pa.array(np.full(len(at), dims, np.int32)), pa.array(found.ids[at]), pa.array(found.labels[at]),
                pa.array([v.tobytes() for v in vectors], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["place", "dims", "vec_id", "label", "vector"])


def _scan(fragments: DataFrame, anchors: DataFrame, most: int, low: int = 0, high: int = 0) -> DataFrame:
    """Bring every anchor (place, dims, label, vector, scores) to every fragment of its length, cell by
    cell, and take the first rows of all for each anchor and positive."""
    n_groups = fragments.groupBy("dims").agg(F.ceil(F.count("*") / GROUP).alias("n_groups"))
    n_blocks = anchors.groupBy("dims").agg(F.ceil(F.count("*") / BLOCK).alias("n_blocks"))
    sizes = stored(n_groups.join(n_blocks, "dims"), "cells")
    one = F.lit(1).cast("long")

    def dealt(rows: DataFrame, key: str, own: str, other: str) -> DataFrame:
        cells = {"group": "n_groups", "block": "n_blocks"}
        own_number = F.pmod(F.xxhash64(key), F.greatest(one, F.col(cells[own]))).alias(own)
        others = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(one, F.col(cells[other])) - 1)).alias(other)
        return rows.join(sizes, "dims").select("*", own_number, others).drop("n_groups", "n_blocks")

    left = dealt(fragments, "fragment", "group", "block")
    right = dealt(anchors.select("place", "dims", "label", "vector", "scores"), "place", "block", "group")
    both = left.unionByName(right, allowMissingColumns=True)
    order = ["dims", "group", "block"]
    both = both.select(*order, "fragment", "width", "columns", "ids", "labels", "anchors", "place", "label", "vector", "scores")
    rows = both.repartition(*order).sortWithinPartitions(*order, F.col("place").asc_nulls_first())
    found = rows.mapInArrow(_scanned(most, low, high), _FOUND)
    by = Window.partitionBy("anchor", "positive").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "place")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100,
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, fragment: int = FRAGMENT,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components are ``floor(scale * x)``; a score is an inner product. For each anchor and each of its
    first ``positives`` rows of the same label, the first ``negatives`` rows of another label whose
    score is from ``low`` to ``high`` percent of the positive's.
    """
    rows = vectors.select(
        column(vec_id).cast("long").alias("vec_id"), column(label).cast("long").alias("label"),
        F.transform(column(vector), lambda x: x.cast("double") * scale).alias("parts"),
    )
    usable = F.forall("parts", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("label").isNotNull() & F.col("parts").isNotNull() & usable)
    is_anchor = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    rows = rows.select("vec_id", "label", is_anchor.alias("is_anchor"), "parts")
    fragments = stored(rows.mapInArrow(_packed(fragment), FRAGMENTS), "fragments")
    anchors = stored(
        fragments.mapInArrow(_anchor_rows, "place long, dims int, vec_id long, label long, vector binary"), "anchors"
    )
    none = F.lit(None).cast("array<long>")
    best = stored(_scan(fragments, anchors.withColumn("scores", none), positives), "positives")
    lists = best.groupBy("anchor").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"]).alias("scores")
    )
    asking = stored(anchors.join(lists, F.col("place") == F.col("anchor")).drop("anchor"), "asking")
    found = stored(_scan(fragments, asking, negatives, low, high), "negatives")
    of = best.select(
        F.col("anchor").alias("of_anchor"), F.col("rank").alias("of_rank"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    named = anchors.select(F.col("place").alias("anchor_place"), F.col("vec_id").alias("anchor_id"))
    joined = found.join(of, (F.col("anchor") == F.col("of_anchor")) & (F.col("positive") == F.col("of_rank")))
    return joined.join(named, F.col("anchor") == F.col("anchor_place")).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
