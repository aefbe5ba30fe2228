"""Helpers of the operators: written tables, complete groups in tasks, connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only in local mode without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage ends there, a lost
    executor costs nothing, and Spark knows the size for its join choices."""
    path = new_path(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Remove written tables whose results are written too, and let Spark drop shuffle files that
    nothing refers to any more: the driver's collector is what tells it."""
    for table in tables:
        spark = table.sparkSession
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        folder = shared_folder(spark)
        for parent in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(parent)
            if path.toUri().getPath().startswith(jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath() + "/"):
                path.getFileSystem(conf).delete(path, True)
    if tables:
        gc.collect()
        tables[0].sparkSession._jvm.System.gc()


def column(name: str):
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_groups(
    df: DataFrame,
    keys: list[str],
    work: Callable[[pa.Table], Iterator[pa.RecordBatch]],
    schema: str,
    rows: int = 65536,
) -> DataFrame:
    """Deal rows by ``keys``, sort them, and call ``work`` with tables of whole groups in order.

    A call gets many small groups at once, about ``rows`` rows, so that work can be done on
    arrays. No group is cut, so groups must be of bounded size: see ``in_tiles``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            count += batch.num_rows
            if count < rows:
                continue
            table = pa.Table.from_batches(held)
            cut = _last_start(table, keys)
            if cut:
                yield from work(table.slice(0, cut).combine_chunks())
            rest = table.slice(cut).combine_chunks()
            held, count = rest.to_batches(), rest.num_rows if cut else 0
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _last_start(table: pa.Table, keys: list[str]) -> int:
    """Row at which the last group of a sorted table begins."""
    low, high = 0, table.num_rows - 1
    last = [table.column(k)[high] for k in keys]
    while low < high:
        middle = (low + high) // 2
        if [table.column(k)[middle] for k in keys] == last:
            high = middle
        else:
            low = middle + 1
    return low


def in_tiles(df: DataFrame, key: str, member: str, tile: int) -> DataFrame:
    """Rows with ``tile_a``, ``tile_b``, ``own_tile`` and ``n_tiles``, so that groups of any size can
    be compared in pieces.

    A key with up to ``tile`` rows has the one piece (0, 0). A larger one is dealt by the hash of
    ``member`` to tiles of about that size, and each row goes to the pieces (own tile, other
    tile): every two rows of the key meet in a piece.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("n_key")).where(F.col("n_key") > tile)
    large = stored(sizes.select(F.col(key).alias("large_key"), F.ceil(F.col("n_key") / tile).cast("int").alias("n_tiles")), "tiles")
    out = df.join(large, F.col(key) == F.col("large_key"), "left").drop("large_key")
    n_tiles = F.coalesce("n_tiles", F.lit(1))
    own = F.pmod(F.xxhash64(member, F.lit(11)), n_tiles).cast("int")
    out = out.withColumn("own_tile", own).withColumn("n_tiles", n_tiles)
    others = F.transform(
        F.sequence(F.lit(0), F.col("n_tiles") - 1),
        lambda i: F.struct(F.least("own_tile", i).alias("a"), F.greatest("own_tile", i).alias("b")),
    )
    # A piece (i, i) is needed only where a key has one tile: rows of a tile also meet in (i, j).
    pieces = F.filter(others, lambda p: (p["a"] != p["b"]) | (F.col("n_tiles") == 1))
    out = out.withColumn("piece", F.explode(pieces))
    return out.withColumns({"tile_a": F.col("piece.a"), "tile_b": F.col("piece.b")}).drop("piece")


class Forest:
    """Union of the integers below ``n``; keeps the joins that were needed."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.joins: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def roots(self) -> np.ndarray:
        up = np.array(self.up, np.int64)
        while len(up) and (up[up] != up).any():
            up = up[up]
        return up

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.joins.append((i, j))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it is connected to.

    Alternates two steps until nothing changes: every neighbour above a node, then every
    neighbour below it, is tied to the smallest neighbour. Each step is an aggregate with
    partial sums and a join whose sides both come from written tables, so that adaptive
    execution can split the partition of a hot node. Loops and repeated edges are allowed; nodes
    must not be null.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    nodes = pairs.where("a = b").select(F.col("a").alias("node")).distinct()
    now = stored(pairs.where("a < b").distinct(), "edges")
    state = _fingerprint(now)
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m")), "lowest")
        tied = now.join(low, F.col("a") == F.col("u")).select(F.col("m").alias("a"), "b")
        now = stored(tied.where("a < b").distinct(), "edges")
        low = stored(now.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")), "lowest")
        tied = now.join(low, F.col("b") == F.col("u")).select(F.col("m").alias("a"), F.col("a").alias("b"))
        tied = tied.where("a < b").unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
        now = stored(tied.distinct(), "edges")
        before, state = state, _fingerprint(now)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    ends = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = now.select(F.col("a").alias("node")).unionByName(nodes.select("node")).distinct()
    roots = roots.join(ends.select("node"), "node", "left_anti")
    return ends.unionByName(roots.select("node", F.col("node").alias("component")))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30)))
    ).first()
    return tuple(row)
