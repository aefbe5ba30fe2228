"""Phrase collocations by partitioned mining (operator 12).

Texts are mined in shards: some million words of one language that one task reads. A shard is mined
completely, phrases of all lengths, at a local support lowered in proportion to its share of the
language's bytes. A phrase that is frequent over all is locally frequent in one shard at least (if it
had at most (min_count - 1) x share occurrences in each, it would have at most min_count - 1). The
phrases that are locally frequent anywhere are the candidates, and each candidate is counted exactly
over all shards.

Shards send their phrases with local counts, dealt by a hash of the phrase into buckets whose number
grows with the input, in one compressed block for each bucket: locally frequent ones, whose union are
the bucket's candidates, and the rest, which is counted where it is a candidate of another shard. With
many shards the local support is 1 and there is no rest. A phrase sends one count for each shard, so a
word that is a third of all words is not hot.

Scores and the choice among them are joins and aggregates over the counts.

Defined results: null texts have no words; a null language is ``und`` and the same as that; repeated rows
count again; texts of any length are read whole; ties end with the phrase's bytes; arithmetic is exact for
counts below 10 ** 15; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import column, stored

MIN_COUNT = 10
LONGEST = 3
#: Words, breaks between pieces among them, after which a task mines its shards, and bytes of text for each bucket of phrases.
SHARD_WORDS, BUCKET_BYTES = 1 << 20, 4 << 20
_BREAK = b"\xff"  # in no UTF-8 text
_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)
_COUNTED = pa.schema([("phrase", pa.binary()), ("n", pa.int64())])


def words_of(text: str) -> list[bytes]:
    """Words, lower-case in A to Z, with a break between pieces and at the end."""
    content = text.encode("utf-8", "surrogatepass").lower().translate(_PIECES)
    words = content.replace(_BREAK, b" \xff ").split()
    words.append(_BREAK)
    return words


class Shard:
    """Texts of one language as numbers of words; 0 is a break."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.vocabulary[_BREAK]
        self.texts: list[np.ndarray] = []
        self.words = self.bytes = 0

    def add(self, text: str) -> None:
        words = words_of(text)
        self.texts.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words)))
        self.words += len(words)
        self.bytes += len(text.encode("utf-8", "surrogatepass"))

    def mined(self, longest: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """Phrases of 1 to ``longest`` words, their hashes and their counts; at last the empty one, which
        counts all words."""
        from xxhash import xxh3_64_intdigest

        ids = np.concatenate(self.texts)
        names = pa.array(list(self.vocabulary), pa.binary())
        word_hash = np.array([xxh3_64_intdigest(w) for w in self.vocabulary], np.uint64)
        size = len(names)
        # Of each level: the distinct phrases, and at each place the number of the one that starts there.
        counts = np.bincount(ids, minlength=size)
        phrases, hashes, at = names, word_hash, ids
        known = np.flatnonzero(counts)
        known = known[known > 0]
        yield phrases.take(pa.array(known)), hashes[known], counts[known]
        whole = ids > 0
        for length in range(2, longest + 1):
            if len(ids) < length:
                break
            whole = whole[:-1] & (ids[length - 1 :] > 0)
            places = np.flatnonzero(whole)
            keys, inverse, counts = np.unique(at[places] * size + ids[places + length - 1], return_inverse=True, return_counts=True)
            if not len(keys):
                break
            before, last = keys // size, keys % size
            phrases = pc.binary_join_element_wise(phrases.take(pa.array(before)), names.take(pa.array(last)), b" ")
            hashes = _mixed(hashes[before] * np.uint64(0x9E3779B97F4A7C15) + word_hash[last])
            at = np.zeros(len(whole), np.int64)
            at[places] = inverse
            yield phrases, hashes, counts
        yield pa.array([b""], pa.binary()), np.zeros(1, np.uint64), np.array([int((ids > 0).sum())])


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = hashes ^ (hashes >> np.uint64(31))
    hashes = hashes * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def _block(phrases: pa.Array, counts: np.ndarray) -> bytes | None:
    if not len(phrases):
        return None
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, _COUNTED, options=options) as writer:
        writer.write_batch(pa.record_batch([phrases, pa.array(counts, pa.int64())], schema=_COUNTED))
    return sink.getvalue().to_pybytes()


def _read(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


_BLOCKS = "lang string, bucket long, frequent binary, rest binary"


def _mine(longest: int, min_count: int, buckets: int, shard_words: int):
    """Blocks of counted phrases of the shards of a task."""

    def blocks(lang: str, shard: Shard, total: int) -> Iterator[pa.RecordBatch]:
        # Of all occurrences that a phrase may have without being frequent, the shard's part.
        support = (min_count - 1) * shard.bytes // max(total, 1) + 1
        parts = defaultdict(list)
        for phrases, hashes, counts in shard.mined(longest):
            if not len(phrases):
                continue
            bucket = (_mixed(hashes) % np.uint64(buckets)).astype(np.int64)
            often = (counts >= support) | (pc.binary_length(phrases).to_numpy() == 0)
            order = np.argsort(bucket * 2 + often, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order] * 2 + often[order], prepend=-1))
            phrases, counts, bucket, often = phrases.take(pa.array(order)), counts[order], bucket[order], often[order]
            for start, end in zip(edges, [*edges[1:], len(order)], strict=True):
                parts[int(bucket[start]), bool(often[start])].append((phrases.slice(start, end - start), counts[start:end]))
        rows = {}
        for (number, frequent), own in parts.items():
            block = _block(pa.concat_arrays([p for p, _ in own]), np.concatenate([c for _, c in own]))
            rows.setdefault(number, [None, None])[0 if frequent else 1] = block
        columns = [[lang] * len(rows), list(rows), [r[0] for r in rows.values()], [r[1] for r in rows.values()]]
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
        names = ["lang", "bucket", "frequent", "rest"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, Shard] = defaultdict(Shard)
        totals: dict[str, int] = {}
        for batch in batches:
            for lang, text, total in zip(*batch.columns, strict=True):
                lang = lang.as_py()
                shards[lang].add(text.as_py())
                totals[lang] = total.as_py()
                if sum(s.words for s in shards.values()) >= shard_words:
                    for lang in list(shards):
                        yield from blocks(lang, shards.pop(lang), totals[lang])
        for lang in list(shards):
            yield from blocks(lang, shards.pop(lang), totals[lang])

    return run


def _counted(frequent: list[bytes], rest: list[bytes], min_count: int) -> tuple[pa.Array, pa.Array]:
    """Exact counts of a bucket's candidates: the phrases that some shard found frequent."""
    sure = pa.concat_tables([_read(b) for b in frequent])
    tables = [sure]
    if rest:
        others = pa.concat_tables([_read(b) for b in rest])
        tables.append(others.filter(pc.is_in(others["phrase"], sure["phrase"].unique())))
    sums = pa.concat_tables(tables).group_by("phrase").aggregate([("n", "sum")])
    kept = sums.filter(pc.or_(pc.greater_equal(sums["n_sum"], min_count), pc.equal(pc.binary_length(sums["phrase"]), 0)))
    return kept["phrase"].combine_chunks(), kept["n_sum"].combine_chunks()


def _count(min_count: int):
    """(lang, phrase, words, f) from blocks that come bucket by bucket and language by language."""

    def out(lang: str, frequent: list[bytes], rest: list[bytes]) -> pa.RecordBatch:
        phrases, counts = _counted(frequent, rest, min_count)
        words = pc.add(pc.count_substring(phrases.cast(pa.string()), " "), 1)
        words = pc.if_else(pc.equal(pc.binary_length(phrases), 0), 0, words).cast(pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), phrases.cast(pa.string()), words, counts], ["lang", "phrase", "words", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, frequent, rest = None, [], []
        for batch in batches:
            for bucket, lang, often, seldom in zip(*batch.columns, strict=True):
                key = (bucket.as_py(), lang.as_py())
                if key != now:
                    if frequent:
                        yield out(now[1], frequent, rest)
                    now, frequent, rest = key, [], []
                if often.is_valid:
                    frequent.append(often.as_py())
                if seldom.is_valid:
                    rest.append(seldom.as_py())
        if frequent:
            yield out(now[1], frequent, rest)

    return run


def phrase_counts(
    docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, longest: int = LONGEST,
    shard_words: int = SHARD_WORDS, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(lang, phrase, words, f) of all phrases with ``min_count`` occurrences or more, and for each language
    the empty phrase with 0 words and the number of all words."""
    rows = docs.select(F.coalesce(column(lang).cast("string"), F.lit("und")).alias("lang"), column(text).alias("text"))
    rows = rows.where(F.col("text") != "")
    totals = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("total"))
    totals = stored(totals.withColumnRenamed("lang", "total_lang"), "languages")
    all_bytes = totals.agg(F.sum("total")).first()[0] or 0
    known = rows.join(totals, F.col("lang") == F.col("total_lang")).select("lang", "text", "total")
    blocks = known.mapInArrow(_mine(longest, min_count, max(1, -(-all_bytes // bucket_bytes)), shard_words), _BLOCKS)
    dealt = blocks.repartition("bucket").sortWithinPartitions("bucket", "lang").select("bucket", "lang", "frequent", "rest")
    return dealt.mapInArrow(_count(min_count), "lang string, phrase string, words int, f long")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, longest: int = LONGEST,
    covered: int = 50, top: int = 2000, shard_words: int = SHARD_WORDS, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top`` collocations.

    A phrase of two words or more scores ``10 ** 6 * a * a / (l * r)``, rounded down, at its worst cut.
    It is dropped if a longer frequent phrase that holds it has ``covered`` percent of its occurrences.
    """
    counts = stored(phrase_counts(docs, lang, text, min_count, longest, shard_words, bucket_bytes), "phrases")
    candidates = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    parts = F.split("phrase", " ")
    cut = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    of = lambda name, f: counts.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(f"{name}_part"), F.col("f").alias(f))
    scored = cut.join(of("l", "l"), (F.col("lang") == F.col("l_lang")) & (F.col("first") == F.col("l_part")))
    scored = scored.join(of("r", "r"), (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("r_part")))
    # Decimals of 38 digits hold every product of counts below 10 ** 15.
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in "alr")
    products = scored.select("lang", "phrase", "a", "k", "l", "r", (F.lit(1_000_000).cast("decimal(7,0)") * (a * a)).alias("top"), (l * r).alias("bottom"))
    worst = products.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("top div bottom").alias("score"), "k", "l", "r")).alias("cut"))

    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice(parts, i, n), " ")),
        )
    )
    held = candidates.where("words > 2").select(F.col("lang").alias("held_lang"), F.explode(F.array_distinct(spans)).alias("held"), "a")
    held = held.groupBy("held_lang", "held").agg(F.max("a").alias("longer"))
    kept = worst.join(held, (F.col("lang") == F.col("held_lang")) & (F.col("phrase") == F.col("held")), "left")
    kept = kept.where(F.coalesce(F.col("longer") * 100 < F.col("a") * covered, F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = counts.where("words = 0").select(F.col("lang").alias("n_lang"), F.col("f").alias("n"))
    return first.join(sizes, F.col("lang") == F.col("n_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
