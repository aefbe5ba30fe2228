"""Language identification by compression (operator 5).

The whole text is cut into pieces of equal size, and each is encoded once per language by zstandard
with that language's raw-content dictionary; the language with the smallest sum of encodings wins.
Pieces are short, so that every part of a text meets the dictionary and not what came before it:
beyond one piece neither margin nor winner depends on the length. Where the winner's margin over
the second is narrow, the document is marked as rejected.

Defined results: null text and text without a letter are ``und`` with score 0; ties go to the
language first in order; without any learned language all are ``und``; with only one, it wins
with score 1. Extra columns of the input are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import column, stored

UNKNOWN = "und"
#: Bytes of the dictionary of each language: the bound of the sample that is learned from.
DICTIONARY_BYTES = 131072
#: Bytes of one document that may enter a dictionary, so that many documents do.
DOCUMENT_BYTES = 4096
#: Most bytes of normal form that are encoded at once; longer texts are several pieces.
PIECE_BYTES = 4096
#: Relative margin below which a prediction is rejected: in short texts, a tie.
MIN_MARGIN = 0.003
#: The margin that counts as certain.
FULL_MARGIN = 0.25

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normal_form(text: str) -> str:
    """Lower case, letters alone, one space between words."""
    return _NOT_LETTERS.sub(" ", text.lower())


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: CRC-32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    dictionary_bytes: int = DICTIONARY_BYTES,
    document_bytes: int = DOCUMENT_BYTES,
) -> dict[str, bytes]:
    """Raw-content dictionaries by language, from a bounded sample of labelled rows.

    ``4 * dictionary_bytes / document_bytes`` documents per language are looked at in order of a
    hash of their text, copies counting once; counts of distinct texts give the share to read. What
    reaches the driver is bounded by that times ``document_bytes`` for each language.
    """
    rows = docs.select(column(text).alias("text"), column(lang).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    wanted = 4 * dictionary_bytes // document_bytes
    # A written table: its size is known, so that the texts are not exchanged by language.
    mark = F.xxhash64("text")
    counts = stored(rows.select("lang", mark.alias("mark")).distinct().groupBy("lang").agg(F.count("*").alias("n")), "languages")
    place = F.pmod(mark, F.lit(1 << 40)) / float(1 << 40)
    near = rows.join(counts, "lang").withColumn("place", place).where(F.col("place") <= 2.0 * wanted / F.col("n"))
    ranked = near.select("lang", "place", F.substring("text", 1, document_bytes).alias("text")).groupBy("lang").agg(
        F.slice(F.array_sort(F.collect_set(F.struct("place", "text"))), 1, wanted).alias("sample")
    )
    out = {}
    for row in ranked.orderBy("lang").toLocalIterator():
        texts = (normal_form(s.text).strip().encode()[:document_bytes] for s in row["sample"])
        out[row["lang"]] = b"\n".join(texts)[:dictionary_bytes]
    return out


def _encoders(dictionaries: dict[str, bytes]):
    import zstandard as z

    settings = z.ZstdCompressionParameters(
        window_log=19, chain_log=16, hash_log=17, search_log=3, min_match=4, strategy=z.STRATEGY_GREEDY
    )
    out = []
    for lang, content in sorted(dictionaries.items()):
        words = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=settings)
        out.append((lang, z.ZstdCompressor(dict_data=words)))
    return out


def pieces(content: bytes, piece_bytes: int = PIECE_BYTES) -> list[bytes]:
    """All of the content, in pieces of one size (the last may be a little shorter)."""
    width = -(-len(content) // -(-len(content) // piece_bytes)) if content else 1
    return [content[i : i + width] for i in range(0, len(content), width)]


def classify(text: str | None, encoders, min_margin: float) -> tuple[str, float, bool]:
    if text is None or not encoders or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, False
    parts = pieces(normal_form(text).encode())
    sizes = sorted((sum(len(encoder.compress(p)) for p in parts), i) for i, (_, encoder) in enumerate(encoders))
    best = encoders[sizes[0][1]][0]
    if len(sizes) == 1:
        return best, 1.0, True
    margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
    return best, min(1.0, margin / FULL_MARGIN), margin >= min_margin


def predictor(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN):
    """A column function: text to (lang_pred, score, accepted)."""
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = _encoders(sent.value)
        for texts in batches:
            rows = [classify(t, encoders, min_margin) for t in texts]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "accepted"])

    return predict


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", min_margin: float = MIN_MARGIN
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) for every row, learned from the others."""
    known = docs.where(column(doc_id).isNotNull() & ~held_out(column(doc_id)))
    predict = predictor(docs, learn(known, text, lang), min_margin)
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    out = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.accepted")


def keep_identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose language is identified with enough margin, all columns unchanged."""
    known = docs.where(column(doc_id).isNotNull() & ~held_out(column(doc_id)))
    predict = predictor(docs, learn(known, text, lang))
    return docs.where(predict(column(text))["accepted"])
