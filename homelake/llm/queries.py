"""One query for each operator, over its whole table and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, language_id, markov, mixing, negatives, packing, phrases, preferences, simhash, spans, spotsigs, templates, warc

from .oracle import SQL


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary() -> str:
    """Path of the tokenizer file, which every machine has."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark, folder):
    """Every use of a document in a mix of as many tokens as there are, no source passed over twice as often."""
    return mixing.schedule(table(spark, folder, "documents"), max_repeats=1.5)


def op2_packing(spark, folder):
    pieces = packing.pack(table(spark, folder, "documents"), vocabulary())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_length"
    )


def op3_warc(spark, folder):
    return warc.round_trip(table(spark, folder, "pages")).drop("uri")


def op4_secrets(spark, folder):
    found = markov.find_secrets(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(markov.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        markov.written(F.col("spans")).alias("spans"),
    )


def op5_language(spark, folder):
    return language_id.identify(table(spark, folder, "documents"))


def op6_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_embeddings(spark, folder):
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op8_spotsigs(spark, folder):
    return spotsigs.against_edits(table(spark, folder, "documents"))


def op9_spans(spark, folder):
    return spans.digests(table(spark, folder, "documents"))


def op10_preferences(spark, folder):
    """Each conversation against the same one whose last answer only repeats the turn before."""
    pairs = preferences.format_pairs(preferences.echo_pairs(table(spark, folder, "conversations")))
    shown = lambda mask: F.array_join(
        F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return pairs.select(
        F.col("pair_id").alias("conv_id"),
        "prompt_turns",
        "prompt",
        "chosen",
        "rejected",
        shown("chosen_mask").alias("chosen_mask"),
        shown("rejected_mask").alias("rejected_mask"),
    )


def op11_negatives(spark, folder):
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", label))


def op12_phrases(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"))


def op13_templates(spark, folder):
    return templates.main_texts(table(spark, folder, "pages"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_warc": op3_warc,
    "op4_secrets": op4_secrets,
    "op5_language": op5_language,
    "op6_simhash": op6_simhash,
    "op7_embeddings": op7_embeddings,
    "op8_spotsigs": op8_spotsigs,
    "op9_spans": op9_spans,
    "op10_preferences": op10_preferences,
    "op11_negatives": op11_negatives,
    "op12_phrases": op12_phrases,
    "op13_templates": op13_templates,
}

ORACLE: dict[str, str] = dict(SQL)
