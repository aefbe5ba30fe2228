"""Registered queries of the operators, and the pipeline stage by stage against brute force."""

import collections

import pytest
from compare import difference
from pyspark.sql import functions as F
from test_operators import base_spans, check_packing, slow_components, slow_fingerprint

import __spark_entry__ as entry
import corpus_pipeline
from homelake.llm import language_id, packing
from homelake.llm.oracle import SQL
from homelake.llm.queries import QUERIES, table, vocabulary

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", list(SQL))
def test_query_against_sql(spark, name):
    assert difference(spark, FOLDER, QUERIES[name], SQL[name]) is None


def test_fingerprints_and_components_of_the_table(spark):
    docs = table(spark, FOLDER, "documents").orderBy("doc_id").collect()
    prints = [slow_fingerprint(r.text) for r in docs]
    want = slow_components(prints, [r.doc_id for r in docs])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op6_simhash"](spark, FOLDER).collect()}
    assert got == {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(docs, prints, want, strict=True)}


def test_secrets_of_the_table(spark):
    import hashlib

    docs = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    for r in QUERIES["op4_secrets"](spark, FOLDER).collect():
        spans = base_spans(docs[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert r.n_assign + r.n_access + r.n_hex == len(spans.split(",")) * bool(spans)
        assert set(filter(None, spans.split(","))) <= set(r.spans.split(","))


def test_languages_of_the_table(spark):
    got = QUERIES["op5_language"](spark, "/root/testdata/sf0.01")
    truth = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out and lang is not null and lang_pred <> 'und'")
    right, n = held.select(F.avg(F.expr("int(lang = lang_pred)")), F.count("*")).first()
    assert n > 100 and right > 0.96


@pytest.fixture(scope="module")
def joined(spark):
    """Dictionaries of the table and, by language, all its distinct texts as one."""
    docs = table(spark, "/root/testdata/sf0.1", "documents").where("text is not null")
    texts = collections.defaultdict(set)
    for r in docs.select("lang", "text").collect():
        texts[r.lang].add(r.text)
    return language_id._encoders(language_id.learn(docs)), {k: " ".join(sorted(v)) for k, v in texts.items()}


def test_clean_long_texts_are_accepted(joined):
    encoders, texts = joined
    for lang in ("en", "fr", "de", "es"):
        whole = language_id.classify(texts[lang], encoders, language_id.MIN_MARGIN)
        part = language_id.classify(texts[lang][:100_000], encoders, language_id.MIN_MARGIN)
        assert len(texts[lang]) > 2_000_000 and whole[0] == part[0] == lang and whole[2]
        assert 0.75 * part[1] < whole[1] < 1.33 * part[1]


def test_every_part_of_a_text_counts_alike(joined):
    encoders, texts = joined
    for first, then in (("en", "de"), ("fr", "en"), ("de", "fr")):
        for before, after in ((10_000, 30_000), (20_000, 200_000), (20_000, 600_000), (20_000, 2_000_000)):
            parts = [texts[first][:before], texts[then][:after]]
            for order in (parts, parts[::-1]):
                lang_pred, _, accepted = language_id.classify(" ".join(order), encoders, language_id.MIN_MARGIN)
                assert (lang_pred, accepted) == (then, True)


def test_pipeline_by_stage(spark, tmp_path):
    docs, before = table(spark, FOLDER, "documents"), None
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
    first = {r.doc_id: r for r in table(spark, FOLDER, "documents").collect()}
    known = {r.doc_id for r in kept["language_id"].collect()}
    assert all(any(map(str.isalpha, first[d].text or "")) for d in known) and len(known) > 0.97 * len(first)

    ids = sorted(known)
    want = set(slow_components([slow_fingerprint(first[d].text) for d in ids], ids))
    deduped = kept["simhash_dedup"].collect()
    assert sorted(r.doc_id for r in deduped) == sorted(want)
    assert all(r == first[r.doc_id] for r in deduped)

    masked = {r.doc_id: r for r in kept["secret_masking"].collect()}
    assert set(masked) == want
    for d, r in masked.items():
        assert base_spans(r.text or "") == "" and (base_spans(first[d].text or "") != "") <= ("[SECRET]" in r.text)
        assert r.text == first[d].text or r.n_chars == len(r.text)

    mixed = collections.Counter(r.doc_id for r in kept["source_mixing"].collect())
    assert set(mixed) == want and max(mixed.values()) <= 2
    rows = collections.Counter(map(tuple, kept["source_mixing"].collect()))
    assert set(rows) == {tuple(r) for r in masked.values()}

    pieces = kept["packing"].collect()
    tokens = collections.Counter()
    for r in pieces:
        tokens[r.doc_id] += r.length
    sizes = {r.doc_id: r.doc_tokens for r in pieces}
    assert all(tokens[d] == sizes[d] * n for d, n in mixed.items())
    once = kept["secret_masking"]
    texts = {r.doc_id: r.text for r in once.collect()}
    assert check_packing(packing.pack(once, vocabulary()).collect(), texts) > 0.99
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.groupBy("doc_id").agg(F.sum("length")).count() == len(want)
