"""Extra columns with clashing names, nulls in every column, repeated rows: no operator minds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from inkmill.llm import decontam, langid, lmscore, neardup, packing, pii, quality, sharding, substrings, tokencount

CLASH = ("part", "row", "text_hash", "n", "fp1", "nodes", "rep", "root", "gone_id", "leak_id", "good_id", "target", "size", "salt", "shard", "slot", "word_chars", "kept", "spans", "bucket", "item_id", "length", "piece", "w", "common")
PROSE = "the quick brown fox jumps over the lazy dog and then it goes on to say that nothing of this was ever meant to be kept in the house for long "
TEXTS = [(1, PROSE * 3), (2, PROSE * 3), (None, PROSE * 3), (3, None), (None, None), (4, ""), (1, PROSE * 3), (5, "mail a@b.de " + " ".join(f"odd{i}" for i in range(60)) + ". " + PROSE)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 2 else "en", None if k % 3 else "s", None) for k, (i, t) in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *(F.lit(f"{c}!").alias(c) for c in CLASH))


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(7, PROSE), (None, PROSE), (8, None)], "item_id long, text string")


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


ALL = sorted((i for i, _ in TEXTS), key=str)


def test_operators_that_report(docs, bench, spark):
    path = packing.default_tokenizer()
    assert ids(packing.pack_documents(docs, path)) == ALL
    assert ids(langid.identify(docs, langid.learn(docs))) == ALL
    assert ids(pii.find_pii(docs)) == ALL
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    assert ids(lmscore.score(docs, lmscore.good_documents(labels))) == ALL
    assert ids(substrings.remove_repeats(docs)) == ALL
    assert ids(quality.assess(docs)) == ALL
    import public_tokenizers

    assert ids(tokencount.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))) == ALL
    shards = sharding.shard(docs)
    assert ids(shards) == ALL
    for _, rows in shards.toPandas().groupby("shard"):
        assert sorted(rows.slot) == list(range(len(rows)))
    leaks = decontam.find_leaks(docs, bench).collect()
    assert {r.doc_id for r in leaks} == {1, 2, None, 5} and {r.item_id for r in leaks} == {7}


def test_near_duplicates_with_null_ids(docs):
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.components(docs, 3, 0.85).collect()), key=str)
    want = [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (None, None, True), (None, None, True)]
    assert got == sorted(want, key=str)


def test_stages_keep_all_columns(docs, bench):
    for df in (quality.keep_documents(docs), neardup.drop_near_duplicates(docs), decontam.drop_leaks(docs, bench), pii.redact(docs, lengths="n_chars")):
        assert df.columns == docs.columns
        assert all(r.part == "part!" and r.leak_id == "leak_id!" for r in df.collect())
    assert ids(decontam.drop_leaks(docs, bench)) == sorted([3, 4, None], key=str)
    assert ids(neardup.drop_near_duplicates(docs)) == sorted([1, 1, 3, 4, 5, None, None], key=str)
