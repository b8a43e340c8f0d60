from __future__ import annotations

import pandas as pd
from helpers import ODD, documents, frame
from pyspark.sql import functions as F
from test_decontam import verbatim
from test_neardup import brute
from test_packing import check, whole
from test_pii import base
from test_quality import counts

import corpus_pipeline


def test_every_stage_decides_on_what_its_predecessor_kept(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    frames = [documents(sf)]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        frames.append(docs.toPandas())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    raw, good, single, clean, masked, packed = frames
    failed = {r.doc_id for r in raw.itertuples() if counts(r.text)[-1]}
    assert not failed & set(good.doc_id) and len(good) > 0.7 * (len(raw) - len(failed))
    assert set(single.doc_id) == {i for i, (_, _, kept) in brute(dict(zip(good.doc_id, good.text)), 5, 80).items() if kept}
    items = pd.read_parquet(f"{sf}/benchmark.parquet")
    leaks = {d for d, _ in verbatim(zip(single.doc_id, single.text), zip(items.item_id, items.text))}
    assert not leaks & set(clean.doc_id) and len(clean) >= 0.97 * (len(single) - len(leaks))
    assert set(masked.doc_id) == set(clean.doc_id) and not any(base(t) for t in masked.text)
    assert (masked.n_chars == masked.text.str.len()).all()
    check(packed, dict(zip(masked.doc_id, whole(masked.text))))


def through(spark, docs, sf, path):
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        yield docs.toPandas()


PROSE = "The cat sat on the mat and looked at the rain that fell in the garden, for it was a long day with little to do. Nobody knew what the old man had wanted to say when he left the house in the morning. "


def prose(mark):
    """Some 160 words that no other mark's text shares a shingle with."""
    return " ".join(w if i % 3 else f"{w}{chr(97 + mark)}{chr(97 + i % 26)}" for i, w in enumerate((PROSE * 4).split()))


def test_nulls_empty_long_and_repeated_texts(spark, sf, tmp_path):
    texts = [*ODD, prose(0), prose(0), prose(1), prose(2) + " write to someone@example.org today", " ".join(prose(m) for m in range(3, 23)) * 1]
    n = len(ODD)
    docs = frame(spark, texts)
    docs = docs.union(docs.filter(f"doc_id = {n + 2}")).union(docs.filter(f"doc_id = {n + 2}").withColumn("doc_id", F.lit(None).cast("long")))
    good, single, clean, masked, packed = through(spark, docs, sf, tmp_path)
    key = lambda rows: sorted(rows.doc_id.fillna(-1).astype(int))
    assert key(good) == [-1, *range(n, n + 3), n + 2, n + 3, n + 4]
    assert key(single) == [-1, n, n + 2, n + 2, n + 3, n + 4] == key(clean) == key(masked)
    assert "[EMAIL]" in masked.set_index("doc_id").text[n + 3] and set(key(packed)) == set(key(masked))
    assert packed.length.sum() == sum(map(len, whole(masked.text)))


def test_an_empty_table(spark, sf, tmp_path):
    for rows in through(spark, frame(spark, ["x"]).limit(0), sf, tmp_path):
        assert len(rows) == 0
