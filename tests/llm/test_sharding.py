from __future__ import annotations

import zlib

from helpers import ODD, documents, frame, save

from inkmill.llm.sharding import SLACK, grow, narrow, op9_kd_sharding, placed, shard, together


def check(rows, texts, slack):
    assert len(rows) == len(texts) and set(rows.law) <= {"bytes"}
    want = {i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts.items()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows.itertuples()} == want
    for _, shard in rows.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    sums = rows.groupby("shard")["size"].sum()
    assert rows["shard"].between(0, 23).all()
    return sums.max() - sums.min() <= slack


def test_sizes_are_near_equal(spark):
    sf = "/root/testdata/sf0.01"
    docs = documents(sf)
    rows = op9_kd_sharding(spark, sf).toPandas()
    sizes = docs.text.str.encode("utf-8").str.len() + 8
    assert check(rows, dict(zip(docs.doc_id, docs.text)), 1.5 * sizes.max())


def test_a_hot_source_of_equal_texts_is_spread(spark, tmp_path):
    texts = ["the very same text " * 10] * 2400 + [f"text {i} " * (i % 9 + 1) for i in range(2400)]
    rows = op9_kd_sharding(spark, save(frame(spark, texts), tmp_path)).toPandas()
    assert check(rows, dict(enumerate(texts)), 2000)


def test_odd_texts(spark, tmp_path):
    df = frame(spark, ODD)
    check(op9_kd_sharding(spark, save(df, tmp_path)).toPandas(), dict(enumerate(ODD)), 0)
    assert op9_kd_sharding(spark, save(df.limit(0), tmp_path)).count() == 0


def test_leaves_of_a_target_size(spark):
    texts = [f"text number {i} " * (1 + i % 7) for i in range(600)]
    rows = shard(frame(spark, texts), target_bytes=10_000).toPandas()
    sums = rows.groupby("shard")["size"].sum()
    assert len(sums) == -(-rows["size"].sum() // 10_000) and sums.max() < 11_000


def brute(rows, first, leaves, slack, found, dims):
    """The tree by sorting: rows are dicts; places of cuts are boundaries of 11, 22 or 33 bits of the text's hash, then of doc_bits."""
    if leaves == 1 or not rows:
        found.update({id(r): first for r in rows})
        return
    cells = [[r[f"c{i}"] for r in rows] for i in range(3)]
    dim = min(range(3), key=lambda i: (min(cells[i]) - max(cells[i]), i))
    half = leaves // 2
    goal = sum(r["size"] for r in rows) * half / leaves
    place = lambda r: (r[f"c{dim}"], r["text_bits"] >> 22, r["text_bits"] >> 11, r["text_bits"], r["doc_bits"])
    rows = sorted(rows, key=place)
    lo, hi, below = 0, len(rows), 0
    for depth in (1, 2, 3, 4, 5):  # narrow down to the group of equal prefixes that the goal falls into
        k = lo
        while k < hi:
            end = k
            while end < hi and place(rows[end])[:depth] == place(rows[k])[:depth]:
                end += 1
            w = sum(r["size"] for r in rows[k:end])
            if below + w > goal:
                break
            below, k = below + w, end
        lo, hi = k, end
        cut, off = (hi, below + w - goal) if below + w - goal < goal - below else (lo, goal - below)
        if depth > 1 and (off <= slack or depth == 5):
            break
    dims.append(dim)
    brute(rows[:cut], first, half, slack, found, dims)
    brute(rows[cut:], first + half, leaves - half, slack, found, dims)


def test_the_tree_is_that_of_sorted_weighted_medians(spark):
    """Over all documents, a hot source and text among them; all dimensions are split along."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hot = spark.range(600).select((F.col("id") + 10**6).alias("doc_id"), F.lit("one text " * 40).alias("text"), F.lit("en").alias("lang"), F.lit("hot").alias("source"))
    rows = placed(together(narrow(docs.select("doc_id", "text", "lang", "source").union(hot)))).cache()
    plain = [r.asDict() for r in rows.collect()]
    for shards in (24, 7, 1):
        slack = SLACK * sum(r["size"] for r in plain) / shards
        found, dims = {}, []
        brute(plain, 0, shards, slack, found, dims)
        got = {r.doc_id: r.shard for r in grow(rows, shards, slack)[0].collect()}
        assert got == {r["doc_id"]: found[id(r)] for r in plain}
        assert shards < 24 or len(set(dims)) == 3
    rows.unpersist()


def test_equal_texts_stay_together_unless_too_large(spark):
    texts = [f"copy {i % 700} " * (1 + i % 700 % 5) for i in range(2100)]
    rows = shard(frame(spark, texts), shards=6).toPandas()
    together = rows.groupby("text_crc32")["shard"].nunique()
    sums = rows.groupby("shard")["size"].sum()
    assert (together == 1).all() and sums.max() - sums.min() <= 4 * SLACK * sums.mean()


def test_thousands_of_leaves(spark):
    rows = shard(spark.range(30_000).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) || id as text", "'s' || id % 11 as source"), shards=1_000).toPandas()
    assert rows["shard"].nunique() > 990 and rows.groupby("shard")["size"].sum().max() < 2 * rows["size"].sum() / 1_000
