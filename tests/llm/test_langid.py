from __future__ import annotations

import zlib

from helpers import ODD, documents, frame, save
from pyspark.sql import functions as F

from inkmill.llm.langid import Profiles, held_out, learn, ngrams, op2_language_id, ranked


def plain(lists, text, size):
    """Out-of-place distance written out."""
    mine = ranked(*ngrams(text), size).tolist()
    apart = {lang: sum(abs(r - profile.index(g)) if g in profile else size for r, g in enumerate(mine)) for lang, profile in lists.items()}
    return min(sorted(apart), key=apart.get)


def test_held_out_accuracy_and_fold(spark):
    sf = "/root/testdata/sf0.01"
    docs = documents(sf).set_index("doc_id")
    out = op2_language_id(spark, sf).toPandas().set_index("doc_id")
    assert len(out) == len(docs) and out.score.between(0, 1).all()
    assert all(out.held_out[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in out.index)
    test = out[out.held_out]
    assert (test.lang_pred == docs.lang[test.index]).mean() > 0.97


def test_prediction_equals_the_distance_written_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter(~held_out(F.col("doc_id")))
    profiles = learn(docs)
    lists = {lang: [int(profiles.codes[i]) for i in profiles.ranks[:-1, k].argsort(kind="stable") if profiles.ranks[i, k] < profiles.size] for k, lang in enumerate(profiles.langs)}
    for text in documents(sf).text[:60]:
        assert profiles.predict(text)[0] == plain(lists, text, profiles.size)


def test_odd_texts(spark, tmp_path):
    df = frame(spark, [*ODD, "12 34 !!", "the cat and the dog"])
    rows = op2_language_id(spark, save(df, tmp_path)).collect()
    assert len(rows) == len(ODD) + 2
    none = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert none == {i for i, t in enumerate([*ODD, "12 34 !!", "x"]) if not any(c.isalpha() for c in t or "")}
    assert op2_language_id(spark, save(df.limit(0), tmp_path)).count() == 0
    assert Profiles({}).predict("words") == ("und", 0.0)


def test_profiles_equal_counting_in_plain_python(spark, sf):
    """Profiles of all labelled documents, from n-grams cut out of strings."""
    from collections import Counter

    docs = documents(sf)
    lists = {}
    for lang, rows in docs[docs.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 != 1)].groupby("lang"):
        counts = Counter()
        for text in rows.text:
            s = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split()) + " "
            counts.update(c for c in s if c != " ")
            counts.update(s[k : k + n] for n in (2, 3) for k in range(len(s) - n + 1))
        code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))
        lists[lang] = [code(g) for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))][:400]
    profiles = learn(spark.read.parquet(f"{sf}/documents.parquet").filter(~held_out(F.col("doc_id"))))
    want = Profiles(lists)
    assert profiles.langs == want.langs and (profiles.codes == want.codes).all() and (profiles.ranks == want.ranks).all()
