from __future__ import annotations

import hashlib
import random

from helpers import ODD, WORDS, documents, frame, save

from inkmill.llm.substrings import _Plan, dealt, op6_substring_dedup, remove_repeats, sent_probes


def brute(texts, window):
    """texts: (doc_id, text) rows."""
    rows = [(i, WORDS.findall(t or "")) for i, t in texts]
    least = {}
    for i, words in rows:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            least[w] = min(least.get(w, i), i)
    out = []
    for i, words in rows:
        gone = set()
        for k in range(len(words) - window + 1):
            if least[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))


def test_equals_brute_force(spark, sf):
    docs = documents(sf)
    assert got(op6_substring_dedup(spark, sf)) == brute(list(zip(docs.doc_id, docs.text)), 50)


def test_odd_texts(spark, tmp_path):
    long = " ".join(f"w{k % 97}" for k in range(400))
    texts = [*ODD, long, "lead in " + long, long.upper(), long.replace(" ", "\n\t")]
    df = frame(spark, texts)
    assert got(op6_substring_dedup(spark, save(df, tmp_path))) == brute(list(enumerate(texts)), 50)
    assert op6_substring_dedup(spark, save(df.limit(0), tmp_path)).count() == 0


def test_random_small_windows_over_many_parts(spark):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    texts = [" ".join(rng.choices("abc", k=rng.randrange(25))) for _ in range(150)]
    df = remove_repeats(frame(spark, texts), window=6, task_bytes=100, fine_keys=10)
    assert got(df.withColumn("kept_sha256", F.sha2("kept_text", 256))) == brute(list(enumerate(texts)), 6)
    again = frame(spark, texts).union(frame(spark, texts))  # rows of one id leave each other alone
    df = remove_repeats(again, window=5).withColumn("kept_sha256", F.sha2("kept_text", 256))
    assert got(df) == brute([*enumerate(texts)] * 2, 5)


def test_blobs_do_not_grow_with_the_corpus(spark):
    """With tasks and ranges fixed, a task's many slices go out in one blob a range, and rows stay the same."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdef", k=rng.randrange(40))) for _ in range(400)]
    df = frame(spark, texts)
    few = {"tasks": 3, "ranges": 4, "slice_bytes": 60, "fine_keys": 50}
    plan = _Plan(10_000, 6, 1, **few)
    assert plan.fine > 1 and sent_probes(dealt(df.select("doc_id", "text"), plan), plan).count() <= 12
    out = remove_repeats(df, window=6, **few).withColumn("kept_sha256", F.sha2("kept_text", 256))
    assert got(out) == brute(list(enumerate(texts)), 6)
