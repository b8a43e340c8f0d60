from __future__ import annotations

import math
from collections import Counter

import pandas as pd
import pytest
from helpers import ODD, WORDS, documents, frame

from inkmill.llm import lmscore
from inkmill.llm.lmscore import ADD, PAIR_WEIGHT, WORD_BITS, op4_lm_scoring, score

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
START = object()


def brute(texts, target):
    """Both models with dictionaries instead of hashed tables; a text's own counts are taken off before it is scored."""
    lists = {i: [w.translate(LOWER) for w in WORDS.findall(t or "")] for i, t in texts.items()}
    word, pair = {0: Counter(), 1: Counter()}, {0: Counter(), 1: Counter()}
    own = {i: (Counter(words) + Counter([START] * bool(words)), Counter(zip([START, *words], words))) for i, words in lists.items()}
    for i in lists:
        for g in (0, 1) if i in target else (0,):
            word[g].update(own[i][0])
            pair[g].update(own[i][1])
    total = {g: sum(n for w, n in word[g].items() if w is not START) for g in (0, 1)}
    scale = {1: 1.0, 0: total[1] / total[0] if total[1] and total[0] else 1.0}
    vocabulary = max(1 << WORD_BITS, len(word[0]) - 1)
    out = {}
    for i, words in lists.items():
        loss = {0: 0.0, 1: 0.0}
        for g in (0, 1):
            took = g == 0 or i in target
            left = lambda counts, mine, x: counts[x] - took * mine[x]
            for a, b in zip([START, *words], words):
                alone = (left(word[g], own[i][0], b) * scale[g] + ADD) / ((total[g] - took * len(words)) * scale[g] + ADD * vocabulary)
                context = left(word[g], own[i][0], a)
                loss[g] -= math.log(PAIR_WEIGHT * left(pair[g], own[i][1], (a, b)) / context + (1 - PAIR_WEIGHT) * alone if context else alone)
        out[i] = (len(words), (loss[0] - loss[1]) / max(1, len(words)))
    return out


def run(spark, texts, target, **sizes):
    labels = spark.createDataFrame([(i,) for i in [*target, *target, None, 10**9]], "doc_id long")
    docs = frame(spark, list(texts.values()))
    return {r.doc_id: (r.n_tokens, r.score) for r in score(docs, labels, **sizes).collect()}


def same(got, want, within):
    assert got.keys() == want.keys()
    for i in want:
        assert got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1], abs=within)


def test_equals_dictionaries(spark):
    """Nulls, empty and very long texts, repeats and ties among them."""
    texts = dict(enumerate([*ODD, "good words in good order", "Good words in another order", "noise noise noise", "good noise", "good noise"]))
    target = {len(texts) - 5, len(texts) - 4}
    same(run(spark, texts, target), brute(texts, target), 1e-5)


def test_an_empty_table_and_no_target(spark):
    docs, none = frame(spark, ["a b", None]), spark.createDataFrame([], "doc_id long")
    assert score(docs.limit(0), none).count() == 0 and score(docs.limit(0), spark.createDataFrame([(1,)], "doc_id long")).count() == 0
    same(run(spark, {0: "a b", 1: None, 2: "a b c"}, set()), brute({0: "a b", 1: None, 2: "a b c"}, set()), 1e-9)


def test_seen_and_held_out_target_documents_score_alike(spark, sf):
    """No document gains from being in the model: good documents that the target has counted score like those it hasn't."""
    labels = pd.read_parquet(f"{sf.replace('0.001', '0.1')}/labels.parquet").groupby("doc_id").quality.max()
    good = sorted(labels[labels == 1].index)
    half = spark.createDataFrame([(int(i),) for i in good[::2]], "doc_id long")
    rows = score(spark.read.parquet(f"{sf.replace('0.001', '0.1')}/documents.parquet"), half).toPandas().set_index("doc_id").score
    seen, unseen, others = rows[good[::2]].mean(), rows[good[1::2]].mean(), rows[~rows.index.isin(good)].mean()
    assert abs(seen - unseen) < 0.2 and min(seen, unseen) > others


def test_copies_elsewhere_count_and_own_words_do_not(spark, sf):
    rows = op4_lm_scoring(spark, sf).toPandas().set_index("doc_id")
    docs = documents(sf)
    twice = docs[docs.duplicated("text", keep=False) & (docs.text.str.len() > 300)].doc_id
    once = docs[~docs.doc_id.isin(twice) & (docs.text.str.len() > 300)].doc_id
    assert rows.loss_background[twice].median() < rows.loss_background[once].median() - 1


def test_more_pairs_than_any_fixed_table_are_counted_apart(spark):
    """1.8M random pairs would share many of 2**21 cells; scores stay those of exact counts."""
    import numpy as np

    rng = np.random.default_rng(5)
    texts = {i: " ".join(f"w{k}" for k in rng.integers(0, 60_000, 60_000)) for i in range(30)}
    texts[30] = texts[3][: len(texts[3]) // 2]
    same(run(spark, texts, {3, 30}), brute(texts, {3, 30}), 1e-6)


def test_counts_meet_over_many_ranges_parts_and_slices(spark, monkeypatch):
    texts = {i: f"Word{i} and word{i % 7} meet word{i % 3} and others" for i in range(60)} | {60: None, 61: "  "}
    want = brute(texts, {1, 8})
    same(run(spark, texts, {1, 8}, part_bytes=300, range_bytes=100, slice_bytes=120), want, 1e-9)
    monkeypatch.setattr(lmscore, "MOST", 3)  # few parts and ranges, so fine ranges within these
    same(run(spark, texts, {1, 8}, part_bytes=300, range_bytes=100, slice_bytes=120), want, 1e-9)
