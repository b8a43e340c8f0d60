from __future__ import annotations

import pandas as pd
import pytest
from helpers import ODD, WORDS, documents, frame

from inkmill.llm import decontam
from inkmill.llm.decontam import drop_leaks, find_leaks, op10_decontamination


def verbatim(docs, items, run=13):
    """Pairs that share a whole item or `run` consecutive words, verbatim."""
    out = set()
    grams = {}
    for item, text in items:
        words = WORDS.findall(text)
        for k in range(max(1, len(words) - run + 1)):
            grams.setdefault(tuple(words[k : k + run]), set()).add(item)
    for doc, text in docs:
        words = WORDS.findall(text or "")
        for k in range(len(words)):
            for item in grams.get(tuple(words[k : k + run]), ()):
                out.add((doc, item))
    return out


def test_finds_every_verbatim_passage_and_little_else(spark, sf):
    items = pd.read_parquet(f"{sf}/benchmark.parquet")
    docs = documents(sf)
    want = verbatim(zip(docs.doc_id, docs.text), zip(items.item_id, items.text))
    got = {(r.doc_id, r.item_id) for r in op10_decontamination(spark, sf).collect()}
    assert want <= got
    assert len(got - want) <= 0.1 * len(want) + 2


QUESTION = "A train leaves the station at 9 with 120 passengers and travels 300 km before it meets Alice at the old bridge near the river"


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_other_numbers_and_names_are_found_if_consistent(spark):
    other = QUESTION.replace("120", "75").replace("300", "48").replace("Alice", "Bob").replace("at 9", "at 4")
    docs = frame(spark, ["Some lead in. " + QUESTION + ". More.", "note that " + other, "a train of thought about something else entirely with 120 passengers", None, ""])
    got = {(r.doc_id, r.verbatim) for r in find_leaks(docs, bench(spark, QUESTION)).collect()}
    assert {d for d, _ in got} == {0, 1} and (1, False) in got
    assert sorted(r.doc_id for r in drop_leaks(docs, bench(spark, QUESTION)).collect()) == [2, 3, 4]


def test_inconsistent_slots_are_no_leak(spark):
    item = "take 5 apples and then 5 pears and then 5 plums and then 5 figs and then 5 dates and eat them all"
    same, mixed = item.replace("5", "8"), "take 1 apples and then 2 pears and then 3 plums and then 4 figs and then 6 dates and eat them all"
    got = {r.doc_id for r in find_leaks(frame(spark, [same, mixed]), bench(spark, item)).collect()}
    assert got == {0}


def test_odd_texts_and_empty_tables(spark):
    df = frame(spark, [*ODD, QUESTION, QUESTION])
    got = {r.doc_id for r in find_leaks(df, bench(spark, QUESTION, None, "", "short")).collect()}
    assert got == {len(ODD), len(ODD) + 1}
    assert find_leaks(df.limit(0), bench(spark, QUESTION)).count() == 0
    assert find_leaks(df, bench(spark, QUESTION).limit(0)).count() == 0
    assert drop_leaks(df, bench(spark, QUESTION)).columns == df.columns


def test_edits_at_any_place_and_alignment_are_found(spark):
    """Copies with as many words changed as the rule allows, spread so that agreeing stretches are as short as they can be."""
    items, texts = [], []
    for length in (10, 11, 14, 17, 20, 26, 41):
        words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}w{chr(97 + length % 26)}" for i in range(length)]
        changes = min(length - 7, length - -(-7 * length // 10))
        at = {(k + 1) * (length + 1) // (changes + 1) - 1 for k in range(changes)}
        assert len(at) == changes
        copy = " ".join("other" if i in at else w for i, w in enumerate(words))
        texts += [(len(items), "lead " * lead + copy + " and a tail") for lead in range(4)]
        items.append(" ".join(words))
    got = {(r.doc_id, r.item_id) for r in find_leaks(frame(spark, [t for _, t in texts]), bench(spark, *items)).collect()}
    assert got == {(i, item) for i, (item, _) in enumerate(texts)}


def test_short_items_are_found_at_any_place(spark):
    """Items of 4 to 12 words after 0 to 7 other words; an item that is one word short of any rule is not found."""
    items, texts = [], []
    for length in range(4, 13):
        item = " ".join(f"{chr(97 + i)}q{chr(97 + length)}" for i in range(length))
        texts += [(len(items), "lead " * lead + item + " and a tail") for lead in range(8)]
        items.append(item)
    broken = [" ".join(w if i else "other" for i, w in enumerate(item.split())) for item in items if len(item.split()) < 8]
    got = {(r.doc_id, r.item_id) for r in find_leaks(frame(spark, [t for _, t in texts] + broken), bench(spark, *items, "too few words")).collect()}
    assert got == {(i, item) for i, (item, _) in enumerate(texts)}


def random_tables():
    """Texts of few distinct words with names, numbers and units, and documents that hold edited copies of them."""
    import random

    rng = random.Random(17)
    pool = ["the", "of", "a", "train", "runs", "from", "Alice", "Bob", "Zoë", "met", "5", "12", "7 kg", "3km", "40 mph", "12,5", "and,", "then;", "Éva", "o'clock", "x-ray", "in", "old", "park", "(big)", "day."]
    some = lambda n: [rng.choice(pool) if rng.random() < 0.6 else f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(n)]
    items = [some(rng.randrange(3, 40)) for _ in range(40)]
    docs = []
    for k in range(300):
        words = some(rng.randrange(0, 30))
        for _ in range(rng.randrange(3)):
            copy = [w if rng.random() > rng.choice([0, 0.1, 0.3]) else rng.choice(pool) for w in rng.choice(items)]
            other = {"5": "9", "Alice": "Carol", "7 kg": "8 kg"} if rng.random() < 0.4 else {}
            copy = [other.get(w, w) for w in copy]
            copy = copy[rng.randrange(3) :] if rng.random() < 0.3 else copy
            words += copy + some(rng.randrange(5))
        docs.append(rng.choice([" ", "  ", "\n"]).join(words))
    return docs, [" ".join(x) for x in items]


@pytest.mark.parametrize("common", [decontam.COMMON, 2])
def test_random_texts_equal_a_comparison_at_every_alignment(spark, monkeypatch, common):
    import duckdb

    monkeypatch.setattr(decontam, "COMMON", common)
    from inkmill.llm.oracle import ORACLE

    docs, items = random_tables()
    con = duckdb.connect()
    for name, texts, key in (("documents", docs, "doc_id"), ("benchmark", items, "item_id")):
        con.register(name, pd.DataFrame({key: range(len(texts)), "text": texts}))
    want = sorted(tuple(r) for r in con.sql(f"select doc_id, item_id, doc_word, matched, longest_run, item_len, n_slots, verbatim from ({ORACLE['op10_decontamination']})").fetchall())
    got = sorted(tuple(r) for r in find_leaks(frame(spark, docs), bench(spark, *items)).collect())
    assert got == want and len(got) > 100 and sum(not r[-1] for r in got) > 10


def test_items_of_one_id_and_repeated_items(spark):
    items = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (1, " ".join(f"other{chr(97 + i)}" for i in range(15)))], "item_id long, text string")
    got = find_leaks(frame(spark, [QUESTION, " ".join(f"other{chr(97 + i)}" for i in range(15)), "nothing"]), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(0, 1), (1, 1)]
