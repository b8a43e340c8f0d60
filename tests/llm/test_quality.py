from __future__ import annotations

import re

from helpers import ODD, WORDS, documents, frame, save

from inkmill.llm.quality import MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, WORD_SHARES, assess, keep_documents, op7_quality


def counts(text):
    text = text or ""
    words = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def got(df):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()}


def test_counts_equal_brute_force(spark, sf):
    assert got(op7_quality(spark, sf)) == {r.doc_id: counts(r.text) for r in documents(sf).itertuples()}


def test_odd_texts(spark, tmp_path):
    texts = [*ODD, "a b c a b c a b c d", "a a a a", "x\nx\n \n \ny\nx", " lead and trail \x0b"]
    df = frame(spark, texts)
    assert got(op7_quality(spark, save(df, tmp_path))) == {i: counts(t) for i, t in enumerate(texts)}
    assert op7_quality(spark, save(df.limit(0), tmp_path)).count() == 0


def test_prose_is_kept_and_junk_is_not(spark):
    prose = "The cat sat on the mat and looked at the rain that fell in the garden, for it was a long day with little to do. " * 1
    prose += "Nobody knew what the old man had wanted to say when he left the house in the morning. He was not seen in the town again until spring came, and then only once. "
    junk = " ".join(f"x{i}#$%&*" for i in range(80))
    few = "too short"
    df = frame(spark, [prose + " ".join(f"word{chr(97 + i % 26)}" for i in range(20)), junk, few, None])
    assert [r.doc_id for r in keep_documents(df).collect()] == [0]
    assert keep_documents(df).columns == df.columns


def test_words_alone_reject_text_without_grammar(spark):
    """Its characters are those of prose; it lacks the common words only. Too short a list is not judged."""
    name = lambda i: f"{chr(97 + i % 26)}ord{chr(97 + i // 26 % 26)}"
    small = [w for w, share in WORD_SHARES["en"].items() for _ in range(round(300 * share))]
    prose = " ".join(small[i // 4 % len(small)] if i % 4 == 0 else name(i) for i in range(300))
    fragments = " ".join(f"menu{chr(97 + i % 26)}{chr(97 + i // 26)} entry, other{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    df = frame(spark, [prose, fragments, " ".join(fragments.split()[:110])])
    rows = {r.doc_id: r for r in assess(df).collect()}
    assert not any(r.base_failed for r in rows.values())
    assert rows[1].word_distance > MAX_WORD_DISTANCE and rows[1].class_distance <= MAX_CLASS_DISTANCE
    assert [rows[i].kept for i in range(3)] == [True, False, True]


def test_lists_of_the_corpus_go_and_its_prose_stays(spark, sf):
    sf = sf.replace("0.001", "0.01")
    rows = assess(spark.read.parquet(f"{sf}/documents.parquet")).toPandas().set_index("doc_id")
    docs = documents(sf).set_index("doc_id").join(rows)
    docs = docs[~docs.base_failed & (docs.n_words >= 120)]
    bars = docs.text.str.count(r" \| ") > 0.3 * docs.n_words
    marks = docs.text.str.contains("%%%|&&&|###", regex=True)
    assert bars.sum() > 5 and docs[bars].kept.mean() < 0.2 and docs[~bars & ~marks].kept.all()


def test_languages_without_a_reference_are_not_judged(spark):
    russian = "Старик вышел из дома рано утром и пошёл к реке, где его ждали люди с лодками и сетями. " * 1
    russian += " ".join(f"слово{chr(0x430 + i % 32)}{chr(0x430 + i // 32)} было" for i in range(60))
    polish = " ".join(f"słowo{chr(97 + i % 26)}{chr(97 + i // 26)} jest" for i in range(80))
    rows = [(0, russian, None), (1, russian, "ru"), (2, polish, "pl"), (3, polish, None)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in assess(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == {0: (False, True), 1: (False, True), 2: (False, True), 3: (False, False)}
    assert assess(spark.createDataFrame([(0, russian)], "doc_id long, text string")).first().kept
