"""Quality rules: word statistics, and the divergence of a document from reference histograms of its language.

Main path: SQL expressions only, one pass, no shuffle. Two histograms are made of a document: code points by character class,
and words by the most common words of each language. Of each, the Jensen-Shannon distance (base 2, 0 to 1) to the nearest
language's reference counts, and each has a bound of its own that rejects: the classes catch symbols, digits and shouting,
the words catch text without grammar, such as menus and lists of keys. Documents shorter than a histogram's guards are not
judged by it.

The bounds were chosen on the documents of the sf0.01 and sf0.1 test tables that pass the base rules (some 9,700). Word
distance: running text of 120 words and more stays under 0.3 (0.277 at the 99.9th percentile of 100 words and more, 0.316 at
most); lists of fragments mostly have 0.324, which is the value of no common word at all, and 0.284 at the 1st percentile.
Class distance: running text stays under 0.3, text with symbols on its words starts at 0.39. References are rounded shares of the commonest words in large general corpora.

Languages without a reference: a document labelled with one, or mostly written in letters other than a to z, is not judged by
divergence; with a null label the nearest reference is taken.

The word windows found twice are matched by a 64-bit hash of the three words within one document.

Defined results: a null text has no words; a very long text is judged whole; a null doc_id is kept as null; repeated rows are each judged; an empty table gives
an empty result; `keep_documents` keeps other columns and lets documents with null text go, as they have under 50 words.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm.common import WS, let, table

MIN_WORDS = 50
#: Guards: below these the histograms are too thin to compare.
GUARD_CHARS, GUARD_WORDS = 200, 120
#: Distance beyond which a document is rejected, of character classes and of common words.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.33, 0.3

# Shares of character classes in running text (lower, upper, digit, other letter, space, punctuation, symbol).
CLASSES = ("lower", "upper", "digit", "other", "space", "punct", "symbol")
CLASS_SHARES = {
    "en": (0.775, 0.025, 0.005, 0.001, 0.172, 0.021, 0.001),
    "de": (0.765, 0.050, 0.005, 0.018, 0.140, 0.021, 0.001),
    "fr": (0.735, 0.025, 0.005, 0.035, 0.170, 0.029, 0.001),
    "es": (0.755, 0.025, 0.005, 0.023, 0.168, 0.023, 0.001),
}
# Shares of the most common words among all words of a language.
WORD_SHARES = {
    "en": {"the": 0.062, "of": 0.032, "and": 0.028, "to": 0.026, "a": 0.022, "in": 0.020, "is": 0.0105, "that": 0.0105, "it": 0.0095, "was": 0.0095, "he": 0.0088, "for": 0.0093},
    "de": {"der": 0.034, "die": 0.033, "und": 0.028, "in": 0.019, "den": 0.013, "von": 0.011, "zu": 0.011, "das": 0.010, "mit": 0.0095, "sich": 0.009, "des": 0.009, "auf": 0.0085},
    "fr": {"de": 0.046, "la": 0.028, "le": 0.027, "et": 0.024, "les": 0.023, "des": 0.020, "en": 0.016, "un": 0.013, "du": 0.012, "une": 0.011, "que": 0.011, "est": 0.010},
    "es": {"de": 0.060, "la": 0.038, "que": 0.029, "el": 0.028, "en": 0.026, "y": 0.025, "a": 0.020, "los": 0.017, "se": 0.013, "del": 0.012, "las": 0.011, "un": 0.010},
}
SYMBOLS = r"[#*$%&|<>]"


def _class_counts(text: Column) -> Column:
    """Code points by class, as an array in the order of CLASSES. Each step removes one class, so later ones scan little."""

    def taken(pattern: str, rest: Column, then) -> Column:
        return let(F.regexp_replace(rest, pattern, ""), lambda left: then(F.length(rest) - F.length(left), left))

    return taken("[a-z]+", text, lambda lower, r1: taken("[ \t\n\u000b\f\r]+", r1, lambda space, r2: taken("[A-Z]+", r2, lambda upper, r3: taken("[0-9]+", r3, lambda digit, r4: taken("\\p{L}+", r4, lambda other, r5: taken("[#*$%&|<>]+", r5, lambda symbol, r6: F.array(lower, upper, digit, other, space, F.length(r6), symbol)))))))


def repeated_words(words: Column, n: int = 3) -> Column:
    """Words inside n-word windows that the document has twice or more."""

    def positions(hashes: Column) -> Column:
        keyed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.array_sort(F.transform(F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])), lambda x: x["i"]))
        return let(keyed, twice)

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, k: F.least(F.lit(n), F.coalesce(F.get(at, k + 1) - p, F.lit(n))))
        return F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(positions(hashes), covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(n))))
    return F.when(F.size(words) < n + 1, F.lit(0)).otherwise(let(windows, count))


def _mass(p: Column) -> Column:
    """p log2 p, 0 at 0."""
    return F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0))


def _total(columns: list[Column]) -> Column:
    return functools.reduce(lambda a, b: a + b, columns)


def _distance(have: list[Column], want: list[float]) -> Column:
    """Jensen-Shannon distance of two histograms of shares, from the entropies of both and of their mean."""
    known = sum(q * math.log2(q) for q in want if q)
    middle = _total([_mass((p + q) / 2) for p, q in zip(have, want)])
    return F.sqrt(F.greatest(F.lit(0.0), (_total([_mass(p) for p in have]) + known) / 2 - middle))


def assess(docs: DataFrame, text: str = "text", shares: dict = CLASS_SHARES, words_by_lang: dict = WORD_SHARES) -> DataFrame:
    """doc_id, counts, distances, base_failed and kept for every document."""
    return _assess(docs, F.col("doc_id").cast("long").alias("doc_id"), text, shares, words_by_lang)


def keep_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass, with all their columns. The row is carried along, so there is no join."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    judged = _assess(docs, row, text, CLASS_SHARES, WORD_SHARES)
    # A filter on a deterministic column is pushed below the projections, which writes every histogram out again wherever it
    # is used; a row number in the column keeps the verdict where it is, computed once.
    once = (F.col("kept") & (F.monotonically_increasing_id() >= 0)).alias("kept")
    return judged.select("row", once).filter("kept").select("row.*")


def _assess(docs: DataFrame, key: Column, text: str, shares: dict, words_by_lang: dict) -> DataFrame:
    common = sorted({w for words in words_by_lang.values() for w in words})
    # each common word becomes one character, so that counting them needs little memory
    letter = {w: chr(ord("0") + i) for i, w in enumerate(common)}
    letters = F.create_map(*(F.lit(x) for pair in letter.items() for x in pair))
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, WS), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # no label, or one of a language with a reference
    scope = (F.col("lang").isNull() | F.col("lang").isin(*shares)) if "lang" in docs.columns else F.lit(True)
    found = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            repeated_words(w).cast("long").alias("again"),
            F.array_join(F.transform(F.filter(w, lambda x: x.isin(common)), lambda x: F.element_at(letters, x)), "").alias("common"),
        ),
    )
    step = docs.select(key, scope.alias("scope"), found.alias("w"), let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), _class_counts(body).alias("classes"))
    first = step.columns[0]
    step = step.select(
        first,
        "scope",
        F.col("w.n").alias("n_words"),
        F.col("w.again").alias("n_repeat_words"),
        "n_dup_lines",
        F.col("w.common").alias("common"),
        *(F.col("classes")[i].cast("double").alias(c) for i, c in enumerate(CLASSES)),
    )
    # shares of each bin; a document without text or words gets zeros
    chars, n = F.greatest(F.lit(1.0), _total([F.col(c) for c in CLASSES])), F.greatest(F.lit(1.0), F.col("n_words").cast("double"))
    hits = [((F.length("common") - F.length(F.replace("common", F.lit(letter[w]), F.lit("")))) / n).alias(f"w_{i}") for i, w in enumerate(common)]
    step = step.select(
        first, "scope", "n_words", "n_repeat_words", "n_dup_lines",
        (_total([F.col(c) for c in CLASSES]) - F.col("space")).cast("long").alias("word_chars"),
        F.col("symbol").cast("long").alias("n_symbols"),
        *((F.col(c) / chars).alias(f"c_{i}") for i, c in enumerate(CLASSES)),
        *hits,
    )
    by_class, by_words = [], []
    for lang in shares:
        by_class.append(_distance([F.col(f"c_{i}") for i in range(len(CLASSES))], list(shares[lang])))
        have = [F.col(f"w_{common.index(w)}") for w in words_by_lang[lang]]
        rest = F.greatest(F.lit(0.0), 1 - _total(have))
        by_words.append(_distance([*have, rest], [*words_by_lang[lang].values(), 1 - sum(words_by_lang[lang].values())]))
    keep = [first, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = F.col("scope") & (F.col("word_chars") >= GUARD_CHARS) & (F.col("c_3") <= F.col("c_0") + F.col("c_1"))
    step = step.select(*keep, judged.alias("judged"), F.least(*by_class).alias("class_distance"), F.least(*by_words).alias("word_distance"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = F.col("judged") & ((F.col("class_distance") > MAX_CLASS_DISTANCE) | ((F.col("n_words") >= GUARD_WORDS) & (F.col("word_distance") > MAX_WORD_DISTANCE)))
    return step.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far).drop("judged")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance")
    )
