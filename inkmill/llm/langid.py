"""Language identification by rank-order profiles.

A profile is the ranked list of a language's most frequent character n-grams (1 to 3 letters, words padded by one space).
A document's own ranked list is compared to each profile by the out-of-place distance: the sum over the document's n-grams of
how far their ranks lie apart, with a fixed penalty for n-grams that the profile lacks. The nearest profile names the language.

Profiles are learned from at most about `PER_LANGUAGE` labelled documents of each language, chosen by a hash of doc_id;
predictions read whole texts and nothing else.

Defined results: a very long text counts whole; a null text or one without a letter is `und` with score 0, as is every text if nothing could be learned; ties
go to the language that sorts first; rows with a null doc_id are predicted but not learned from; repeated rows are each
predicted; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkmill.llm.common import table

#: N-grams in a profile, and of a document that are compared; labelled documents of a language that are learned from.
PROFILE, PER_LANGUAGE = 400, 1000
_SHIFT = 21


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a space for whatever isn't a letter."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of a text, and their counts; empty if it has no letter."""
    points = np.frombuffer((text or "").encode("utf-32-le", "replace"), "<u4")
    c = np.concatenate(([32], _letters()[points], [32])).astype(np.uint64)
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
    if len(c) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    two = (c[:-1] << np.uint64(_SHIFT)) | c[1:]
    three = (two[:-1] << np.uint64(_SHIFT)) | c[2:]
    return np.unique(np.concatenate((c[c != 32], two, three)), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    return codes[np.lexsort((codes, -counts))[:size]]


class Profiles:
    """Ranks of every profiled n-gram in every language."""

    def __init__(self, lists: dict[str, list[int]], size: int = PROFILE) -> None:
        self.langs, self.size = sorted(lists), size
        self.codes = np.unique(np.array([c for x in lists.values() for c in x], np.uint64))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), size, np.int64)  # the last row: n-grams of no profile
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, np.array(lists[lang], np.uint64)), k] = np.arange(len(lists[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = ngrams(text)
        if not len(codes) or not self.langs:
            return "und", 0.0
        top = ranked(codes, counts, self.size)
        at = np.minimum(np.searchsorted(self.codes, top), len(self.codes) - 1)
        known = self.codes[at] == top
        theirs = self.ranks[np.where(known, at, len(self.codes))]
        apart = np.where(theirs < self.size, np.abs(theirs - np.arange(len(top))[:, None]), self.size).sum(axis=0)
        best = int(np.argmin(apart))
        others = np.delete(apart, best)
        second = int(others.min()) if len(others) else self.size * len(top)
        return self.langs[best], float((second - apart[best]) / second) if second else 0.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("long").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def learn(docs: DataFrame, text: str = "text", per_language: int = PER_LANGUAGE, size: int = PROFILE) -> Profiles:
    """Profiles from labelled documents (doc_id, text, lang): bounded by per_language documents of each language in expectation."""
    known = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col(text).alias("text"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return Profiles({}, size)
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))))
    picked = F.pmod(F.crc32(F.concat(F.lit("sample "), F.col("doc_id").cast("string")).cast("binary")), F.lit(1 << 20))
    sample = known.filter(picked < F.element_at(share, F.col("lang")) * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, dict[int, int]] = {}
        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                mine = total.setdefault(lang, {})
                for code, n in zip(*(x.tolist() for x in ngrams(body.as_py()))):
                    mine[code] = mine.get(code, 0) + n
        rows = [(lang, code, n) for lang, mine in total.items() for code, n in mine.items()]
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["lang", "code", "n"])

    counts = sample.select("lang", "text").mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = counts.withColumn("place", place).filter(F.col("place") <= size).orderBy("lang", "place").collect()
    lists: dict[str, list[int]] = {}
    for r in top:
        lists.setdefault(r["lang"], []).append(r["code"])
    return Profiles(lists, size)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (how much nearer the best profile is than the second) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn(docs.filter(~held_out(F.col("doc_id"))))
    return identify(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
