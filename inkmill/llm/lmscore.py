"""Language-model scoring by cross-entropy difference.

A target and a background bigram model count lower-cased words and word pairs, each known by a hash whose width grows with the
corpus. Both are counted over all documents, and matched in size, the background's counts scaled to the target's total, so that
smoothing weighs alike in both. A document's score is its mean loss per token under the background model less that under the
target model: the higher, the more it resembles the target.

A document is never scored by counts of its own: they are taken off both models first (leaving one out), so a document of the
target has no advantage over one that was never seen, and copies elsewhere in the corpus still count.

The counts grow with the corpus and stay distributed: documents are dealt to parts, a part sends its distinct keys and their
counts in one compressed blob to each range of the key space, and a range answers each part with the whole corpus's counts of
the part's keys. Keys that occur once in all are not answered, as nothing is left of them without their document. Parts and
ranges grow with the bytes of text up to `MOST`, beyond that (from half a TB on) their sizes do: a part is worked on in slices
and a blob is made of pieces, one for each fine range that is summed at a time. Nothing but the size of the text reaches the
driver.

Defined results: a null or blank text has no tokens, null losses and score 0; a document is target if any of its labels says so;
rows with a null doc_id count as background; repeated rows are documents of their own, each counted and scored; without any
target document all scores are those of a smoothed uniform target; a very long text is one document like any other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm.common import measure, split_count, table
from inkmill.llm.hashing import U, Words, bucket_bounds, framed, group_starts, mix, sliced, squeeze, squeeze_sorted, unframed, unsqueeze, unsqueeze_sorted

#: Words that smoothing allows for are 2**WORD_BITS, or the distinct words of the corpus where these are more.
WORD_BITS = 18
#: Weight of the pair estimate against the word estimate, and what is added to each word's count.
PAIR_WEIGHT, ADD = 0.6, 0.1
#: Bytes of text in a part and per range of keys, and the most of either.
PART, RANGE, MOST = 8 << 20, 16 << 20, 1 << 16
#: Bytes of text that a part is worked on at a time.
SLICE = 4 << 20
#: Bits of a key beyond those that number the corpus's tokens: two keys are taken for one with a chance of 2**-SPARE.
SPARE = 24
_START = 0x2545F4914F6CDD1D
#: Kind of a key, in its two lowest bits. The start of a text is the context of its first word.
WORD, START, PAIR = range(3)


@dataclass(frozen=True)
class Plan:
    """Sizes that all passes share."""

    parts: int
    ranges: int
    fine: int
    bits: int
    slice: int

    @classmethod
    def of(cls, n_bytes: int, part: int, span: int, slice_bytes: int) -> Plan:
        tokens = n_bytes // 2 + 1
        ranges = split_count(n_bytes, span, most=MOST)
        return cls(split_count(n_bytes, part, most=MOST), ranges, split_count(n_bytes, span * ranges), min(64, tokens.bit_length() + SPARE), slice_bytes)


class Tokens:
    """Of every word of a slice: its text, and the keys of itself and of the pair that it ends. Contexts are the words before."""

    def __init__(self, texts: pa.Array, bits: int) -> None:
        words = Words(texts)
        data = np.where((words.data >= 65) & (words.data <= 90), words.data + 32, words.data).astype(np.uint8)
        word = words.hashes(data)
        keyed = lambda h, kind: (mix(h) >> U(64 - bits) & ~U(3)) | U(kind)
        self.owner, self.count = words.text, words.count
        self.first = words.first[words.count > 0]
        before = np.concatenate((np.zeros(1, U), word[:-1])) if len(word) else word
        before[self.first] = U(_START)
        self.word, self.pair = keyed(word, WORD), keyed(before * U(0x9E3779B97F4A7C15) + word, PAIR)
        self.start = keyed(np.full(1, _START, U), START)

    def keys(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """All keys in order, also of the chosen texts only."""
        take = slice(None) if chosen is None else chosen[self.owner]
        starts = len(self.first) if chosen is None else int(chosen[self.owner[self.first]].sum())
        return np.sort(np.concatenate((self.word[take], self.pair[take], np.repeat(self.start, starts))))

    def places(self, keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's key stands in the known ones (at their end if it doesn't), and how often it occurs in its own text."""
        order = np.argsort(keys, kind="stable")
        key, owner = keys[order], self.owner[order]
        found = _place(known, key)
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))) if len(key) else np.zeros(0, bool)
        times = np.diff(np.append(np.flatnonzero(new), len(key)))[np.cumsum(new) - 1] if len(key) else found
        at, own = np.empty_like(found), np.empty_like(found)
        at[order], own[order] = found, times
        return at, own

    def before(self, of_words: np.ndarray, of_start: int) -> np.ndarray:
        """What words have, for their contexts."""
        out = np.concatenate(([of_start], of_words[:-1])) if len(of_words) else of_words
        out[self.first] = of_start
        return out


def _place(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), np.int64)
    at = np.searchsorted(known, keys)
    return np.where(known[np.minimum(at, len(known) - 1)] == keys, at, len(known))


def _summed(keys: np.ndarray, counts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = group_starts(keys)
    return keys[at], [np.add.reduceat(c[order], at) if len(at) else np.zeros(0, U) for c in counts]


def _counted(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = group_starts(sorted_keys)
    return sorted_keys[at], np.diff(np.append(at, len(sorted_keys))).astype(U)


class _Part:
    """Documents of one part, and which of them are target: rows without a text name the target's ids."""

    def __init__(self, rows: pa.Table, plan: Plan) -> None:
        self.plan = plan
        named = rows.filter(rows.column("text").is_null()).column("doc_id").to_numpy()
        docs = rows.select(["doc_id", "text"]).filter(rows.column("text").is_valid()).combine_chunks()
        self.batches = [s for b in docs.to_batches() for s in sliced(b, 1, plan.slice)]
        self.named = named

    def slices(self):
        """doc_id, whether target, and tokens of each slice."""
        for batch in self.batches:
            ids = batch.column(0)
            aimed = np.isin(ids.fill_null(-1).to_numpy(zero_copy_only=False), self.named) & ids.is_valid().to_numpy(zero_copy_only=False)
            yield ids, aimed, Tokens(batch.column(1), self.plan.bits)


_SENT = "range int, part int, blob binary, n_every long, n_aimed long"


def _send(rows: pa.Table, plan: Plan) -> pa.Table:
    """A blob of keys and counts for each range, with the words of the whole part, so that every range learns the totals."""
    part = rows.column("part")[0].as_py()
    keys, every, aimed, n = [np.zeros(0, U)], [np.zeros(0, U)], [np.zeros(0, U)], [0, 0]
    for _, goal, tokens in _Part(rows, plan).slices():
        key, times = _counted(tokens.keys())
        of_goal = np.zeros(len(key), U)
        if goal.any():
            some, some_times = _counted(tokens.keys(goal))
            of_goal[np.searchsorted(key, some)] = some_times
        for total, new in zip((keys, every, aimed), (key, times, of_goal)):
            total.append(new)
        n = [n[0] + int(tokens.count.sum()), n[1] + int(tokens.count[goal].sum())]
    key, counts = _summed(np.concatenate(keys), [np.concatenate(every), np.concatenate(aimed)])
    at = bucket_bounds(key << U(64 - plan.bits), plan.ranges * plan.fine).tolist()
    pieces = [_piece(key[x:y], *(c[x:y] for c in counts)) for x, y in zip(at[:-1], at[1:])]
    blobs, size = [framed(pieces[r * plan.fine : (r + 1) * plan.fine]) for r in range(plan.ranges)], plan.ranges
    return pa.table([pa.array(np.arange(size), pa.int32()), pa.array([part] * size, pa.int32()), pa.array(blobs, pa.binary()), *(pa.array([x] * size, pa.int64()) for x in n)], ["range", "part", "blob", "n_every", "n_aimed"])


def _piece(keys: np.ndarray, every: np.ndarray, aimed: np.ndarray) -> bytes:
    return framed([squeeze_sorted(keys), squeeze(every), squeeze(aimed)]) if len(keys) else b""


def _counts(pieces: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and both counts of the pieces, behind each other."""
    read = [unframed(p) for p in pieces if p]
    return tuple(np.concatenate([np.zeros(0, U), *(how(p[i]) for p in read)]) for i, how in enumerate((unsqueeze_sorted, unsqueeze, unsqueeze)))


_ANSWER = "part int, range int, blob binary, n_words long, n_every long, n_aimed long"


def _answer(rows: pa.Table) -> pa.Table:
    """To each part: the corpus's counts of those of its keys that occur more than once, the range's distinct words, and all totals."""
    sent = [unframed(x.as_py()) for x in rows.column("blob")]
    out: list[list[bytes]] = [[] for _ in sent]
    n_words = 0
    for pieces in zip(*sent):
        asked = [_counts([p]) for p in pieces]
        key, every, aimed = (np.concatenate(c) for c in zip(*asked))
        key, (every, aimed) = _summed(key, [every, aimed])
        n_words += int(((key & U(3)) == U(WORD)).sum())
        more = every > 1
        key, every, aimed = key[more], every[more], aimed[more]
        for answer, (mine, _, _) in zip(out, asked):
            at = _place(key, mine)
            at = at[at < len(key)]
            answer.append(_piece(key[at], every[at], aimed[at]))
    totals = [sum(rows.column(c).to_pylist()) for c in ("n_every", "n_aimed")]
    size = rows.num_rows
    return pa.table([rows.column("part"), rows.column("range"), pa.array(map(framed, out), pa.binary()), *(pa.array([x] * size, pa.int64()) for x in (n_words, *totals))], ["part", "range", "blob", "n_words", "n_every", "n_aimed"])


def _losses(word: np.ndarray, context: np.ndarray, pair: np.ndarray, whole: np.ndarray, scale: float, vocabulary: int) -> np.ndarray:
    """Of tokens with these counts, under a model of `whole` words whose counts are scaled."""
    alone = (word * scale + ADD) / (whole * scale + ADD * vocabulary)
    both = np.divide(pair, context, out=np.zeros(len(word)), where=context > 0)
    return -np.log(np.where(context > 0, PAIR_WEIGHT * both + (1 - PAIR_WEIGHT) * alone, alone))


_SCORED = "doc_id long, n_tokens long, loss_target double, loss_background double, score double"


def _score(rows: pa.Table, answers: pa.Table, plan: Plan) -> pa.Table:
    answers = answers.sort_by("range")
    key, *counts = _counts(p for x in answers.column("blob") for p in unframed(x.as_py()))
    counts = [np.append(c, U(0)).astype(np.float64) for c in counts]
    vocabulary = max(1 << WORD_BITS, sum(answers.column("n_words").to_pylist()))
    n_every, n_aimed = (answers.column(c)[0].as_py() if answers.num_rows else 0 for c in ("n_every", "n_aimed"))
    scales = (n_aimed / n_every if n_aimed and n_every else 1.0, 1.0)
    out = [pa.table({"doc_id": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64()), **{c: pa.array([], pa.float64()) for c in ("loss_target", "loss_background", "score")}})]
    for ids, goal, tokens in _Part(rows, plan).slices():
        n = tokens.count
        word, pair = tokens.places(tokens.word, key), tokens.places(tokens.pair, key)
        context = tokens.before(word[0], int(_place(key, tokens.start)[0])), tokens.before(word[1], 1)
        means = []
        for model, total in ((1, n_aimed), (0, n_every)):
            took = goal[tokens.owner] if model else np.ones(len(tokens.word), bool)  # the model has counted this text
            left = [np.maximum(0.0, counts[model][at] - np.where(took, own, 0)) for at, own in (word, context, pair)]
            whole = total - np.where(took, n[tokens.owner], 0)
            means.append(np.bincount(tokens.owner, _losses(*left, whole, scales[model], vocabulary), len(n)) / np.maximum(n, 1))
        losses = [pa.array(m, mask=n == 0) for m in means]
        out.append(pa.table([ids.cast(pa.int64()), pa.array(n, pa.int64()), *losses, pa.array(means[1] - means[0])], ["doc_id", "n_tokens", "loss_target", "loss_background", "score"]))
    return pa.concat_tables(out).combine_chunks()


def score(docs: DataFrame, target: DataFrame, text: str = "text", part_bytes: int = PART, range_bytes: int = RANGE, slice_bytes: int = SLICE) -> DataFrame:
    """doc_id, n_tokens, loss_target, loss_background and score for every row; `target` has the doc_id of the target documents."""
    plan = Plan.of(measure(docs, text)[1], part_bytes, range_bytes, slice_bytes)
    part = lambda key: F.pmod(F.xxhash64(key), F.lit(plan.parts)).cast("int").alias("part")
    doc: Column = F.col("doc_id").cast("long")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(doc.alias("doc_id"), body.alias("text"), part(F.coalesce(doc, F.xxhash64(body))))
    named = target.filter("doc_id IS NOT NULL").select(doc.alias("doc_id")).distinct().select("doc_id", F.lit(None).cast("string").alias("text"), part(F.col("doc_id")))
    parts = rows.union(named).repartition(plan.parts, "part")
    sent = parts.groupBy("part").applyInArrow(lambda t: _send(t, plan), _SENT)
    answers = sent.repartition(plan.ranges, "range").groupBy("range").applyInArrow(_answer, _ANSWER)
    return parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(lambda t, a: _score(t, a, plan), _SCORED)


def good_documents(labels: DataFrame) -> DataFrame:
    """doc_id of the documents with a quality label of 1."""
    return labels.filter("quality = 1").select("doc_id")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"), good_documents(table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "n_tokens", *(F.round(c, 6).alias(c) for c in ("loss_target", "loss_background", "score")))
