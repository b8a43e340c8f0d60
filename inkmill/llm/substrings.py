"""Substring dedup by fixed-block anchors.

Every document's words are cut into non-overlapping blocks of half a window; these are the index. Every rolling window of a
block's length probes it. A repeat of a whole window in two documents contains a full block of either, so index and probes
meet on it wherever it starts. Hits are then extended: windows around a hit are compared over their full length, which marks
maximal exact repeats word by word, and a word goes if such a window also starts in a document with a smaller id.

How it is laid out: documents are dealt to a bounded number of tasks (a shuffle of the text that three passes share). A task works
through its texts slice by slice, merges the sorted, distinct probe keys of all of them, and sends one blob to each of a bounded
number of ranges of the key space; the range answers the tasks which keys are shared and anchored. Extension goes the same way
with keys of whole windows and the smallest and largest id of each: a task learns the smallest id of those windows that it has
to cut somewhere. A blob is made of pieces, one for each fine range that is worked on at a time, so a range's memory is that of
its compressed blobs and one fine range. A key met in very many documents is one entry of each task, so no key makes a large
group, and pairs of documents are never formed. Blobs number at most tasks times ranges, `MOST` of either; from about 2 TB of
text on, tasks and blobs grow instead of their number. Probe keys are cut to as many bits as the corpus needs (a false hit costs
work, not correctness); extended windows carry 80 bits.

Defined results: null text has no words; documents shorter than a window lose nothing, very long ones are read whole; rows of the same doc_id never remove
each other's words; a null doc_id counts as larger than all others; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm.common import measure, table
from inkmill.llm.hashing import Rolling, U, Words, bucket_bounds, framed, sliced, squeeze, squeeze_sorted, unframed, unsqueeze, unsqueeze_sorted, window_starts

WINDOW = 50
#: Bytes of text in a task and in a slice of it, keys in a fine range and fine ranges in a range, and the most tasks and ranges.
TASK_BYTES, SLICE, FINE_KEYS, FINE, MOST = 32 << 20, 4 << 20, 2 << 20, 4, 1 << 16
_BLOBS = "bucket int, part int, blob binary"
_LAST = (1 << 63) - 1
_SECOND = 0xC2B2AE3D27D4EB4F


class _Plan:
    """Sizes that all passes share."""

    def __init__(self, n_bytes: int, window: int, task_bytes: int, fine_keys: int, tasks: int | None = None, ranges: int | None = None, slice_bytes: int = SLICE) -> None:
        self.window, self.block, self.slice = window, (window + 1) // 2, slice_bytes
        least = min(64, -(-n_bytes // (256 << 10)))
        keys = n_bytes // 6 + 1
        self.tasks = tasks or max(1, least, min(MOST, -(-n_bytes // task_bytes)))
        self.ranges = ranges or max(1, least, min(MOST, -(-keys // (fine_keys * FINE))))
        self.fine = max(1, -(-keys // (fine_keys * self.ranges)))
        self.bits = min(62, max(36, keys.bit_length() + 8))

    def cut(self, sorted_keys: np.ndarray) -> np.ndarray:
        """Bounds of all fine ranges in sorted keys of 64 bits."""
        return bucket_bounds(sorted_keys, self.ranges * self.fine)

    def blobs(self, sorted_keys: np.ndarray, squeezed) -> list[tuple[int, bytes]]:
        """(range, blob) of each range that has keys: its fine ranges' pieces, each made by squeezed(from, to)."""
        ends, out = self.cut(sorted_keys).tolist(), []
        for r in range(self.ranges):
            own = ends[r * self.fine : (r + 1) * self.fine + 1]
            if own[-1] > own[0]:
                out.append((r, framed([squeezed(x, y) if y > x else b"" for x, y in zip(own[:-1], own[1:])])))
        return out


class _Slice:
    """Some texts with what all passes need of them."""

    def __init__(self, batch: pa.RecordBatch, plan: _Plan) -> None:
        self.plan = plan
        self.texts = batch.column(1)
        self.ids = batch.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False)
        self.words = Words(self.texts)
        self.hashes = self.words.hashes()
        self.roll = Rolling(self.hashes)

    def probes(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all block-long windows and their keys."""
        at = window_starts(self.words, self.plan.block)
        return at, self.roll.at(at, self.plan.block) >> U(64 - self.plan.bits)

    def whole(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows that start there: 64 and 16 bits."""
        second = Rolling(self.hashes, _SECOND).at(at, self.plan.window)
        return self.roll.at(at, self.plan.window), second >> U(48)

    def owner(self, at: np.ndarray) -> np.ndarray:
        return self.ids[self.words.text[at]].astype(U)


def _slices(rows: pa.Table, plan: _Plan) -> Iterator[_Slice]:
    for batch in rows.select(["doc_id", "text"]).to_batches():
        for part in sliced(batch, 1, plan.slice):
            yield _Slice(part, plan)


def _grouped(columns: list[np.ndarray], by: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns ordered by the first `by` of them, and where each distinct value of these begins."""
    order = np.lexsort(tuple(columns[:by][::-1])) if by > 1 else np.argsort(columns[0], kind="stable")
    columns = [c[order] for c in columns]
    if not len(order):
        return columns, np.zeros(0, np.int64)
    new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:by]])
    return columns, np.flatnonzero(np.concatenate(([True], new)))


def _joined(parts: list[list[np.ndarray]], width: int) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, U), *(p[i] for p in parts)]) for i in range(width)]


def _reduced(how: np.ufunc, values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return how.reduceat(values, first) if len(first) else values[:0]


def _send_probes(rows: pa.Table, plan: _Plan) -> pa.Table:
    """Distinct keys of the task, with flags: 1, found in several documents; 2, anchored."""
    found = []
    for part in _slices(rows, plan):
        at, keys = part.probes()
        anchored = (at - part.words.first[part.words.text[at]]) % plan.block == 0
        (keys, owner, anchored), first = _grouped([keys, part.owner(at), anchored.astype(U)], 1)
        many = _reduced(np.maximum, owner, first) != _reduced(np.minimum, owner, first)
        found.append([keys[first], _reduced(np.bitwise_or, anchored, first) * U(2) + many.astype(U)])
    (keys, flags), first = _grouped(_joined(found, 2), 1)
    again = np.diff(np.append(first, len(keys))) > 1  # in several slices, which may be one document's: a hit too many
    keys, flags = keys[first], _reduced(np.bitwise_or, flags, first) | again.astype(U)
    out = plan.blobs(keys << U(64 - plan.bits), lambda x, y: squeeze(np.diff(keys[x:y], prepend=U(0)) * U(4) + flags[x:y]))
    return _blobs(out, rows.column("part")[0].as_py())


def _blobs(rows: list[tuple[int, bytes]], part: int) -> pa.Table:
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "part": pa.array([part] * len(rows), pa.int32()), "blob": pa.array([r[1] for r in rows], pa.binary())})


def _answers(rows: pa.Table, answered) -> pa.Table:
    """To each task, one blob of the pieces that answered() makes of each fine range: it takes the tasks' pieces and gives one a task."""
    packed = [unframed(b.as_py()) for b in rows.column("blob")]
    out: list[list[bytes]] = [[] for _ in packed]
    for k in range(max(map(len, packed), default=0)):
        has = [i for i, p in enumerate(packed) if p[k]]
        for i, piece in zip(has, answered([packed[i][k] for i in has]) if has else []):
            if piece:
                out[i].append(piece)
    keep = [i for i, o in enumerate(out) if o]
    parts, buckets = rows.column("part").to_pylist(), rows.column("bucket").to_pylist()
    return pa.table(
        {"part": pa.array([parts[i] for i in keep], pa.int32()), "bucket": pa.array([buckets[i] for i in keep], pa.int32()), "blob": pa.array([framed(out[i]) for i in keep], pa.binary())}
    )


def _by_source(columns: list[np.ndarray], source: np.ndarray, count: int) -> Iterator[list[np.ndarray]]:
    """The columns' values of each source, in their order."""
    order = np.argsort(source, kind="stable")
    columns, bounds = [c[order] for c in columns], np.searchsorted(source[order], np.arange(count + 1))
    for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield [c[x:y] for c in columns]


def _answer_probes(pieces: list[bytes]) -> list[bytes]:
    packed = [unsqueeze(p) for p in pieces]
    source = np.repeat(np.arange(len(packed)), [len(p) for p in packed])
    keys, flags = np.concatenate([np.cumsum(p >> U(2), dtype=U) for p in packed]), np.concatenate([p & U(3) for p in packed])
    (keys, flags, source), first = _grouped([keys, flags, source], 1)
    size = np.diff(np.append(first, len(keys)))
    seen = _reduced(np.bitwise_or, flags, first)
    hit = np.repeat(((size > 1) | (seen & U(1) > 0)) & (seen & U(2) > 0), size)
    return [squeeze_sorted(k) if len(k) else b"" for (k,) in _by_source([keys[hit]], source[hit], len(pieces))]


def _read(answers: pa.Table) -> Iterator[bytes]:
    """Pieces of the answers in the order of keys."""
    for blob in answers.sort_by("bucket").column("blob"):
        yield from unframed(blob.as_py())


def _send_windows(rows: pa.Table, answers: pa.Table, plan: _Plan) -> pa.Table:
    """Distinct whole windows around hits, with the smallest and the largest id of each in the task."""
    if not rows.num_rows or not answers.num_rows:
        return _blobs([], 0)
    shared = np.concatenate([unsqueeze_sorted(p) for p in _read(answers)])
    found = []
    for part in _slices(rows, plan):
        at, keys = part.probes()
        hit = np.zeros(len(part.words.start) + 1, np.int64)
        hit[at[_is_in(keys, shared)] + 1] = 1
        hit = np.cumsum(hit)
        at = window_starts(part.words, plan.window)
        at = at[hit[at + plan.window - plan.block + 1] > hit[at]]
        (key, check, owner), first = _grouped([*part.whole(at), part.owner(at)], 2)
        found.append([key[first], check[first], _reduced(np.minimum, owner, first), _reduced(np.maximum, owner, first)])
    (key, check, low, high), first = _grouped(_joined(found, 4), 2)
    key, check, low, high = key[first], check[first], _reduced(np.minimum, low, first), _reduced(np.maximum, high, first)
    squeezed = lambda x, y: framed([squeeze_sorted(key[x:y]), squeeze(check[x:y]), squeeze(low[x:y]), squeeze(high[x:y] - low[x:y])])
    return _blobs(plan.blobs(key, squeezed), rows.column("part")[0].as_py())


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the known ones, which are sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _answer_windows(pieces: list[bytes]) -> list[bytes]:
    packed = [unframed(p) for p in pieces]
    parts = [[unsqueeze_sorted(p[0]), *(unsqueeze(x) for x in p[1:])] for p in packed]
    source = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    (key, check, low, more, source), first = _grouped([*_joined(parts, 4), source], 2)
    least = np.repeat(_reduced(np.minimum, low, first), np.diff(np.append(first, len(key))))
    later = low + more > least
    values = _by_source([key[later], check[later], least[later]], source[later], len(pieces))
    return [framed([squeeze_sorted(k), squeeze(c), squeeze(o)]) if len(k) else b"" for k, c, o in values]


def _cut(rows: pa.Table, answers: pa.Table, plan: _Plan) -> pa.Table:
    known = [[unsqueeze_sorted(p[0]), unsqueeze(p[1]), unsqueeze(p[2])] for p in map(unframed, _read(answers))]
    known = _joined(known, 3)
    out = [pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})]
    for batch in rows.select(["doc_id", "text"]).to_batches():
        for few in sliced(batch, 1, plan.slice):
            out.append(_cut_slice(few, _Slice(few, plan), known, plan))
    return pa.concat_tables(out).combine_chunks()


def _cut_slice(batch: pa.RecordBatch, part: _Slice, known: list[np.ndarray], plan: _Plan) -> pa.Table:
    at = window_starts(part.words, plan.window)
    gone = at[:0]
    if len(known[0]) and len(at):
        key, check = part.whole(at)
        order = np.argsort(key, kind="stable")
        i, places, starts = np.searchsorted(known[0], key[order]), order, []
        while len(places):  # keys alike in 64 bits stand together; the check tells them apart
            same = i < len(known[0])
            i, places = i[same], places[same]
            same = known[0][i] == key[places]
            i, places = i[same], places[same]
            right = known[1][i] == check[places]
            starts.append(at[places[right]][known[2][i[right]] < part.owner(at[places[right]])])
            i, places = i[~right] + 1, places[~right]
        gone = np.concatenate(starts)
    depth = np.zeros(len(part.words.start) + 1, np.int64)
    np.add.at(depth, gone, 1)
    np.add.at(depth, gone + plan.window, -1)
    dropped = np.cumsum(depth[:-1]) > 0
    removed = np.bincount(part.words.text[dropped], minlength=len(part.texts))
    kept = []
    for k, text in enumerate(part.texts):
        words = (text.as_py() or "").encode().split()
        if removed[k]:
            lo = part.words.first[k]
            words = compress(words, ~dropped[lo : lo + part.words.count[k]])
        kept.append(b" ".join(words).decode())
    return pa.table({"doc_id": batch.column(0).cast(pa.int64()), "n_words": pa.array(part.words.count, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.string())})


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, text: str = "text", task_bytes: int = TASK_BYTES, fine_keys: int = FINE_KEYS, tasks: int | None = None, ranges: int | None = None, slice_bytes: int = SLICE
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one space) for every row. tasks, ranges: as the size asks for, if not given."""
    plan = _Plan(measure(docs, text)[1], window, task_bytes, fine_keys, tasks, ranges, slice_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = dealt(rows, plan)
    cells = lambda sent, answered: sent.repartition(plan.ranges, "bucket").groupBy("bucket").applyInArrow(lambda t: _answers(t, answered), _BLOBS)
    hits = cells(sent_probes(parts, plan), _answer_probes)
    windows = parts.groupBy("part").cogroup(hits.groupBy("part")).applyInArrow(lambda t, a: _send_windows(t, a, plan), _BLOBS)
    answers = cells(windows, _answer_windows)
    return parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(lambda t, a: _cut(t, a, plan), "doc_id long, n_words long, n_removed long, kept_text string")


def dealt(rows: DataFrame, plan: _Plan) -> DataFrame:
    return rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(plan.tasks)).cast("int")).repartition(plan.tasks, "part")


def sent_probes(parts: DataFrame, plan: _Plan) -> DataFrame:
    """bucket, part, blob: at most one row for each task and range."""
    return parts.groupBy("part").applyInArrow(lambda t: _send_probes(t, plan), _BLOBS)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
