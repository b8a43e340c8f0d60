"""Best-fit packing of tokenised documents into fixed-length training sequences.

Bounded-space online best fit. Each task keeps at most `open_bins` bins open in a bitset keyed by free space, so "the
tightest bin that still fits" is one shift and one lowest-set-bit. When a bin must be opened beyond the bound, the fullest
one closes first. Pieces reach a task in a fixed pseudo-random order and are placed longest first within each batch.

Defined results: null and empty texts are one end token; every document row gives at least one piece, a very long text as many
full ones as it fills; equal rows are packed each on its own; among bins with equal free space the last used takes a piece; a
null doc_id is kept as null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import array
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm.common import table

MAX_LEN = 4096
END_ID = 1
OPEN_BINS = 4096
#: Words and letter runs that a worker remembers; the memory is bounded, results do not depend on it.
CACHE = 300_000

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Separators to Python's split() that the tokenizer doesn't take for white space.
_CONTROL = re.compile("[\x1c-\x1f]")
#: Apostrophes are left out: they open contractions.
_PLAIN = re.compile(f"([{_LETTERS}]+)([!-&(-/:-@\\[-`{{-~]*)")


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Chunks(dict):
    """White-space-delimited chunk -> ids, filled on the first sight of a chunk."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.alphabet = _byte_alphabet()
        self.runs: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        return array.array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def run(self, run: str) -> bytes:
        key = run if run.isascii() else "".join(map(self.alphabet.__getitem__, run.encode()))
        if len(self.runs) >= CACHE:
            self.runs.clear()
        got = self.runs[run] = array.array("I", [t.id for t in self.model.tokenize(key)]).tobytes()
        return got

    def __missing__(self, chunk: str) -> bytes:
        if m := _PLAIN.fullmatch(chunk):
            word, closing = m.groups()
            word = word.lower()
            got = self.runs.get(word) or self.run(word)
            if closing:
                got += self.runs.get(closing) or self.run(closing)
        else:
            got = self.ids(chunk)
        if len(self) >= CACHE:
            self.clear()
        self[chunk] = got
        return got


class WordEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer never joins across white space, so a text's ids are those of its white-space-delimited chunks in order.
    Chunks repeat, so each is encoded once: letter runs with closing punctuation go straight to the model, any other chunk
    through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        self.chunks = _Chunks(path)

    def encode(self, text: str) -> bytes:
        if _CONTROL.search(text):
            return self.chunks.ids(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokenized_pieces(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, end_id: int = END_ID, with_ids: bool = False, text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and ids when asked for."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode(body.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * max_len)):
                    part = ids[at : at + 4 * max_len]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<u4") if with_ids else None))
            cols = list(zip(*rows)) or [()] * 6
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:5])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(cols[5], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


class BestFit:
    """Online best fit over a bounded number of open bins."""

    def __init__(self, capacity: int, open_bins: int, first_id: int = 0) -> None:
        self.capacity, self.most, self.next_id = capacity, open_bins, first_id
        self.bits, self.open = 0, 0
        self.bins: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        bin_id = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return bin_id

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it of an item of 1 to capacity tokens."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            free, bin_id = self.capacity, self.next_id
            self.next_id += 1
        left = free - length
        if left:
            if self.open >= self.most:
                tightest = (self.bits & -self.bits).bit_length() - 1
                if self.bits and tightest <= left:
                    self._take(tightest)
                else:
                    return bin_id, self.capacity - free
            self.bins.setdefault(left, []).append(bin_id)
            self.bits |= 1 << left
            self.open += 1
        return bin_id, self.capacity - free


def pack(pieces: DataFrame, max_len: int = MAX_LEN, open_bins: int = OPEN_BINS) -> DataFrame:
    """Add sequence_id and offset to rows with doc_id, piece and length (1 to max_len)."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    at = pieces.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = BestFit(max_len, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            lengths = batch.column(at).to_numpy(zero_copy_only=False)
            seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for i in np.argsort(-lengths, kind="stable").tolist():
                seq[i], off[i] = fit.place(int(lengths[i]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seq), pa.array(off)], [*batch.schema.names, "sequence_id", "offset"])

    order = F.xxhash64("doc_id", "piece")
    dealt = pieces.repartition(order).sortWithinPartitions(order, "doc_id", "piece", "ids_crc32")
    return dealt.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, end_id: int = END_ID, open_bins: int = OPEN_BINS, with_ids: bool = False, text: str = "text") -> DataFrame:
    """Tokenise, cut what is longer than max_len, and pack. One row per piece."""
    return pack(tokenized_pieces(docs, tokenizer, max_len, end_id, with_ids, text), max_len, open_bins)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
