"""Vectorised words, rolling window hashes and compact blobs of sorted keys, for operators that work on whole parts of a table."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1
#: Bytes of text whose words are hashed in one step.
SEGMENT = 1 << 20


def sliced(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most `most` bytes of text (or one row), so that working arrays stay small."""
    sizes = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@functools.lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count - 1) modulo 2**64."""
    return _powers(base, 1 << max(16, (max(count, 1) - 1).bit_length()))[:count]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def give_back() -> None:
    """Hand freed memory back to the system: workers are reused, and what one stage freed would else stay theirs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        return


class Words:
    """Words of a column of texts: byte bounds in `data`, and for each word its text's number."""

    def __init__(self, texts: pa.Array) -> None:
        texts = texts.cast(pa.large_string()).fill_null("")
        self.offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        lo, hi = int(self.offsets[0]), int(self.offsets[-1])
        self.data = np.frombuffer(texts.buffers()[2], np.uint8)[lo:hi] if hi > lo else np.zeros(0, np.uint8)
        self.offsets = self.offsets - lo
        space = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        edge = np.ones(len(space) + 1, bool)  # a text begins here
        edge[1:-1] = False
        edge[self.offsets] = True
        before = np.concatenate(([True], space[:-1])) if len(space) else space
        after = np.concatenate((space[1:], [True])) if len(space) else space
        self.start = np.flatnonzero(~space & (before | edge[:-1]))
        self.end = np.flatnonzero(~space & (after | edge[1:])) + 1
        self.text = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.count = np.bincount(self.text, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.count)))[:-1] if len(texts) else np.zeros(0, np.int64)

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        data = self.data if data is None else data
        out, n, i = np.zeros(len(self.start), U), len(self.start), 0
        while i < n:
            lo = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, lo + SEGMENT, side="right")))
            hi = int(self.end[j - 1])
            sums = np.zeros(hi - lo + 1, U)
            np.cumsum((data[lo:hi].astype(U) + U(1)) * powers(_BYTE_BASE, hi - lo), out=sums[1:])
            s, e = self.start[i:j] - lo, self.end[i:j] - lo
            raw = (sums[e] - sums[s]) * powers(inverse(_BYTE_BASE), hi - lo)[s]
            out[i:j] = mix(raw + (e - s).astype(U) * U(0xA0761D6478BD642F))
            i = j
        return out


class Rolling:
    """Hashes of any run of consecutive words, from prefix sums."""

    def __init__(self, hashes: np.ndarray, base: int = _WORD_BASE) -> None:
        self.sums = np.zeros(len(hashes) + 1, U)
        np.cumsum(hashes * powers(base, len(hashes)), out=self.sums[1:])
        self.back = powers(inverse(base), len(hashes) + 1)

    def at(self, start: np.ndarray, length: int) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.back[start] + U(length))


def window_starts(words: Words, length: int) -> np.ndarray:
    """First words of all windows that lie within one text."""
    n = len(words.start)
    if n < length:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.text[: n - length + 1] == words.text[length - 1 :])


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers, compressed by byte planes: small ones take few bytes."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(blob: bytes) -> np.ndarray:
    width, n = blob[0], int.from_bytes(blob[1:9], "little")
    planes = np.frombuffer(pa.decompress(blob[9:], decompressed_size=width * n, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8").astype(U, copy=False)


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=U(0)))


def unsqueeze_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(blob), dtype=U)


def framed(pieces: list[bytes]) -> bytes:
    """Byte strings behind each other, each after its length."""
    return b"".join(len(p).to_bytes(8, "little") + p for p in pieces)


def unframed(blob: bytes) -> list[bytes]:
    out, i = [], 0
    while i < len(blob):
        n = int.from_bytes(blob[i : i + 8], "little")
        out.append(blob[i + 8 : i + 8 + n])
        i += 8 + n
    return out


def bucket_bounds(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of `buckets` equal ranges of the 64-bit key space begins and ends in sorted keys."""
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=U)
    return np.concatenate(([0], np.searchsorted(sorted_keys, edges), [len(sorted_keys)])).astype(np.int64)


def group_starts(sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
