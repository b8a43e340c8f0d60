"""Token counts by a linear longest-match automaton.

Greedy word pieces: a word, preceded by the vocabulary's word mark, is cut from the left into the longest pieces the
vocabulary has. The automaton is a trie of the pieces with failure links: a node's link leads to what is left once the pieces
that are certain by then are popped, and the number of pieces popped is stored with it. One pass over the characters then
gives the count without building pieces. A word that greedy cutting can't finish counts as one unknown token.

Defined results: a null or blank text has no tokens; a very long text or word is counted in one pass, without recursion; a null doc_id is kept as null; repeated rows are each counted; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm.common import table

MARK = "▁"
#: Words whose counts a worker remembers; the memory is bounded, results do not depend on it.
CACHE = 600_000
_UNKNOWN = 1 << 32


class Automaton:
    """Trie with failure links and popped-piece counts."""

    def __init__(self, pieces: Iterable[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                node = self.next[node].setdefault(c, len(self.next))
                if node == len(self.next):
                    self.next.append({})
                    final.append(False)
            final[node] = node > 0
        self.fail, self.pops = [-1] * len(self.next), [0] * len(self.next)
        queue = [0]
        for node in queue:
            for c, child in self.next[node].items():
                queue.append(child)
                if final[child]:
                    self.fail[child], self.pops[child] = 0, 1
                    continue
                at, popped = self.fail[node], self.pops[node]
                while at >= 0 and c not in self.next[at]:
                    popped += self.pops[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[child], self.pops[child] = self.next[at][c], popped

    def count(self, word: str) -> int:
        """Pieces of a word, or -1 if it can't be cut."""
        node, total = 0, 0
        follow, fail, pops = self.next, self.fail, self.pops
        for c in word:
            while c not in follow[node]:
                if fail[node] < 0:
                    return -1
                total += pops[node]
                node = fail[node]
            node = follow[node][c]
        while node:
            if fail[node] < 0:
                return -1
            total += pops[node]
            node = fail[node]
        return total


class _Counts(dict):
    """Word in bytes -> tokens, plus _UNKNOWN for an unknown word; filled on the first sight of a word."""

    def __init__(self, automaton: Automaton, mark: str) -> None:
        super().__init__()
        self.automaton, self.mark = automaton, mark

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(self.mark + word.decode())
        if len(self) >= CACHE:
            self.clear()
        got = self[word] = n if n >= 0 else 1 + _UNKNOWN
        return got


def vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model: no control, unknown or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    skip = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(f(i) for f in skip)]


@functools.lru_cache(maxsize=2)
def _counts(path: str, mark: str) -> _Counts:
    return _Counts(Automaton(vocabulary(path)), mark)


def count_tokens(docs: DataFrame, vocabulary_path: str, mark: str = MARK, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary_path, mark)
        for batch in batches:
            words, sums = [], []
            for body in batch.column(1):
                split = (body.as_py() or b"").split()
                words.append(len(split))
                sums.append(sum(map(counts.__getitem__, split)))
            long = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), long(words), long([s & (_UNKNOWN - 1) for s in sums]), long([s >> 32 for s in sums])], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
