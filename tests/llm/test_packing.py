from __future__ import annotations

import math
import zlib

import numpy as np
from helpers import ODD, documents, frame, save
from tokenizers import Tokenizer

from inkmill.llm.packing import BestFit, default_tokenizer, encoder, op1_best_fit_packing, pack_documents


def whole(texts):
    tok = Tokenizer.from_file(default_tokenizer())
    return [[*e.ids, 1] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, ids_of):
    by_seq, by_doc = {}, {}
    for r in rows.itertuples():
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for places in by_seq.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert set(by_doc) == set(ids_of)
    for doc, pieces in by_doc.items():
        ids = np.array(ids_of[doc], "<u4")
        want = [(k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
        assert sorted(pieces) == want
    return len(by_seq)


def test_packs_all_documents_into_few_sequences(spark, sf):
    docs = documents(sf)
    ids = dict(zip(docs.doc_id, whole(docs.text)))
    used = check(op1_best_fit_packing(spark, sf).toPandas(), ids)
    assert used <= math.ceil(sum(map(len, ids.values())) / 4096) * 1.02 + 2


def test_odd_texts(spark, tmp_path):
    df = frame(spark, ODD)
    ids = dict(enumerate(whole(ODD)))
    check(op1_best_fit_packing(spark, save(df, tmp_path)).toPandas(), ids)
    assert op1_best_fit_packing(spark, save(df.limit(0), tmp_path)).count() == 0


def test_ids_are_returned_when_asked_for(spark):
    texts = ["hello world", "don't stop"]
    got = {r.doc_id: list(r.ids) for r in pack_documents(frame(spark, texts), default_tokenizer(), with_ids=True).collect()}
    assert got == dict(enumerate(whole(texts)))


def test_encoder_agrees_with_the_tokenizer_on_unusual_text():
    enc, tok = encoder(default_tokenizer()), Tokenizer.from_file(default_tokenizer())
    marks = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x65E5]]
    for text in ["don't I'LL 's", "<|endoftext|> a<|endoftext|>b", "é", "ΣΑΣ", *(x for c in marks for x in (f"a{c}b", f"é.{c}", f"{c}x", f"a{c}."))]:
        assert enc.encode(text) == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_open_bins_stay_bounded_and_the_fullest_closes():
    fit = BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 4)] == [(0, 0), (1, 0), (0, 6)]
    fit.place(6), fit.place(8)
    assert fit.open == 2 and fit.place(2) == (1, 7)  # bin 3, with 2 free, closed at once


class Plain:
    """Best fit over a list of open bins, as free space and number, the last opened or used one at its end."""

    def __init__(self, capacity, most):
        self.capacity, self.most, self.open, self.next = capacity, most, [], 0

    def _out(self, free):
        at = max(k for k, (f, _) in enumerate(self.open) if f == free)
        return self.open.pop(at)

    def place(self, length):
        fitting = [f for f, _ in self.open if f >= length]
        if fitting:
            free, number = self._out(min(fitting))
        else:
            free, number = self.capacity, self.next
            self.next += 1
        left = free - length
        if left and len(self.open) >= self.most:  # the fullest of all, this one among them, is open no longer
            fullest = min((f for f, _ in self.open), default=left + 1)
            if fullest > left:
                return number, self.capacity - free
            self._out(fullest)
        if left:
            self.open.append((left, number))
        return number, self.capacity - free


def test_random_lengths_go_where_a_plain_search_puts_them():
    import random

    rng = random.Random(7)
    for _ in range(200):
        capacity, most = rng.choice([(10, 3), (64, 8), (4096, 40), (17, 1)])
        fit, plain = BestFit(capacity, most), Plain(capacity, most)
        for _ in range(300):
            length = min(capacity, max(1, int(rng.expovariate(3 / capacity))))
            assert fit.place(length) == plain.place(length)
        assert fit.open == len(plain.open) <= most
