from __future__ import annotations

import random

import public_tokenizers
from helpers import ODD, documents, frame, save

from inkmill.llm.tokencount import MARK, Automaton, op8_token_counts, vocabulary


def greedy(pieces, longest, word):
    n, i = 0, 0
    while i < len(word):
        for k in range(min(longest, len(word) - i), 0, -1):
            if word[i : i + k] in pieces:
                n, i = n + 1, i + k
                break
        else:
            return -1
    return n


def test_automaton_equals_greedy_cutting():
    rng = random.Random(2)
    for _ in range(300):
        pieces = {"".join(rng.choices("abc", k=rng.randrange(1, 6))) for _ in range(rng.randrange(1, 14))}
        auto = Automaton(sorted(pieces))
        for _ in range(60):
            word = "".join(rng.choices("abcd", weights=(5, 5, 5, 1), k=rng.randrange(12)))
            assert auto.count(word) == greedy(pieces, 6, word), (pieces, word)


def row(pieces, longest, text):
    words = (text or "").encode().split()
    counts = [greedy(pieces, longest, MARK + w.decode()) for w in words]
    return len(words), sum(c if c >= 0 else 1 for c in counts), sum(c < 0 for c in counts)


def test_documents_and_odd_texts(spark, sf, tmp_path):
    pieces = set(vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    longest = max(map(len, pieces))
    texts = documents(sf).set_index("doc_id").text[:80].to_dict()
    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in op8_token_counts(spark, sf).collect()}
    assert all(got[i] == row(pieces, longest, t) for i, t in texts.items())
    df = frame(spark, ODD)
    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in op8_token_counts(spark, save(df, tmp_path)).collect()}
    assert got == {i: row(pieces, longest, t) for i, t in enumerate(ODD)}
    assert op8_token_counts(spark, save(df.limit(0), tmp_path)).count() == 0
