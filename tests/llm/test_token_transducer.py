from __future__ import annotations

import public_tokenizers
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickloom.llm import token_transducer as tt

PATH = public_tokenizers.path("word_bpe_49k.json")
COUNTER, LIBRARY = tt.TokenCounter(PATH), Tokenizer.from_file(PATH)
piece = st.one_of(
    st.sampled_from(["<|endoftext|>", "<|startoftext|>", "'re", "'ll", "'ve", "'s", "''s", "the", "tion", " ", "'v", "'l"]),
    st.text(alphabet="abeilmnorstuvd'́\t\n\x85 éÅΣςİ１2⁵!?.,中カ한😀<|>ﬁ", max_size=8),
)


def expected(texts):
    return [len(LIBRARY.encode(t, add_special_tokens=False).ids) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(piece, max_size=8).map("".join), min_size=1, max_size=4))
def test_counts_equal_the_library(texts):
    assert COUNTER.counts(texts).tolist() == expected(texts)


def test_long_words_and_texts():
    texts = ["a" * 3000, "ab'" * 900, "tion" * 700 + " x", "word " * 3000, ""]
    assert COUNTER.counts(texts).tolist() == expected(texts)


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(tt, "MAX_TRANSITIONS", 50)
    monkeypatch.setattr(tt, "MAX_PIECES", 20)
    own = tt.TokenCounter(PATH)
    texts = [f"some{i} words{i * 7} to see{i}" for i in range(60)]
    for t in texts:
        assert own.counts([t]).tolist() == expected([t])
    assert len(own.pieces) <= 40 and len(own.counter.moves) < 200


def test_maps_compose_like_steps():
    rng = np.random.default_rng(1)
    maps = rng.integers(0, 7, (37, 7)).astype(np.int8)
    scanned = tt.compose(maps)
    for entry in range(7):
        state = entry
        for i, m in enumerate(maps):
            state = m[state]
            assert scanned[i, entry] == state


def test_operator(spark):
    rows = [(1, "Don't stop"), (2, None), (None, ""), (3, "é " * 20000), (1, "Don't stop"), (4, "x<|endoftext|>y")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_tokens int")
    got = sorted((tuple(r) for r in tt.count_tokens(df, PATH).collect()), key=repr)
    want = [(d, len((t or "").encode()), n) for (d, t), n in zip(rows, expected([t or "" for _, t in rows]))]
    assert got == sorted(want, key=repr)
    assert tt.count_tokens(df.limit(0), PATH).collect() == []
