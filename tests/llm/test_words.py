from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from clickloom.llm.words import Texts, runs, slices, spread

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\r\x0b\x0c€\x85　 ", max_size=20)), max_size=6)


@given(texts)
def test_words_are_those_of_the_pattern(values):
    made = Texts(pa.array(values, pa.string()))
    words = [re.findall(r"[^\x20\x09-\x0D]+", v or "") for v in values]
    flat = [w for ws in words for w in ws]
    assert made.n_words.tolist() == [len(ws) for ws in words]
    assert [bytes(made.data[a:b]).decode() for a, b in zip(made.starts, made.ends)] == flat
    assert len(set(made.hashes().tolist())) == len(set(flat))


@given(texts)
def test_windows_stay_within_texts(values):
    made = Texts(pa.array(values, pa.string()))
    owner = made.text_of_word()
    n = max(len(owner) - 2, 0)
    assert made.whole(3).tolist() == [bool(owner[i] == owner[i + 2]) for i in range(n)]
    flat = [bytes(made.data[a:b]) for a, b in zip(made.starts, made.ends)]
    grams = [tuple(flat[i : i + 3]) for i in range(n)]
    for second in (False, True):
        h = made.windows(made.hashes(), 3, second).tolist()
        assert len(set(zip(grams, h))) == len(set(grams)) == len(set(h))


@given(texts, st.integers(1, 30))
def test_slices_cover_all_rows_once(values, limit):
    column = pa.array(values, pa.string())
    cut = list(slices(column, limit))
    assert [i for a, b in cut for i in range(a, b)] == list(range(len(values)))


def test_a_slice_of_a_column_is_read_from_its_own_start():
    column = pa.array(["x y", "é z", None, "w"], pa.string()).slice(1, 2)
    made = Texts(column)
    assert made.n_words.tolist() == [2, 0]
    assert bytes(made.data) == "é z".encode()


def test_spread_and_runs():
    mask = spread(np.array([0, 3]), 2, 6)
    assert mask.tolist() == [True, True, False, True, True, False]
    assert runs(mask).tolist() == [0, 2, 3, 5]
