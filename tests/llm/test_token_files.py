from __future__ import annotations

import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickloom.llm import token_files
from clickloom.llm.token_cache import ChunkEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start string, shard int"


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70))
def test_packing_round_trip(bits, ids):
    ids = np.array(ids, "<u4") >> np.uint32(32 - bits)
    data = token_files.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert token_files.unpack(data, bits, len(ids)).tolist() == ids.tolist()


@given(st.lists(st.lists(st.integers(0, 1000), max_size=9), max_size=12), st.integers(0, 40), st.integers(0, 40))
def test_files_and_random_access(docs, a, b):
    out = io.BytesIO()
    out.close, data = lambda: None, None
    writer = token_files.Writer(out, 10, block=4)
    for i, ids in enumerate(docs):
        writer.add(None if i % 3 == 2 else -i, np.array(ids, "<u4"))
    writer.close()
    data = out.getvalue()
    reader = token_files.Reader(pa.BufferReader(data))
    flat = [x for ids in docs for x in ids]
    got = [(d, at, ids.tolist()) for d, at, ids in reader.documents()]
    assert [g[2] for g in got] == docs
    assert [g[0] for g in got] == [None if i % 3 == 2 else -i for i in range(len(docs))]
    a, b = min(a, len(flat)), min(b, len(flat))
    assert reader.ids(a, b).tolist() == flat[a:b]


def test_a_cut_file_is_refused():
    with pytest.raises(ValueError):
        token_files.Reader(pa.BufferReader(token_files._HEAD.pack(b"CLTK", 1, 10, 4) + b"0" * 40))


@given(st.text(alphabet="aB é\t'sre<|>endoftx0́　\x85Σ", max_size=40))
def test_chunks_give_the_ids_of_the_whole_text(text):
    assert ENCODER.ids(text.encode()).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


ENCODER, LIBRARY = ChunkEncoder(PATH), Tokenizer.from_file(PATH)


def brute(rows):
    at, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("shard_bytes", [300, 1 << 20])
def test_written_and_read_back(spark, tmp_path, shard_bytes):
    rows = [(i * 37 % 101, f"text {i} of <|endoftext|> the été " * (i % 5)) for i in range(100)]
    rows += [(None, "no id"), (200, None), (201, ""), (202, "long word " * 20000), (203, "x" * 5000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    token_files.write_tokens(df, f"file://{tmp_path}/t", PATH, shard_bytes=shard_bytes)
    got = token_files.read_digests(spark, f"file://{tmp_path}/t").orderBy("start").collect()
    assert [tuple(r) for r in got] == brute(rows)


def test_repeated_ids_keep_all_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (None, None), (None, "d")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = token_files.token_report(df, PATH).orderBy("start").collect()
    assert sorted(r.n_tokens for r in got) == sorted(b[2] for b in brute(rows))
    assert [r.doc_id for r in got] == [None, None, 1, 1, 1]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()


def test_empty_table(spark):
    assert token_files.token_report(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_caches_are_bounded_and_other_tokenizers_go_whole(monkeypatch):
    from clickloom.llm import token_cache

    monkeypatch.setattr(token_cache, "CHUNKS", 20)
    monkeypatch.setattr(token_cache, "PIECES", 15)
    own = ChunkEncoder(PATH)
    for i in range(40):
        text = f"some{i} words{i * 7}, to see{i} Çé{i} " + "y" * 300
        assert own.ids(text.encode()).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        assert len(own.chunks) <= 20 and len(own.pieces) <= 15
    other = public_tokenizers.path("byte_bpe_50k.json")
    text = "two  spaces\n and 'more'"
    expected = Tokenizer.from_file(other).encode(text, add_special_tokens=False).ids
    assert ChunkEncoder(other).ids(text.encode()).tolist() == expected
