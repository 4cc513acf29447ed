"""The pipeline and the registered queries, against brute force on small tables."""

from __future__ import annotations

import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from clickloom.llm import registry
from test_simhash import kept_by_hand

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Good and bad documents, exact and near copies, leaks, NULLs; an extra column."""
    rng = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfgl" for b in "aeiou" for c in "mnrst"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [text(25) for _ in range(4)]
    docs, labels, expected = [], [], set()
    for i in range(160):
        body = text(rng.randrange(90, 140))
        docs.append([i, " ".join(body)])
        labels.append((i, 1))
        expected.add(i)
        if i % 4 == 0:
            bad = 1000 + i
            docs.append([bad, " ".join(w.upper() + "!!" for w in text(80))])
            labels.append((bad, 0))
        if i % 8 == 1:
            docs += [[2000 + i, " ".join(body)], [3000 + i, " ".join([*body[:60], "zzz", *body[61:]])]]
        if i % 10 == 3:
            docs.append([4000 + i, " ".join(text(60) + items[i % 4] + text(60))])
    rng.shuffle(docs)
    root = str(tmp_path_factory.mktemp("tables") / "t")
    rows = [(i, t, f"s{i % 3}" if i % 5 else None, len(t), "x") for i, t in docs]
    rows.append(rows[0])
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, score string").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"
    ).write.parquet(f"{root}/benchmark.parquet")
    return root, dict(docs), expected


def test_each_stage_and_the_whole(spark, folder, tmp_path):
    root, texts, clean = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, root).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append([r.doc_id for r in docs.select("doc_id").collect()])
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    good, single, safe, mixed, packed = kept
    # Near copies of more than 3 bits stay.
    clean = clean | {i for i in single if 3000 <= i < 4000}
    assert set(good) == {i for i in texts if not 1000 <= i < 2000}
    assert set(single) == set(kept_by_hand([(i, texts[i]) for i in set(good)])) and len(single) == len(set(single))
    assert {i for i in texts if 2000 <= i < 3000}.isdisjoint(single) and clean <= set(single)
    assert len(single) == len(set(single))
    assert set(safe) == clean and len(safe) == len(clean)
    assert set(mixed) <= clean and len(mixed) == len(packed)
    size = {i: len(words(texts[i])) for i in clean}
    assert sum(size[i] for i in mixed) == pytest.approx(1.5 * sum(size.values()), rel=0.05)
    assert max(mixed.count(i) for i in set(mixed)) <= 2
    at = 0
    for r in docs.orderBy("start").collect():
        ids = np.array([*LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_run_gives_the_last_stage(spark, folder):
    root, *_ = folder
    got = corpus_pipeline.run(spark, root)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 100


def test_stages_take_empty_tables(spark, folder):
    root, *_ = folder
    docs = spark.read.parquet(f"{root}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, root).collect() == []


def test_queries_cover_all_operators():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    result = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    got = registry.QUERIES[name](spark, folder).select(*names)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(result.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_queries_return_a_row_for_each_document_or_page(spark, name):
    folder = "/root/testdata/sf0.001"
    rows = registry.QUERIES[name](spark, folder).count()
    table = {"op8": "pages", "op11": "embeddings"}.get(name.split("_")[0], "documents")
    there = spark.read.parquet(f"{folder}/{table}.parquet").count() * (16 if name.startswith("op11_") else 1)
    assert rows <= there if name.startswith("op2_") else rows == there
