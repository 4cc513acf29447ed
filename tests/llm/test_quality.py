from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from clickloom.llm import boosting, quality, stats
from clickloom.llm.words import Texts

SCHEMA = "doc_id long, text string, score string, quality int"


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


@given(st.lists(st.text(alphabet="ab #*\n\té|", max_size=80), max_size=4))
def test_base_counts_equal_brute_force(texts):
    texts = [t + "a b c " * (len(t) % 7) for t in texts]
    made = Texts(pa.array(texts, pa.string()))
    base = stats.base_counts(made, made.hashes())
    assert list(zip(*(base[n].tolist() for n in stats.BASE))) == [brute_counts(t) for t in texts]


def data(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 3))
    return x, ((x[:, 0] + 0.3 * rng.random(n) > 0.6) ^ (x[:, 2] > 0.97)).astype(float)


def test_trees_learn_and_score_alike_in_flat_form():
    x, y = data()
    forest = boosting.train(x, y, trees=20)
    assert ((forest.score(x) > 0.5) == y).mean() > 0.9

    def walk(row, node):
        while forest.feature[node] >= 0:
            node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        return forest.value[node]

    for row, margin in zip(x[:50], forest.margin(x[:50])):
        assert abs(forest.base + sum(walk(row, r) for r in forest.roots) - margin) < 1e-9


def test_monotone_features_never_turn():
    x, y = data()
    y = np.where(np.random.default_rng(2).random(len(y)) < 0.2, 1 - y, y)
    forest = boosting.train(x, y, {0: 1, 1: -1}, trees=30)
    for row in x[:40]:
        line = np.repeat(row[None], 101, 0)
        line[:, 0] = np.linspace(-1, 2, 101)
        assert (np.diff(forest.margin(line)) >= -1e-12).all()
        line = np.repeat(row[None], 101, 0)
        line[:, 1] = np.linspace(-1, 2, 101)
        assert (np.diff(forest.margin(line)) <= 1e-12).all()
    assert len(forest.roots)


def test_without_rows_or_with_one_label_the_score_is_constant():
    none = boosting.train(np.zeros((0, 3)), np.zeros(0))
    assert none.score(np.random.default_rng(0).random((4, 3))).tolist() == [0.5] * 4
    ones = boosting.train(np.random.default_rng(0).random((9, 3)), np.ones(9))
    assert len(set(ones.score(np.random.default_rng(3).random((4, 3))).tolist())) == 1


def corpus(n=400):
    rng = random.Random(3)
    words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}" for _ in range(90)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(25, 120))]
        good = i % 4 > 0
        if not good:
            text = [w.upper() + "!!" if i % 8 else w + "$$$" for w in text]
        rows.append((i, " ".join(text), "x", 7))
        labels.append((i, int(good)))
    return rows, labels


ODD = [(900, None, "x", 1), (901, "", "x", 1), (None, "one two", "x", 1), (902, "w " * 30000, "x", 1), (0, "again", "x", 1)]


def test_classifier(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + ODD, SCHEMA)
    marks = spark.createDataFrame([*labels, (None, 1), (5000, None), (7, 1)], "doc_id long, quality int")
    got = quality.quality_report(docs, marks).collect()
    assert len(got) == len(rows) + len(ODD)
    known = dict(labels)
    for r in got:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in got if r.held_out and r.doc_id in known]
    assert np.mean([r.predicted == known[r.doc_id] for r in held]) > 0.95
    # Held-out labels do not matter.
    turned = marks.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    again = {(r.doc_id, r.score) for r in quality.quality_report(docs, turned).collect()}
    assert again == {(r.doc_id, r.score) for r in got}


def test_keep_good_keeps_columns(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = quality.keep_good(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, good in labels if good}


def test_rules(spark):
    rows, labels = corpus()
    rows = rows + ODD + [(903, "same words in a line that comes back again\n" * 9, "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = quality.rules_report(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(t or "")
    known, right = dict(labels), []
    for r in got:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts in [brute_counts(t) for t in texts[r.doc_id]]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
        if not r.base_failed and r.doc_id in known:
            right.append(r.kept == bool(known[r.doc_id]))
    assert len(got) == len(rows) and np.mean(right) > 0.95


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame(ODD, SCHEMA)
    assert quality.quality_report(docs, labels).collect() == []
    assert quality.rules_report(docs, labels).collect() == []
    assert {r.score for r in quality.quality_report(some, labels).collect()} == {0.5}
