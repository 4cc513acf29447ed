from __future__ import annotations

import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from clickloom.llm import decontamination as dc

SCHEMA = "doc_id long, text string, item string, score int"


def smith_waterman(a, b):
    best, h = 0, np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if x == y else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return int(h.max())


words = st.lists(st.integers(5, 9), max_size=12)


@given(st.lists(st.tuples(words, words), min_size=1, max_size=4))
def test_alignment_equals_the_textbook(pairs):
    items = [np.array(a, np.uint64) for a, _ in pairs]
    passages = [np.array(b, np.uint64) for _, b in pairs]
    if max(map(len, passages)) == 0:
        passages[0] = np.array([1000], np.uint64)
    scores, _ = dc.align(items, passages)
    assert scores.tolist() == [smith_waterman(a.tolist(), b.tolist()) for a, b in zip(items, passages)]


def make(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randrange(15, 40))] for _ in range(12)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    return items, text


def test_exact_edited_and_clean(spark):
    rng = random.Random(9)
    items, text = make(rng)
    rows, leaks = [], set()
    for i, item in enumerate(items):
        rows.append((i, text(60) + item + text(60)))
        leaks.add((i, i))
        edited = list(item)
        edited[9] = "changed"
        del edited[4]
        rows.append((100 + i, text(30) + [w.upper() + "," for w in edited] + text(10)))
        leaks.add((100 + i, i))
        rows.append((200 + i, text(200) + item[:5] + text(20)))
    df = spark.createDataFrame([(i, " ".join(w), "x", 1) for i, w in rows], SCHEMA)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    for block in (50, 500_000):
        got = dc.contaminated(df, bench, block_words=block).selectExpr("doc.doc_id", "item_id", "score", "start_word", "end_word").collect()
        assert {(r.doc_id, r.item_id) for r in got} == leaks
    by = {(r.doc_id, r.item_id): r for r in got}
    for i, item in enumerate(items):
        assert by[i, i].score == 1.0 and by[i, i].end_word == 60 + len(item)
        assert by[i, i].start_word <= 60
    kept = dc.without_leaks(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(range(200, 212))


def test_nulls_empty_long_and_repeated_rows(spark):
    item = " ".join(f"i{k}" for k in range(20))
    rows = [(1, None), (2, ""), (None, item), (3, item), (3, item), (4, "x " * 30000 + item), (5, "i1 i2"), (3, "other")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    bench = spark.createDataFrame(
        [(7, item), (7, item), (8, None), (9, ""), (10, "i1 i2"), (None, "z " * 9)], "item_id long, text string"
    )
    got = sorted(((r.doc_id, r.item_id, r.score) for r in dc.leak_report(df, bench).collect()), key=repr)
    assert got == sorted([(None, 7, 1.0), (3, 7, 1.0), (3, 7, 1.0), (4, 7, 1.0)], key=repr)
    left = sorted((r.doc_id for r in dc.without_leaks(df, bench).collect()), key=repr)
    assert left == [1, 2, 3, 5]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d", "x", 1)], SCHEMA)
    assert dc.leak_report(docs, bench).collect() == []
    assert dc.leak_report(some, bench).collect() == []
    assert dc.without_leaks(some, bench).count() == 1


def test_copies_edited_everywhere(spark):
    """Edits every 2 to 8 words, the untouched item elsewhere: all that the alignment accepts is found."""
    rng = random.Random(4)
    items, text = make(rng)
    items = items[:4] + [["the", "of"] * 9, [f"w{k % 5}" for k in range(20)]]
    rows = []
    for i, item in enumerate(items):
        rows += [(1000 * i, text(40) + item + text(40)), (1000 * i + 1, text(20) + item + text(20))]
        for step in range(2, 9):
            for first in range(min(step, 3)):
                changed, added, dropped = [], [], []
                for k, w in enumerate(item):
                    at = k % step == first
                    changed.append("zz" if at else w)
                    added += [w, "zz"] if at else [w]
                    dropped += [] if at else [w]
                for kind, copy in enumerate((changed, added, dropped)):
                    rows.append((1000 * i + 100 * kind + 10 * step + first, text(30) + copy + text(30)))
        rows.append((1000 * i + 500, text(10) + [x for w in item for x in (w, "zz")] + text(10)))
    numbers = {}
    code = lambda ws: np.array([numbers.setdefault(w, len(numbers) + 2) for w in ws], np.uint64)
    want = set()
    for j, item in enumerate(items):
        scores, _ = dc.align([code(item)] * len(rows), [code(w) for _, w in rows])
        want |= {(rows[k][0], j) for k in np.flatnonzero(scores >= len(item))}
    df = spark.createDataFrame([(i, " ".join(w), "x", 1) for i, w in rows], SCHEMA)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    for block in (100, 500_000):
        got = {(r.doc_id, r.item_id) for r in dc.leak_report(df, bench, block_words=block).collect()}
        assert got == want
    assert sum(d // 1000 == j and d % 1000 >= 5 for d, j in want) > 100
