from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from clickloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, target string, h int"


def brute(rows):
    """Targets by resharing again and again; documents in hash order."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in names}
    target, left, budget = {}, set(names), 1.5 * sum(size)
    while left:
        level = budget / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * level > 2 * total[s]} or None
        if over is None:
            target |= {s: weight[s] * level for s in left}
            break
        target |= {s: 2.0 * total[s] for s in over}
        budget -= sum(2 * total[s] for s in over)
        left -= over
    out = []
    for s in names:
        mine = {}
        for (doc, text, source), n in zip(rows, size):
            if source == s:
                key = f"{'' if doc is None else doc}:{text or ''}".encode()
                mine.setdefault(int(hashlib.md5(key).hexdigest()[:15], 16), []).append((doc, n))
        times = int(target[s] // total[s]) if total[s] else 0
        rest, before = target[s] - times * total[s], 0
        for h in sorted(mine):
            words = sum(n for _, n in mine[h])
            more = 2 * before + words < 2 * rest
            out += [(doc, n, total[s], pytest.approx(target[s]), n * (times + more)) for doc, n in mine[h]]
            before += words
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = [tuple(r) for r in mixing.mix_report(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[4])
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    return df


def test_equals_brute_force(spark):
    rows = [(i, "w " * (i * 7 % 50), f"s{i % 7}") for i in range(900)]
    rows += [(i, "a b c", "big") for i in range(1000, 2500)] + [(9000, "x " * 4000, "one"), (9001, "y", None)]
    check(spark, rows)


def test_nulls_empty_and_repeated_rows(spark):
    check(spark, [
        (1, None, "a"), (2, "", "a"), (None, "x y", "b"), (None, "x y", "b"), (None, "z", "b"), (3, "q " * 20000, None),
        (4, "w", "c"), (4, "w", "c"), (4, "other", "c"), (5, "t", ""),
    ])
    check(spark, [(1, None, None)])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_report(empty).collect() == []
    assert mixing.mix(empty).collect() == []


def test_mix_repeats_rows_as_reported(spark):
    rows = [(i, "w " * (i % 9 + 1), "s" if i % 3 else None) for i in range(300)]
    df = check(spark, rows)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    count = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for r in mixing.mix_report(df).collect():
        assert count.get(r.doc_id, 0) * r.size == r.taken


def test_the_boundary_is_refined_down_to_single_hashes(spark):
    """Hashes that agree in their upper bits still part at the right place."""
    rows = spark.range(400).select(
        F.lit("s").alias("source"), F.lit(10).cast("long").alias("size"), (F.lit(7 << 40) + F.col("id")).alias("h")
    )
    plan = spark.createDataFrame([("s", 4000, 1234.0)], "source string, source_size long, target double")
    made = mixing.thresholds(rows, plan).first()
    assert (made.times, made.below) == (0, (7 << 40) + 123)
