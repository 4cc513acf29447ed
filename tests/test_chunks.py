from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators.chunks import chunked_values
from clickloom.operators.skew import hot_keys


def by_hand(rows, chunk_bytes):
    groups, out = {}, {}
    for *group, value in rows:
        if value is not None:
            groups.setdefault(tuple(group), set()).add(value)
    for group, values in groups.items():
        at, cut = 0, {}
        for n, value in enumerate(sorted(values)):
            cut.setdefault(at // chunk_bytes, (n, []))[1].append(value)
            at += len(str(value).encode()) + 1
        for chunk, (position, part) in enumerate(cut[c] for c in sorted(cut)):
            out[(*group, chunk)] = (position, part)
    return out


def found(df, n):
    return {tuple(r)[: n + 1]: (r["position"], r["values"]) for r in df.collect()}


@pytest.mark.parametrize("target", [10, 10**6])
def test_chunks_equal_lists_by_hand(spark, target):
    """Hot groups in pieces, a NULL group, repeated and long values."""
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", "c", None]), rng.randrange(2), rng.choice(["é", "x" * 90, None, ""]) if rng.random() < 0.1
             else f"v{rng.randrange(400)}") for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, h int, v string").repartition(5)
    got = chunked_values(df, ["g", "h"], "v", 40, target_rows=target, fraction=1)
    assert found(got, 2) == by_hand(rows, 40)
    numbers = df.select("g", F.length("v").alias("v"))
    assert found(chunked_values(numbers, "g", "v", 3, target_rows=target, fraction=1), 1) == by_hand(
        [(g, None if v is None else len(v)) for g, _, v in rows], 3
    )


def test_a_group_of_millions_of_values(spark):
    """No row holds more than a chunk and one value, and no task more than its piece."""
    n = 2_000_000
    df = spark.range(n).select(F.lit("hot").alias("g"), F.format_string("%09d", F.col("id")).alias("v"))
    hot = hot_keys(df, "g", target_rows=250_000)
    assert [h["g"] for h in hot] == ["hot"] and 7 <= hot[0]["_chunks"] <= 9
    made = chunked_values(df, "g", "v", 100_000, hot)
    rows = made.select("chunk", "position", F.size("values").alias("n"), F.element_at("values", 1).alias("first"),
                       F.element_at("values", -1).alias("last")).orderBy("chunk").collect()
    assert len(rows) == n // 10_000
    assert all((r["chunk"], r["position"], r["n"]) == (i, i * 10_000, 10_000) for i, r in enumerate(rows))
    assert all((int(r["first"]), int(r["last"])) == (r["position"], r["position"] + 9999) for r in rows)


def test_no_rows(spark):
    df = spark.createDataFrame([(1, None)], "g int, v string")
    assert chunked_values(df, "g", "v").collect() == []
    assert chunked_values(df.limit(0), "g", "v").columns == ["g", "chunk", "position", "values"]
