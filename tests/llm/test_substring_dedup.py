from __future__ import annotations

import random
import re
from collections import Counter

from clickloom.llm.substring_dedup import remove_repeats

SCHEMA = "doc_id long, text string, spans string, place int"


def brute(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = {k for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for k in range(i, i + width)}
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def run(spark, rows, width, parts=3):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in remove_repeats(df, width=width).collect()), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    shared = [[rng.choice("abcdefgh") for _ in range(30)] for _ in range(5)]
    rows = []
    for i in range(120):
        words = [rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(3)):
            at, piece, cut = rng.randrange(len(words) + 1), rng.choice(shared), rng.randrange(4, 30)
            words[at:at] = piece[rng.randrange(5) : cut]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    for width in (5, 8):
        assert run(spark, rows, width) == brute(rows, width)


def test_nulls_empty_long_and_repeated_rows(spark):
    passage = " ".join(f"p{i}" for i in range(9))
    rows = [
        (1, None), (2, ""), (None, passage), (None, passage), (3, "a " * 5000), (4, " \n\t"),
        (5, f"x {passage} y"), (6, "one two three"), (7, "é " + " ".join(f"u{i}" for i in range(20000))),
        (7, "other text of the same id"), (8, passage + " z"), (8, passage + " z"),
    ]
    assert run(spark, rows, 6) == brute(rows, 6)


def test_a_passage_of_very_many_documents(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"a{i} b{i} {passage} c{i}") for i in range(400)] + [(i, f"q{i} r{i}") for i in range(400, 800)]
    assert run(spark, rows, 35, parts=7) == brute(rows, 35)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
