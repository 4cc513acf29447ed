from __future__ import annotations

import random

import numpy as np
import xxhash
from hypothesis import given
from hypothesis import strategies as st

from clickloom.llm import simhash
from clickloom.llm.components import components

SCHEMA = "doc_id long, text string, fp string, root int"


def fp_of(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [fp_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc)
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in ids.items()}
    return sorted(((doc, f"{fps[i]:016x}", least[root(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        words = [rng.choice("ABCdefgh") + str(rng.randrange(9)) for _ in range(rng.randrange(1, 200))]
        rows.append((i, " ".join(words)))
        for k in range(rng.randrange(5)):
            other = list(words)
            other[rng.randrange(len(other))] = "new"
            rows.append((1000 + 10 * i + k, "\n".join(other).upper() if k % 2 else " ".join(other)))
    assert run(spark, rows) == brute(rows)


def test_nulls_empty_long_and_repeated_rows(spark):
    rows = [
        (5, None), (4, ""), (None, " \t"), (None, "alone here"), (None, "x y z w"), (9, "x y z w"), (9, "x y z w"),
        (8, "word " * 30000), (7, "one"), (6, "ONE"), (3, "É a b c"), (2, "é a b c"),
    ]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []


@given(st.lists(st.integers(0, 63), min_size=0, max_size=3, unique=True), st.integers(0, 2**64 - 1))
def test_close_fingerprints_pass_the_chain_test(flips, base):
    diff = np.array([sum(1 << f for f in flips)], np.uint64)
    assert simhash.chain_ok(diff, 3).all()


def test_close_fingerprints_share_a_key(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        a = rng.getrandbits(64)
        b = a
        for f in rng.sample(range(64), 3):
            b ^= 1 << f
        signed = [x - 2**64 if x >= 2**63 else x for x in (a, b)]
        rows.append((i, *signed))
    df = spark.createDataFrame(rows, "i int, a long, b long")
    shared = df.select(
        simhash.F.arrays_overlap(simhash.pigeonring_keys(simhash.F.col("a")), simhash.pigeonring_keys(simhash.F.col("b"))).alias("ok")
    )
    assert all(r.ok for r in shared.collect())


def test_blocks_of_a_large_key_keep_all_links(spark):
    """One key with many more members than a block: the same components as one block."""
    rng = random.Random(3)
    members = set()
    while len(members) < 300:
        members.add(0xABCD << 48 | rng.choice([0, 1, 3, 7, 0xFF, 0xFFF, 0xFFFF]) ^ (1 << rng.randrange(20)) | rng.randrange(4) << 30)
    fps = spark.createDataFrame([(bytearray(m.to_bytes(8, "big")), 1) for m in members], "fp binary, key long")
    found = {}
    for block in (7, 5000):
        linked = components(simhash.links(fps, 3, block)).collect()
        found[block] = {bytes(r.node): bytes(r.root) for r in linked}
        assert simhash.links(fps, 3, 5000).count() < 4 * len(members)
    assert found[7] == found[5000]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u int, v int")).collect()}
    expected = {i: 0 for i in range(1, 51)} | {k: 100 for k in range(101, 160)} | {201: 200}
    assert got == expected


def kept_by_hand(rows):
    """The smallest id of each component; a NULL id only where there is no other."""
    return sorted({c if c is not None else "none" for _, _, c in brute(rows)}, key=repr)


def test_one_of_each_group_stays(spark):
    """Copies, near copies by fewer or more than 3 bits, NULLs and repeated rows."""
    rng = random.Random(5)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(500)}" for _ in range(120)]
        rows += [(i, " ".join(words)), (300 + i, " ".join(words).upper())]
        for k in range(1, 4):
            other = list(words)
            for at in rng.sample(range(120), k):
                other[at] = "changed"
            rows.append((100 * k + 500 + i, " ".join(other)))
    rows += [rows[0], (None, rows[2][1]), (1500, None), (1501, ""), (None, "only without an id")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted(("none" if r.doc_id is None else r.doc_id for r in kept.collect()), key=repr)
    assert ids == kept_by_hand(rows)
    assert 41 < len(ids) < 160
