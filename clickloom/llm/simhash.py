"""Near duplicates by SimHash fingerprints, with pigeonring filtering of candidates.

A fingerprint is a ring of segments. If two fingerprints differ in at most ``bits`` of their
``m`` segments, then going round the ring from some segment, the differences of every chain of
``l`` segments stay within ``l * bits / m``. For 3 bits and 8 segments that means: two equal
segments in a row, then at most one difference in the three after them. The index key is
therefore the two equal segments and one of the two halves of the next three, 28 bits from each
of 8 starts; pairs that share a key must pass all chain budgets before the full comparison.

Equal fingerprints are merged first, so copies never meet. Members of one key are compared
inside a task, in blocks of bounded size (a key with more members is cut into blocks, and each
two blocks form a task group of their own). A block gives a spanning forest of its links, never
all its pairs: links keep their components, and a group of k members gives fewer than k rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.words import slices
from clickloom.workspace import materialize

BITS = 3
SEGMENTS = 8
BLOCK = 2048


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``width`` lower-cased words, joined by one space."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([digest(joined[a:b], 42) for a, b in pairs], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if over half the hashes have it."""
    votes = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a : a + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str, width: int) -> DataFrame:
    """All columns but the text, and ``fp``: the fingerprint as big-endian bytes.

    A NULL text counts as empty; without words the fingerprint is zero.
    """
    kept = [c for c in docs.columns if c != text]
    source = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias("_text"))
    schema = source.drop("_text").schema.add("fp", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).cast(pa.large_binary())
            for a, b in slices(texts):
                made = [fingerprint(shingle_hashes(t.as_py(), width)).to_bytes(8, "big") for t in texts.slice(a, b - a)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns[: len(kept)], pa.array(made, pa.binary())], [*kept, "fp"]
                )

    return source.mapInArrow(run, schema)


def pigeonring_keys(fp: Column) -> Column:
    """The 16 index keys of a 64-bit fingerprint given as long, for 3 bits and 8 segments."""
    keys = []
    for start in range(SEGMENTS):
        turned = fp if not start else F.shiftleft(fp, 8 * start).bitwiseOR(
            F.shiftrightunsigned(fp, 64 - 8 * start)
        )
        exact = F.shiftrightunsigned(turned, 48)
        for half in (0, 1):
            part = F.shiftrightunsigned(turned, 36 - 12 * half).bitwiseAND(F.lit(0xFFF))
            mark = F.lit(start * 2 + half).cast("long")
            keys.append(
                F.shiftleft(mark, 28).bitwiseOR(F.shiftleft(exact, 12)).bitwiseOR(part)
            )
    return F.array(*keys)


def chain_ok(diff: np.ndarray, bits: int) -> np.ndarray:
    """Pigeonring test on XOR values of 64 bits: some start keeps all chain budgets."""
    per = np.bitwise_count(diff.view(np.uint8).reshape(-1, SEGMENTS)).astype(np.int16)
    ring = np.concatenate([per, per[:, :-1]], axis=1)
    ok = np.zeros(len(diff), bool)
    budget = (np.arange(1, SEGMENTS + 1) * bits) // SEGMENTS
    # Either way round is a ring of the same segments, so byte order does not matter.
    for start in range(SEGMENTS):
        ok |= (np.cumsum(ring[:, start : start + SEGMENTS], axis=1) <= budget).all(axis=1)
    return ok


def _close(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (fingerprints) differ in at most ``bits``."""
    diff = np.ascontiguousarray(a ^ b)
    ok = np.flatnonzero(chain_ok(diff, bits))
    return ok[np.bitwise_count(diff[ok]) <= bits]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining rows ``a`` with rows ``b``: the smallest row of each whole."""
    while (label[a] != label[b]).any():
        least = np.minimum(label[a], label[b])
        parent = np.arange(len(label))
        np.minimum.at(parent, label[a], least)
        np.minimum.at(parent, label[b], least)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]
    return label


def linked_rows(group: np.ndarray, side: np.ndarray, near_of: Callable) -> list[np.ndarray]:
    """Row pairs that link all close members of each group, given sorted by group.

    Rows are compared with those 1, 2, 3... places on. Rows already joined are not compared
    again, so a tight group costs little and gives about as many pairs as it has members. Rows
    of one side (1 or 2) of two blocks are not compared: their own block does that.
    """
    label = np.arange(len(group))
    out = []
    for lag in range(1, len(group)):
        a = np.flatnonzero(group[lag:] == group[:-lag])
        if not len(a):
            break
        a = a[(label[a] != label[a + lag]) & ((side[a] == 0) | (side[a] != side[a + lag]))]
        for at in range(0, len(a), 1 << 16):
            part = a[at : at + (1 << 16)]
            near = part[near_of(part, part + lag)]
            if len(near):
                out.append(np.stack([near, near + lag]))
        if out and len(a):
            near = np.concatenate([x for x in out if x[1][0] - x[0][0] == lag] or [np.zeros((2, 0), int)], axis=1)
            label = _merge(label, near[0], near[1])
    return out


def _compare(near: Callable) -> Callable:
    """Task code that links the members of groups; ``near`` makes of their last column the test of
    row pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def links_of(table: pa.RecordBatch) -> pa.RecordBatch:
            group = table.column(0).to_numpy(zero_copy_only=False)
            side = table.column(1).to_numpy(zero_copy_only=False)
            test = near(table.column(table.num_columns - 1))
            pairs = np.concatenate([np.zeros((2, 0), np.int64), *linked_rows(group, side, test)], axis=1)
            u, v = (table.column(2).take(pa.array(end)) for end in pairs)
            return pa.RecordBatch.from_arrays([u, v], ["u", "v"])

        def one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

        # Rows come sorted by group; the last group of a batch may go on in the next one.
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            last = batch.column(0)[batch.num_rows - 1]
            if held[0].column(0)[0] == last:
                continue
            cut = int(np.flatnonzero(batch.column(0).to_numpy(zero_copy_only=False) == last.as_py())[0])
            held[-1] = batch.slice(0, cut)
            yield links_of(one([b for b in held if b.num_rows]))
            held = [batch.slice(cut)]
        if held:
            yield links_of(one(held))

    return run


def links(keyed: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` among distinct fingerprints that share a key, from ``(fp, key)``.

    The result connects whatever the full set of links connects, with about as many rows for
    each key as it has members.
    """
    # Keys are long: most have one member and need go no further.
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")

    def near(column: pa.Array) -> Callable:
        fps = np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64)
        return lambda a, b: _close(fps[a], fps[b], bits)

    return _linked(keyed.join(sizes, "key"), block, near)


def _linked(met: DataFrame, block: int, near: Callable) -> DataFrame:
    """Links among the rows ``(fp, key, n)`` of each key, of which there are ``n``; further columns
    go to the tasks too."""
    more = [c for c in met.columns if c not in ("fp", "key", "n")]
    met = met.select("fp", *more, "key", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("n"))
    mine = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    spread = met.select(
        "fp", *more, "key", mine.alias("mine"),
        F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"),
    )
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(low == high, 0).when(F.col("mine") == low, 1).otherwise(2).cast("int")
    grouped = spread.select(F.xxhash64("key", low, high).alias("group"), side.alias("side"), "fp", *more)
    return (
        grouped.repartition("group").sortWithinPartitions("group", "side", "fp")
        .mapInArrow(_compare(near), "u binary, v binary")
        .distinct()
    )


def groups(docs: DataFrame, text: str = "text", width: int = 3, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all documents, and the component of every linked fingerprint.

    Returns ``(rows, linked)``: the documents' other columns with ``fp``, and ``(node, root)``
    for each fingerprint that has a link to another. Links are complete for up to 3 bits.
    """
    if bits > BITS:
        raise ValueError(f"fingerprints are indexed for {BITS} bits at most")
    rows = materialize(with_fingerprint(docs, text, width), "simhash")
    keys = pigeonring_keys(F.conv(F.hex("fp"), 16, -10).cast("long"))
    keyed = rows.select("fp").distinct().select("fp", F.explode(F.array_distinct(keys)).alias("key"))
    return rows, components(links(keyed, bits), "simhash-links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, a row per document.

    Fingerprints of 3-word shingles link at 3 or fewer differing bits; the component is the
    smallest id reachable. NULL ids take part but give no id: a component without any other
    has NULL. Repeated rows are returned as often as given.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows, linked = groups(source, "text")
    # Ids are folded into one per fingerprint before components meet.
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    whole = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = materialize(rooted.join(whole, "root").select("fp", "component_id"), "simhash-groups")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, bits: int = BITS) -> DataFrame:
    """The documents without near duplicates: of each component of fingerprints (see
    :func:`near_duplicates`) the smallest id stays (a NULL id only where there is no other), with the
    columns as given. Of rows that agree in all columns one stays."""
    simple = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    keys = [F.xxhash64(F.lit(i), *(F.col(f"`{c}`") for c in simple)) for i in (1, 2)]
    # The second hash takes the columns the other way round, so both are needed to collide.
    keys[1] = F.xxhash64(F.lit(2), *(F.col(f"`{c}`") for c in reversed(simple)))
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), keys[0].alias("k1"), keys[1].alias("k2"),
        F.col(f"`{text}`").alias("text"),
    )
    rows, linked = groups(narrow, "text", width, bits)
    root = rows.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        F.coalesce("root", "fp").alias("root"), F.struct(F.isnull("doc_id"), "doc_id", "k1", "k2").alias("row")
    )
    first = root.groupBy("root").agg(F.min("row").alias("row")).select("row.k1", "row.k2")
    whole = docs.select(
        keys[0].alias("k1"), keys[1].alias("k2"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    )
    kept = whole.join(first, ["k1", "k2"], "left_semi")
    return kept.groupBy("k1", "k2").agg(F.first("doc").alias("doc")).select("doc.*")
