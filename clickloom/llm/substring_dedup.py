"""Remove passages of ``width`` or more words that occur elsewhere in the corpus.

Fixed-block anchors. Each document is cut into non-overlapping reference blocks of
``(width + 1) // 2`` words; any run of ``width`` words holds a whole block. The blocks are the
index, and every rolling window of the block length, at every place of every document, probes
it. A place is a hit if its window is a block that the corpus holds twice or more. Hits are then
extended: every ``width``-word window around a hit is looked up by a hash of 88 bits, and those found
twice join into maximal exact repeats.

Both look-ups move hashes, not words: a task sorts the hashes of some millions of places and
sends each range of hashes to its own partition as one packed row. A hash that occurs twice in
one task is sent once, already answered, so no hash gathers more rows than there are tasks.
Positions count from the start of the task's chunk; a small index row, sent to the place where
the answers return, turns them back into documents. Positions stay valid if a task runs again,
as it reads the same rows in the same order: give a table scan or a written table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.words import Texts, runs, slices, spread

WIDTH = 35
#: Places that a task gathers before it sends them on, and characters of text for a partition.
CHUNK = 4_000_000
PARTITION_CHARS = 16 << 20
_U64 = np.uint64
_ROW = "place int, source long, kind int, a binary, b binary, c binary, d binary"
_NAMES = ["place", "source", "kind", "a", "b", "c", "d"]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
_PROBE, _INDEX, _FOUND = 0, 1, 2


def _planes(values: np.ndarray) -> bytes:
    """Integers by byte planes, so that the zeros of small ones compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplanes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    n = len(data) // width
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, n).T).reshape(-1).view(kind)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)


def _home(source: int, parts: int) -> int:
    """The partition where the answers of one chunk meet."""
    return (source * 0x9E3779B1 >> 7) % parts


class _Chunk:
    """Hashes of many places, with what is needed to find their documents again."""

    def __init__(self) -> None:
        self.hashes: list[np.ndarray] = []
        self.extra: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.marks: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.words = self.size = 0

    def add(self, texts: Texts, keys: np.ndarray, places, hashes, extra, marks) -> None:
        self.places.append(places + self.words)
        self.hashes.append(hashes)
        self.extra.append(extra)
        self.marks.append(marks)
        self.keys.append(keys)
        self.lengths.append(texts.n_words)
        self.words += len(texts.starts)
        self.size += max(len(places), len(texts.starts) // 8)

    def rows(self, source: int, parts: int) -> Iterator[pa.RecordBatch]:
        """Probe rows by partition, and the index row; answers known here go with the index."""
        hashes, extra, places, marks = map(np.concatenate, (self.hashes, self.extra, self.places, self.marks))
        # Either kind of hash sorts by partition first.
        order = np.lexsort((extra, hashes)) if extra.dtype != bool else np.argsort(hashes, kind="stable")
        hashes, extra, places, marks = hashes[order], extra[order], places[order], marks[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (extra[1:] != extra[:-1])
        first = np.flatnonzero(fresh)
        many = np.diff(np.append(first, len(hashes))) > 1
        known = places[np.repeat(many, np.diff(np.append(first, len(hashes))))]
        index = (
            _home(source, parts), source, _INDEX, np.concatenate(self.keys).tobytes(),
            np.concatenate(self.lengths).astype("<i8").tobytes(), np.sort(known).astype("<u4").tobytes(), None,
        )
        yield _rows([index])
        if not len(first):
            return
        marks = np.maximum.reduceat(marks.astype(np.uint8), first)
        hashes, extra, places = hashes[first], extra[first], places[first]
        part = (hashes >> _U64(32)).astype(np.int64) if extra.dtype == bool else partition_of(hashes, parts)
        edge = np.searchsorted(part, np.arange(parts + 1))
        out = []
        for p in np.flatnonzero(np.diff(edge)).tolist():
            s = slice(edge[p], edge[p + 1])
            h = hashes[s]
            if extra.dtype == bool:
                packed = _planes(np.diff(h.astype(np.uint32), prepend=np.uint32(0)).astype("<u4"))
            else:
                packed = _planes(np.diff(h, prepend=_U64(0)).astype("<u8")) + _planes(extra[s].astype("<u4"))
            out.append((
                p, source, _PROBE, packed, _planes(places[s].astype("<u4")),
                np.packbits(marks[s].astype(bool)).tobytes(), np.packbits(many[s]).tobytes(),
            ))
            if len(out) == 64:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)


def partition_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partition of a hash: ranges of its upper 32 bits."""
    return ((hashes >> _U64(32)) * _U64(parts) >> _U64(32)).astype(np.int64)


def short_key(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partition and the lower 28 bits of a hash: enough within a partition of bounded size (one
    place in two thousand is taken for a hit), as what is found is looked up once more."""
    return partition_of(hashes, parts).astype(np.uint64) << _U64(32) | hashes & _U64(0xFFFFFFF)


def _send(width: int, block: int, parts: int, exact: bool) -> Callable:
    """First look-up (``exact`` false): every window of a block's length, blocks marked. Second:
    the ``width``-word windows around the hits given in the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, chunk = TaskContext.get().partitionId(), 0, _Chunk()
        for batch in batches:
            keys = np.column_stack([batch.column(i).to_numpy() for i in (0, 1)]).astype("<i8")
            for a, b in slices(batch.column(2)):
                texts = Texts(batch.column(2).slice(a, b - a))
                hashes = texts.hashes()
                n = len(hashes)
                within = np.arange(n) - np.repeat(texts.first[:-1], texts.n_words)
                if exact:
                    hit = np.zeros(n, bool)
                    for i in range(b - a):
                        pairs = np.frombuffer(batch.column(4)[a + i].as_py(), "<u4").reshape(-1, 2)
                        for x, y in (pairs + texts.first[i]).tolist():
                            hit[x:y] = True
                    # Windows that hold the block at a hit start at most width - block before it.
                    reach = spread(np.maximum(np.flatnonzero(hit) - (width - block), 0), width - block + 1, n)
                    places = np.flatnonzero(reach[: max(n - width + 1, 0)] & texts.whole(width))
                    chunk.add(
                        texts, keys[a:b], places, texts.windows(hashes, width)[places],
                        (texts.windows(hashes, width, second=True)[places] & _U64(0xFFFFFF)).astype(np.uint32),
                        np.ones(len(places), bool),
                    )
                else:
                    places = np.flatnonzero(texts.whole(block))
                    made = texts.windows(hashes, block)[places]
                    chunk.add(
                        texts, keys[a:b], places, short_key(made, parts), np.zeros(len(places), bool),
                        within[places] % block == 0,
                    )
                if chunk.size >= CHUNK:
                    yield from chunk.rows((part << 20) + number, parts)
                    number, chunk = number + 1, _Chunk()
        if chunk.keys:
            yield from chunk.rows((part << 20) + number, parts)

    return run


def _answer(parts: int, exact: bool) -> Callable:
    """Find the hashes that occur twice among the rows of a partition, and send back where."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources, hashes, extra, marks, many, places = [], [], [], [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] != _PROBE:
                    yield _rows([tuple(row[n] for n in _NAMES)])
                    continue
                place = _unplanes(row["b"], "<u4")
                n = len(place)
                if exact:
                    hashes.append(np.cumsum(_unplanes(row["a"][: 8 * n], "<u8"), dtype=np.uint64))
                    extra.append(_unplanes(row["a"][8 * n :], "<u4"))
                else:
                    hashes.append(np.cumsum(_unplanes(row["a"], "<u4"), dtype=np.uint32))
                sources.append((row["source"], n))
                places.append(place)
                marks.append(np.unpackbits(np.frombuffer(row["c"], np.uint8), count=n).astype(bool))
                many.append(np.unpackbits(np.frombuffer(row["d"], np.uint8), count=n).astype(bool))
        if not sources:
            return
        h, mark, twice = map(np.concatenate, (hashes, marks, many))
        if exact:
            more = np.concatenate(extra)
            order = np.lexsort((more, h))
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[order][1:] != h[order][:-1]) | (more[order][1:] != more[order][:-1])
            group = np.empty(len(h), np.int64)
            group[order] = np.cumsum(fresh) - 1
            size = np.bincount(group, 1.0 + twice)
            found = size[group] > 1
        else:
            index = np.unique(h[mark])
            at = np.minimum(np.searchsorted(index, h), max(len(index) - 1, 0))
            hit = index[at] == h if len(index) else np.zeros(len(h), bool)
            size = np.bincount(at[hit], 1.0 + twice[hit], len(index))
            found = hit.copy()
            found[hit] = size[at[hit]] > 1
        found &= ~twice  # those are answered where they came from
        at = 0
        for (source, n), place in zip(sources, places):
            back = place[found[at : at + n]]
            at += n
            if len(back):
                yield _rows([(_home(source, parts), source, _FOUND, _planes(np.sort(back)), None, None, None)])

    return run


def _gather() -> Callable:
    """Turn the answers of each chunk, which come together, into runs of places by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        last = None

        def out(rows: list[dict]) -> pa.RecordBatch:
            index = next(r for r in rows if r["kind"] == _INDEX)
            keys = np.frombuffer(index["a"], "<i8").reshape(-1, 2)
            first = np.concatenate([[0], np.cumsum(np.frombuffer(index["b"], "<i8"))])
            found = [np.frombuffer(index["c"], "<u4")]
            found += [_unplanes(r["a"], "<u4") for r in rows if r["kind"] == _FOUND]
            mask = np.zeros(first[-1], bool)
            mask[np.concatenate(found)] = True
            some = np.flatnonzero(np.add.reduceat(np.append(mask, False), first[:-1]) * (np.diff(first) > 0))
            spans = [runs(mask[first[i] : first[i + 1]]).astype("<u4").tobytes() for i in some.tolist()]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[some, 0]), pa.array(keys[some, 1]), pa.array(spans, pa.binary())],
                ["k1", "k2", "spans"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if last is not None and row["source"] != last:
                    yield out(held.pop(last))
                last = row["source"]
                held.setdefault(last, []).append(row)
        if last is not None:
            yield out(held.pop(last))

    return run


def _look_up(texts: DataFrame, width: int, block: int, parts: int, exact: bool) -> DataFrame:
    """``(k1, k2, spans)``: runs of found places of each document that has any."""
    sent = texts.mapInArrow(_send(width, block, parts, exact), _ROW)
    answered = sent.repartitionById(parts, F.col("place")).mapInArrow(_answer(parts, exact), _ROW)
    spans = (
        answered.repartitionById(parts, F.col("place"))
        .sortWithinPartitions("source", "kind")
        .mapInArrow(_gather(), "k1 long, k2 long, spans binary")
    )
    # Rows that are equal in id and text have equal spans.
    return spans.groupBy("k1", "k2").agg(F.min("spans").alias("spans"))


def _cut(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for a, b in slices(texts):
                total, removed, kept = [], [], []
                for i in range(a, b):
                    words = (texts[i].as_py() or b"").split()
                    found, last, parts, gone = batch.column(2)[i].as_py(), 0, [], 0
                    for x, y in np.frombuffer(found or b"", "<u4").reshape(-1, 2).tolist():
                        end = y - 1 + width
                        parts += words[last:x]
                        gone += end - max(x, last)
                        last = end
                    parts += words[last:]
                    total.append(len(words))
                    removed.append(gone)
                    kept.append(b" ".join(parts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(total, pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc", "n_words", "n_removed", "kept_text"],
                )

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every document.

    Every word covered by a ``width``-word window whose words also start anywhere else (in the
    same document too) is removed; windows are judged on the texts as given. Words that stay are
    joined by one space. NULL and empty texts have no words; texts shorter than ``width`` lose
    none; rows given twice are copies of each other. Columns other than the two are ignored.
    """
    block = (width + 1) // 2
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-chars // PARTITION_CHARS))
    # Two hashes of id and text stand for a row; unlike the id they are never NULL.
    keyed = rows.select(
        F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", "doc_id", F.lit(1)).alias("k2"),
        F.coalesce("text", F.lit("")).alias("text"), "doc_id",
    )
    hits = _look_up(keyed, width, block, parts, exact=False)
    # The same shuffle of the texts serves both joins.
    around = keyed.join(hits, ["k1", "k2"]).select("k1", "k2", "text", "doc_id", "spans")
    # A fixed order, whatever join Spark picks, so that places mean the same in a second run.
    around = around.sortWithinPartitions("k1", "k2")
    repeats = _look_up(around, width, block, parts, exact=True)
    whole = keyed.join(repeats, ["k1", "k2"], "left")
    source = whole.select(F.struct("doc_id").alias("doc"), "text", "spans")
    schema = source.select("doc").schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return source.mapInArrow(_cut(width), schema).select("doc.doc_id", "n_words", "n_removed", "kept_text")
