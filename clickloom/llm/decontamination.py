"""Find benchmark items copied or edited into documents.

Seeds are pairs of words: a word with the next one, or with the one after that. A copy that scores
enough has few edits for the words it keeps, so between many of its kept words lies one edit at
most, and such neighbours are one of these pairs in the item and in the document, whatever was
changed, added or dropped. Of an item's pairs only the commonest (counted over all documents) are
left out, so few that any copy still holds a known number of the rare ones within a bounded stretch.

Documents are read twice, however large the benchmark is: to count the pairs, and to cut out the
passages that hold enough seeds. In both a bitmap of bounded size stands for the pairs. Passages and
seeds are rows and meet in joins. Smith-Waterman alignment over words gives the score: two for an
equal word, minus one for a changed, missing or added word, divided by what the item scores with
itself.

Words are compared in lower case without ASCII punctuation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.words import Texts, mix, slices
from clickloom.workspace import materialize

#: Items of fewer words match nothing.
LEAST_WORDS = 3
MIN_SCORE = 0.5
MATCH, MISS, GAP = 2, -1, -1
#: One in so many of the pairs that a copy keeps must be seeds.
SHARE = 3
#: The most words of a passage; longer ones are cut in pieces that overlap by a whole copy.
BLOCK_WORDS = 2048
#: Bitmaps have 32 bits for each pair, up to 2 to this power (16 MB).
MOST_BITS = 27
_CELLS = 1 << 19
_COUNTS = 1 << 20
_BUCKET = 15
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FOLD = bytes(32 if 32 <= c < 127 and not chr(c).isalnum() else c for c in range(256))


def folded(column: pa.Array) -> Texts:
    """Texts in lower case, ASCII punctuation made white space."""
    lower = pc.utf8_lower(column.cast(pa.large_string()).fill_null("")).cast(pa.large_binary())
    _, offsets, data = lower.buffers()
    plain = (data.to_pybytes() if data is not None else b"").translate(_FOLD)
    return Texts(pa.Array.from_buffers(
        pa.large_binary(), len(lower), [None, offsets, pa.py_buffer(plain)], offset=lower.offset
    ))


def _pairs(texts: Texts, words: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """First places of the words that have another ``gap`` words on in their text, and hashes of both."""
    place = np.flatnonzero(texts.whole(gap + 1))
    return place, mix(words[place] * _FACTOR + words[place + gap])


class _Bits:
    """A bitmap over the highest bits of hashes."""

    def __init__(self, log2: int, buckets: list[tuple[int, bytes]]) -> None:
        self.shift = np.uint64(64 - log2)
        self.bits = np.zeros(1 << (log2 - 3), np.uint8)
        size = 1 << (_BUCKET - 3)
        for number, data in buckets:
            self.bits[number * size : (number + 1) * size] = np.frombuffer(data, np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = h >> self.shift
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _bitmaps(pairs: DataFrame, kind: Column, rows: int) -> dict[int, _Bits]:
    """One bitmap of the column ``pair`` for each ``kind``; Spark builds them, the driver holds them."""
    log2 = min(max((32 * max(rows, 1)).bit_length(), _BUCKET), MOST_BITS)
    slot = F.shiftrightunsigned("pair", 64 - log2)
    parts = pairs.groupBy(kind.alias("kind"), F.shiftright(slot, _BUCKET).alias("number")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(F.lit((1 << _BUCKET) - 1))).alias("bits")
    )
    found: dict[int, list[tuple[int, bytes]]] = {}
    for r in parts.collect():
        found.setdefault(r["kind"], []).append((r["number"], bytes(r["bits"])))
    return {k: _Bits(log2, v) for k, v in found.items()}


def _lists(values: np.ndarray, sizes: np.ndarray | list[int]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column(1)):
            texts = folded(batch.column(1).slice(a, b - a))
            words = texts.hashes()
            pairs = [_pairs(texts, words, gap)[1].view(np.int64) for gap in (1, 2)]
            long = pa.array(texts.n_words >= LEAST_WORDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), _lists(words.view(np.int64), texts.n_words),
                 *(_lists(h, np.maximum(texts.n_words - gap, 0)) for gap, h in zip((1, 2), pairs))],
                ["item", "words", "next", "after"],
            ).filter(long)


def _counted(known: _Bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pair, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            n = np.zeros(len(pair), np.int64)
            np.add.at(n, at, np.concatenate([n for _, n in held]))
            return pair, n

        for batch in batches:
            for a, b in slices(batch.column(0)):
                texts = folded(batch.column(0).slice(a, b - a))
                words = texts.hashes()
                found = [h[known.has(h)] for h in (_pairs(texts, words, gap)[1] for gap in (1, 2))]
                held.append(np.unique(np.concatenate(found), return_counts=True))
                size += len(held[-1][0])
                if size > _COUNTS:
                    held = [merged()]
                    size = len(held[0][0])
                if size > _COUNTS // 2 and len(held) == 1:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], ["pair", "n"])
                    held, size = [], 0
        if held:
            pair, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(n)], ["pair", "n"])

    return run


def _stretches(place: np.ndarray, times: int, span: int, first: np.ndarray) -> list[tuple[int, int]]:
    """Where ``times`` of the sorted places lie in ``span`` words of one text: from where to where
    a copy around them can reach, those that overlap as one."""
    last = np.arange(len(place)) + times - 1
    some = np.flatnonzero(last < len(place))
    last = last[some]
    doc = np.searchsorted(first, place, "right") - 1
    ok = (doc[last] == doc[some]) & (place[last] - place[some] < span)
    some, last = some[ok], last[ok]
    if not len(some):
        return []
    doc = doc[some]
    low = np.maximum(place[last] + 1 - span, first[doc])
    high = np.minimum(place[some] + span, first[doc + 1])
    new = np.ones(len(some), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (low[1:] > high[:-1])
    begin = np.flatnonzero(new)
    return list(zip(low[begin].tolist(), high[np.append(begin[1:], len(new)) - 1].tolist()))


def _passages(known: _Bits, kinds: list[tuple[_Bits, int, int]], block: int):
    """Pieces of documents that may hold a copy, with the places and hashes of their seeds."""
    names = ["row", "passage", "doc", "low", "words", "places", "pairs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = passage = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b in slices(batch.column(1)):
                texts = folded(batch.column(1).slice(a, b - a))
                words = texts.hashes()
                place, pair = (np.concatenate(x) for x in zip(*(_pairs(texts, words, gap) for gap in (1, 2))))
                hit = known.has(pair)
                place, pair = place[hit], pair[hit]
                order = np.argsort(place, kind="stable")
                place, pair = place[order], pair[order]
                pieces: list[tuple[int, int]] = []
                places, pairs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for bits, times, span in kinds:
                    mine = bits.has(pair)
                    at, seed = place[mine], pair[mine]
                    step = max(block, 2 * span)
                    for low, high in _stretches(np.unique(at), times, span, texts.first):
                        for x in range(low, max(high - span, low + 1), step - span):
                            y = min(x + step, high)
                            i, j = np.searchsorted(at, (x, y))
                            pieces.append((x, y))
                            places.append(at[i:j] - x)
                            pairs.append(seed[i:j])
                doc = np.searchsorted(texts.first, [x for x, _ in pieces], "right") - 1
                held = [np.zeros(0, np.uint64), *(words[x:y] for x, y in pieces)]
                many = [len(p) for p in places[1:]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc + row), pa.array(np.arange(len(pieces)) + passage),
                    batch.column(0).slice(a, b - a).take(pa.array(doc)),
                    pa.array(np.array([x for x, _ in pieces], np.int64) - texts.first[doc]),
                    _lists(np.concatenate(held).view(np.int64), [y - x for x, y in pieces]),
                    _lists(np.concatenate(places).astype(np.int32), many),
                    _lists(np.concatenate(pairs).view(np.int64), many),
                ], names)
                row += len(texts)
                passage += len(pieces)

    return run


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each item with its passage, and where in the passage it ends.

    All pairs advance together, an item word at a time; the gaps along a passage are a running
    maximum.
    """
    n = len(items)
    rows = max((len(x) for x in items), default=0)
    columns = max((len(x) for x in passages), default=0)
    # 0 stands for no word on one side, 1 on the other, so padding matches nothing.
    a, b = np.zeros((n, rows), np.uint64), np.ones((n, columns), np.uint64)
    for i, (x, y) in enumerate(zip(items, passages)):
        a[i, : len(x)], b[i, : len(y)] = x, y
    pad_a, pad_b = a == 0, b == 1
    slope = (-GAP * np.arange(columns)).astype(np.int32)
    above = np.zeros((n, columns), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for i in range(rows):
        same = (a[:, i : i + 1] == b) & ~pad_a[:, i : i + 1] & ~pad_b
        now = np.where(same, MATCH, MISS).astype(np.int32)
        now[:, 1:] += above[:, :-1]
        now = np.maximum(np.maximum(now, above + GAP), 0)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        above = now
        at = now.argmax(axis=1)
        value = now[np.arange(n), at]
        better = value > best
        best[better], end[better] = value[better], at[better]
    return best, end


def _enough(words: np.ndarray, item: tuple[np.ndarray, np.ndarray], need: int) -> bool:
    """Whether a passage holds as many of the item's words, each as often as the item, as the score takes."""
    known, often = item
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    n = np.bincount(at[known[at] == words], minlength=len(known))
    return int(np.minimum(n, often).sum()) >= need


def _scored(least: float):
    names = ["row", "doc", "item", "score", "start_word", "end_word"]

    def arrays(column: pa.Array, kind: type = np.int64) -> list[np.ndarray]:
        flat, ends = column.flatten().to_numpy().astype(kind, copy=False), np.cumsum(column.value_lengths().to_numpy())
        return np.split(flat, ends[:-1]) if len(ends) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, items = arrays(batch["words"]), arrays(batch["item_words"])
            places = arrays(batch["places"])
            size, times, span, need, low = (batch[c].to_pylist() for c in ("size", "times", "span", "need", "low"))
            bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            found = []
            for k, name in enumerate(batch["item"].to_pylist()):
                if name not in bags:
                    bags[name] = np.unique(items[k], return_counts=True)
                for x, y in _stretches(places[k], times[k], span[k], np.array([0, len(words[k])])):
                    if _enough(words[k][x:y], bags[name], need[k]):
                        found.append((k, x, y))
            # Pairs of like size share a table of bounded size.
            found.sort(key=lambda c: c[2] - c[1])
            out: list[tuple[int, float, int, int]] = []
            at = 0
            while at < len(found):
                part = found[at : at + max(1, min(_CELLS // (found[at][2] - found[at][1]), 512))]
                while len(part) > 1 and (part[-1][2] - part[-1][1]) * len(part) > 2 * _CELLS:
                    part = part[: len(part) // 2]
                at += len(part)
                scores, ends = align(
                    [items[k].view(np.uint64) for k, _, _ in part], [words[k][x:y].view(np.uint64) for k, x, y in part]
                )
                for (k, x, _), s, e in zip(part, scores.tolist(), ends.tolist()):
                    s /= MATCH * size[k]
                    if s >= least:
                        end = low[k] + x + e + 1
                        out.append((k, s, max(low[k] + x, end - 2 * size[k]), end))
            rows = pa.array([k for k, *_ in out], pa.int64())
            yield pa.RecordBatch.from_arrays([
                *(batch[c].take(rows) for c in names[:3]),
                *(pa.array([r[i] for r in out], t) for i, t in ((1, pa.float64()), (2, pa.int64()), (3, pa.int64()))),
            ], names)

    return run


def _seeds(items: DataFrame, counts: DataFrame) -> DataFrame:
    """``pair, item, times, span, size``: the pairs of each item without those of its commonest first words."""
    starts = items.select(
        "item", "size", "keep", "times", "span", "after", F.posexplode("next").alias("place", "near")
    ).withColumn("far", F.get("after", F.col("place"))).drop("after")
    for name in ("near", "far"):
        starts = starts.join(counts.select(F.col("pair").alias(name), F.col("n").alias(f"n_{name}")), name, "left")
    often = F.coalesce("n_near", F.lit(0)) + F.coalesce("n_far", F.lit(0))
    nth = F.row_number().over(Window.partitionBy("item").orderBy(often, "place"))
    rare = starts.withColumn("nth", nth).where("nth <= keep")
    return rare.select(F.explode(F.array("near", "far")).alias("pair"), "item", "times", "span", "size").where(
        "pair is not null"
    ).distinct()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", least: float = MIN_SCORE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``doc`` (doc_id, k1, k2), ``item_id``, ``score``, ``start_word``, ``end_word``: a row for
    each document and item whose best alignment scores ``least`` or more.

    ``k1`` and ``k2`` are hashes that stand for the document's row. Items given twice are one.
    NULL and empty texts, and items of fewer than three words, match nothing. ``least`` must be more
    than a third: below, short items have copies without a seed. An item of ``n`` words is held
    whole by a task, and so is its window of seeds.
    """
    if least * LEAST_WORDS <= 1:
        raise ValueError("least must be above 1/3")
    rows = docs.select(
        F.struct(
            F.col(f"`{doc_id}`").alias("doc_id"),
            F.xxhash64(f"`{doc_id}`", f"`{text}`").alias("k1"),
            F.xxhash64(f"`{text}`", f"`{doc_id}`", F.lit(1)).alias("k2"),
        ).alias("doc"),
        F.col(f"`{text}`").alias("text"),
    )
    named = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    named = named.withColumn("item", F.xxhash64("item_id", "text")).dropDuplicates(["item"])
    items = named.select("item", "text").mapInArrow(
        _item_words, "item long, words array<long>, next array<long>, after array<long>"
    ).withColumn("size", F.size("words"))
    # A score of ``least`` with m equal words leaves 2 (m - least size) edits, so at most half as
    # many of their m - 1 gaps hold two edits or more: ``pairs`` of them are left, or more.
    items = materialize(items.selectExpr(
        "*",
        f"greatest(cast(ceil({least} * size - 1e-9) as int), 1) as need",
        f"size + cast(floor({MATCH} * (1 - {least}) * size + 1e-9) as int) as span",
        f"greatest(cast(ceil({least} * size - 1 - 1e-9) as int), 1) as pairs",
    ).selectExpr(
        "*", f"greatest(cast(pairs div {SHARE} as int), 1) as times"
    ).selectExpr("*", "size - 1 - pairs + times as keep"), "benchmark-items")
    pairs = items.select(F.explode(F.concat("next", "after")).alias("pair")).distinct()
    total = items.agg(F.sum("size")).first()[0] or 0
    bits = _bitmaps(pairs, F.lit(0), 2 * total)
    known = bits.get(0) or _Bits(_BUCKET, [])
    counts = rows.select("text").mapInArrow(_counted(known), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    seeds = materialize(_seeds(items, counts), "benchmark-seeds")
    # Items of like size share a bitmap, so that what a copy holds at least can be asked for early.
    kind = F.length(F.bin("size"))
    sizes = seeds.groupBy(kind.alias("kind")).agg(F.min("times").alias("times"), F.max("span").alias("span")).collect()
    maps = _bitmaps(seeds, kind, 2 * total)
    kinds = [(maps[r["kind"]], r["times"], r["span"]) for r in sizes]
    bits = _bitmaps(seeds, F.lit(0), 2 * total).get(0) or _Bits(_BUCKET, [])
    schema = (
        "row long, passage long, doc struct<doc_id:" + rows.schema["doc"].dataType["doc_id"].dataType.simpleString()
        + ",k1:bigint,k2:bigint>, low long, words array<long>, places array<int>, pairs array<long>"
    )
    passages = materialize(rows.mapInArrow(_passages(bits, kinds, block_words), schema), "passages")
    hits = passages.select("passage", F.inline(F.arrays_zip("places", "pairs")).alias("place", "pair"))
    held = hits.join(seeds.drop("size"), "pair").groupBy("passage", "item", "times", "span").agg(
        F.array_sort(F.collect_set("place")).alias("places")
    ).where(
        "if(size(places) < times, false, exists(sequence(0, size(places) - times), "
        "i -> places[i + times - 1] - places[i] < span))"
    )
    # Of each passage, what a copy of this item can reach.
    begin = F.greatest(F.get("places", F.lit(0)) + 1 - F.col("span"), F.lit(0))
    pairs = held.select("*", begin.alias("begin")).join(passages.drop("places", "pairs"), "passage").join(
        items.select("item", F.col("words").alias("item_words"), "size", "need"), "item"
    ).select(
        "row", "doc", "item", "item_words", "size", "times", "span", "need",
        (F.col("low") + F.col("begin")).alias("low"),
        F.transform("places", lambda p: p - F.col("begin")).alias("places"),
        F.slice("words", F.col("begin") + 1, F.element_at("places", -1) + F.col("span") - F.col("begin")).alias("words"),
    )
    schema = pairs.select("row", "doc", "item").schema.add("score", "double").add("start_word", "long").add("end_word", "long")
    found = pairs.mapInArrow(_scored(least), schema).groupBy("row", "item").agg(
        F.max_by(
            F.struct("doc", "score", "start_word", "end_word"), F.struct("score", -F.col("start_word"))
        ).alias("best")
    ).select("item", "best.*")
    return found.join(named.select("item", "item_id"), "item").select(
        "doc", "item_id", "score", "start_word", "end_word"
    )


def leak_report(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """``doc_id, item_id, score, start_word, end_word`` of every contaminated document and item."""
    return contaminated(docs, benchmark, **columns).select(
        "doc.doc_id", "item_id", "score", "start_word", "end_word"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The documents that hold no benchmark item, with the columns as given."""
    found = contaminated(docs, benchmark, doc_id, text, **kw).select("doc.k1", "doc.k2").distinct()
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"),
        F.xxhash64(f"`{doc_id}`", f"`{text}`").alias("k1"),
        F.xxhash64(f"`{text}`", f"`{doc_id}`", F.lit(1)).alias("k2"),
    )
    # Written out, the list has a size that Spark knows: small ones go to every task.
    return whole.join(materialize(found, "leaks"), ["k1", "k2"], "left_anti").select("whole.*")
