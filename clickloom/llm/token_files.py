"""Token ids in bit-packed files, readable from any place.

A file holds ids one after another, each in the fewest bits that the vocabulary needs, most
significant bit first. They lie in blocks of a fixed number of ids, each block padded to a whole
byte, so a block is unpacked by itself with numpy. Layout, all integers little-endian:

    "CLTK", version u2, bits u2, ids per block u4
    blocks
    block offsets u8 (one more than blocks), document ends u8 (ids up to each document's end),
    document ids i8, document ids' presence u1
    number of ids u8, of documents u8, offset of the block offsets u8, "CLTK"

Documents are dealt by ranges of their id, so each task writes one file of consecutive
documents. A task that runs again writes a file of another name; the manifest, a table that
Spark commits, names the files that count.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.token_cache import encoder
from clickloom.workspace import work_path

MAGIC = b"CLTK"
_HEAD = struct.Struct("<4sHHI")
_TAIL = struct.Struct("<QQQ4s")
BLOCK = 1 << 14
SHARD_BYTES = 32 << 20


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits :].reshape(-1)).tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The ``n`` ids that :func:`pack` stored."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits :] = flat
    return np.packbits(wide, axis=1).view(">u4").reshape(-1).astype("<u4")


class Writer:
    """Writes one file, a block at a time."""

    def __init__(self, out, bits: int, block: int = BLOCK) -> None:
        self.out, self.bits, self.block = out, bits, block
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0
        self.offsets, self.at = [], _HEAD.size
        self.ends: list[int] = []
        self.docs: list[int | None] = []
        out.write(_HEAD.pack(MAGIC, 1, bits, block))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.total += len(ids)
        self.held += len(ids)
        self.docs.append(doc_id)
        self.ends.append(self.total)
        self.waiting.append(ids)
        if self.held >= self.block:
            self._flush(final=False)

    def _flush(self, final: bool) -> None:
        ids = np.concatenate([np.zeros(0, "<u4"), *self.waiting])
        whole = len(ids) if final else len(ids) - len(ids) % self.block
        for a in range(0, whole, self.block):
            data = pack(ids[a : min(a + self.block, whole)], self.bits)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(final=True)
        table = self.at
        present = np.array([d is not None for d in self.docs], np.uint8)
        self.out.write(np.array([*self.offsets, self.at], "<u8").tobytes())
        self.out.write(np.array(self.ends, "<u8").tobytes())
        self.out.write(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        self.out.write(present.tobytes())
        self.out.write(_TAIL.pack(self.total, len(self.docs), table, MAGIC))
        self.out.close()


class Reader:
    """Random access to one file."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        magic, _, self.bits, self.block = _HEAD.unpack(source.read_at(_HEAD.size, 0))
        self.n_ids, n_docs, table, end = _TAIL.unpack(source.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError("not a token file, or one cut short")
        blocks = -(-self.n_ids // self.block)
        raw = source.read_at(size - _TAIL.size - table, table)
        self.offsets = np.frombuffer(raw, "<u8", blocks + 1)
        at = self.offsets.nbytes
        self.ends = np.frombuffer(raw, "<u8", n_docs, at)
        self.doc_ids = np.frombuffer(raw, "<i8", n_docs, at + 8 * n_docs)
        self.present = np.frombuffer(raw, np.uint8, n_docs, at + 16 * n_docs)

    def _block(self, i: int) -> np.ndarray:
        a, b = int(self.offsets[i]), int(self.offsets[i + 1])
        n = min(self.block, self.n_ids - i * self.block)
        return unpack(self.source.read_at(b - a, a), self.bits, n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``; only their blocks are read."""
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        got = np.concatenate([self._block(i) for i in range(first, last + 1)])
        return got[start - first * self.block : stop - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, first place and token ids of each document in turn; each block is read once."""
        blocks, at, held = iter(range(len(self.offsets) - 1)), 0, np.zeros(0, "<u4")
        for doc, there, end in zip(self.doc_ids.tolist(), self.present.tolist(), self.ends.tolist()):
            parts, have = [held], len(held)
            while have < end - at:
                parts.append(self._block(next(blocks)))
                have += len(parts[-1])
            ids = np.concatenate(parts)
            yield (doc if there else None), at, ids[: end - at]
            at, held = end, ids[end - at :]


def _write(folder: str, tokenizer: str, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, writer, path = encoder(tokenizer), None, None
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                if writer is None:
                    store, base = fs.FileSystem.from_uri(folder)
                    store.create_dir(base, recursive=True)
                    part = TaskContext.get().partitionId()
                    path = f"{base}/{part:07d}-{uuid.uuid4().hex}.tok"
                    bits = max(made.vocabulary() - 1, end_id, 1).bit_length()
                    writer = Writer(store.open_output_stream(path), bits)
                writer.add(doc, np.append(made.ids(text.as_py() or b""), np.uint32(end_id)))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist([{
                "shard": part, "file": path.rpartition("/")[2], "docs": len(writer.docs), "tokens": writer.total,
            }], _MANIFEST_ARROW)

    return run


_MANIFEST = "shard int, file string, docs long, tokens long"
_MANIFEST_ARROW = pa.schema(
    [("shard", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]
)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id",
    text: str = "text", shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode all documents and write files in ascending id order, NULL ids first.

    ``folder`` must be reachable by every executor. Ties of ids are ordered by text hash. A NULL
    or empty text is the end id alone. Writes ``folder/files`` and the table ``folder/manifest``.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    parts = max(1, -(-size // shard_bytes))
    order = ["doc_id", F.xxhash64("text")]
    (
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .mapInArrow(_write(f"{folder}/files", tokenizer, end_id), _MANIFEST)
        .write.mode("overwrite").parquet(f"{folder}/manifest")
    )


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file with ``start``, the number of ids in all files before it."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    table = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    return table.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _read(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as source:
                    rows = []
                    for doc, at, ids in Reader(source).documents():
                        rows.append((doc, row["start"] + at, len(ids), zlib.crc32(ids.tobytes())))
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""
    files = read_manifest(spark, folder)
    parts = max(1, spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").count())
    return files.repartition(parts, "shard").mapInArrow(
        _read(f"{folder}/files"), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_report(docs: DataFrame, tokenizer: str, end_id: int = 1, **columns) -> DataFrame:
    """Write the token files of all documents to the shared folder and read them back."""
    spark = docs.sparkSession
    folder = work_path(spark, "tokens")
    write_tokens(docs, folder, tokenizer, end_id, **columns)
    return read_digests(spark, folder)
