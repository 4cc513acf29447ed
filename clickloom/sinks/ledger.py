"""Tables that are fed batch by batch and commit together.

A :class:`Ledger` is a folder of tables and of commit records. A batch writes its rows of every
table to new folders, and then one record that names the parts of all tables. Readers go by the
last record: they see the whole batch or nothing of it. A batch that runs again starts from the
record before it, so nothing is counted twice.

The rows of a table lie in *cells*: a slot of their day (its number modulo :data:`SLOTS`, so
however far the days of a log are spread there are never more) and a hash bucket of their key.
A batch knows the cells it wrote and needs to read no others to tell what its keys amount to
now. A cell is at most three kinds of parts: one base, one part merged from the last batches
(every ``merge_every`` batches) and the batches since; every ``fold_every`` batches it becomes one
base again. So a batch reads as many files of its cells after a year as on the first day.

The record points to one small file per slot that lists the parts of its cells; slots that a batch
did not touch keep theirs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.workspace import remove

# Days share a slot when they are a multiple of this apart.
SLOTS = 512
MERGE_EVERY = 8
# An hour of 5 second batches.
FOLD_EVERY = 720
DELTA, MERGED, BASE = 0, 1, 2
_BATCH = "_batch"

Cell = tuple[int, int]


@dataclass
class Commit:
    """What the tables are after a batch. ``tables`` maps a table's name to the list of parts of
    each slot, ``open`` to its slots that hold more than bases, ``retired`` names the folders and
    lists that this batch put out of use."""

    number: int = -1
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    open: dict[str, list[str]] = field(default_factory=dict)
    retired: list[str] = field(default_factory=list)


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def numbers(self) -> list[int]:
        """Numbers of the kept commit records, ascending."""
        fs, pattern = self._fs(f"{self.root}/_commits/*.json")
        return sorted(int(s.getPath().getName()[:-5]) for s in fs.globStatus(pattern) or [])

    def last(self, before: int | None = None) -> Commit:
        """The last record, or the last one numbered below ``before``."""
        known = [n for n in self.numbers() if before is None or n < before]
        return Commit(**self.read_json(self._commit_path(known[-1]))) if known else Commit()

    def begin(self, number: int | None = None) -> Batch:
        """A batch; by default the one after the last.

        Only the last batch can run again. A smaller number is an error: it comes from a stream
        that does not belong to these tables.
        """
        known = self.numbers()
        last = known[-1] if known else -1
        if number is None:
            number = last + 1
        if number < last:
            raise ValueError(f"{self.root} holds batches up to {last}; batch {number} would come too late")
        return Batch(self, number)

    def write(self, commit: Commit) -> None:
        """Put a record in place in one step."""
        jvm = self.spark._jvm
        path = self._commit_path(commit.number)
        fresh = f"{self.root}/_commits/.{commit.number}-{uuid.uuid4().hex}"
        self.write_json(fresh, commit.__dict__)
        fs = jvm.org.apache.hadoop.fs
        files = fs.FileContext.getFileContext(fs.Path(path).toUri(), self._conf())
        options = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
        options[0] = fs.Options.Rename.OVERWRITE
        files.rename(files.makeQualified(fs.Path(fresh)), files.makeQualified(fs.Path(path)), options)

    def vacuum(self, before: int) -> None:
        """Delete what the records below ``before`` put out of use, and these records."""
        for number in [n for n in self.numbers() if n < before]:
            path = self._commit_path(number)
            gone = self.read_json(path)["retired"]
            for old in gone:
                remove(self.spark, f"{self.root}/{old}")
            for folder in sorted({"/".join(g.split("/")[:-2]) for g in gone if "/_slot=" in g}):
                if not self.folders(f"{folder}/_slot=*/_bucket=*"):
                    remove(self.spark, f"{self.root}/{folder}")
            remove(self.spark, path)

    def read_json(self, path: str):
        fs, at = self._fs(path)
        stream = fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write_json(self, path: str, value) -> None:
        fs, at = self._fs(path)
        out = fs.create(at, True)
        out.write(bytearray(json.dumps(value), "utf-8"))
        out.close()

    def folders(self, pattern: str) -> list[str]:
        """Folders under the root that fit a pattern, relative to it."""
        fs, at = self._fs(f"{self.root}/{pattern}")
        depth = pattern.count("/") + 1
        found = [str(s.getPath().toString()).split("/") for s in fs.globStatus(at) or []]
        return ["/".join(f[-depth:]) for f in found]

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/_commits/{number}.json"

    def _conf(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self._conf()), at


class LedgerTable:
    """A table of a ledger.

    ``combine="sum"`` adds the values of equal keys (batches hold increments), ``"last"`` keeps
    those of the latest batch (batches hold new states; two rows of one key in one batch are an
    error unless ``latest_by`` names the column whose largest value decides), and ``"append"``
    keeps all rows. ``bucket_by`` are the keys whose hash is the bucket, by default all; ``slot_by``
    is the key that holds the day as text. The number of buckets cannot change later.
    """

    def __init__(
        self, ledger: Ledger, name: str, schema: str, keys: Sequence[str] = (), combine: str = "last",
        slot_by: str | None = None, bucket_by: Sequence[str] | None = None, buckets: int = 1,
        latest_by: str | None = None,
    ):
        if combine not in ("sum", "last", "append"):
            raise ValueError(f"unknown way to combine: {combine}")
        self.ledger, self.spark, self.name = ledger, ledger.spark, name
        self.schema = T.StructType.fromDDL(schema)
        self.keys = list(keys)
        self.values = [f.name for f in self.schema if f.name not in self.keys]
        self.combine, self.slot_by, self.latest_by = combine, slot_by, latest_by
        self.bucket_by = self.keys if bucket_by is None else list(bucket_by)
        self.buckets = buckets

    def read(self, before: int | None = None) -> DataFrame:
        """The table as of the last batch, or the last one numbered below ``before``."""
        return self.at(self.ledger.last(before))

    def write(self, df: DataFrame, number: int | None = None) -> None:
        """A batch that feeds this table alone."""
        batch = self.ledger.begin(number)
        batch.stage(self, df)
        batch.commit()

    def at(self, commit: Commit, cells: Iterable[Cell] | None = None) -> DataFrame:
        """The rows of these cells (default all) as of a record, combined by key."""
        return self.combined(self.load(self.parts(commit, cells)))

    def parts(self, commit: Commit, cells: Iterable[Cell] | None = None) -> list[str]:
        """The folders that hold the rows of these cells."""
        wanted = None if cells is None else set(cells)
        lists = commit.tables.get(self.name, {})
        slots = sorted(lists) if wanted is None else sorted({str(s) for s, _ in wanted} & set(lists))
        found = []
        for slot in slots:
            for bucket, parts in self.ledger.read_json(f"{self.ledger.root}/{lists[slot]}").items():
                if wanted is None or (int(slot), int(bucket)) in wanted:
                    found += [path for path, _ in parts]
        return found

    def stored(self) -> T.StructType:
        """Columns in the files: a state is kept with the number of its batch."""
        extra = [T.StructField(_BATCH, T.LongType())] if self.combine == "last" else []
        return T.StructType([*self.schema.fields, *extra])

    def load(self, parts: Sequence[str]) -> DataFrame:
        """The rows of these folders as they lie there."""
        if not parts:
            # Made by Spark alone: an empty list would start Python workers.
            return self.spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in self.stored()))
        return self.spark.read.schema(self.stored()).parquet(*(f"{self.ledger.root}/{p}" for p in parts))

    def combined(self, rows: DataFrame, keep_batch: bool = False) -> DataFrame:
        if self.combine == "append":
            return rows
        if self.combine == "sum":
            return rows.groupBy(*self.keys).agg(*(F.sum(v).alias(v) for v in self.values))
        latest = F.max_by(F.struct(F.col(_BATCH), *self.values), _BATCH).alias("_latest")
        values = [F.col(f"_latest.{v}").alias(v) for v in [*self.values, *([_BATCH] if keep_batch else [])]]
        return rows.groupBy(*self.keys).agg(latest).select(*self.keys, *values)

    def cell_columns(self, number: int) -> list[Column]:
        """Slot and bucket of a row."""
        if self.combine == "append":
            slot: Column = F.lit(number // FOLD_EVERY)
        elif self.slot_by is None:
            slot = F.lit(0)
        else:
            day = F.coalesce(F.unix_date(F.col(self.slot_by).try_cast("date")), F.lit(0))
            slot = F.pmod(day, F.lit(SLOTS))
        bucket = F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)) if self.bucket_by else F.lit(0)
        return [slot.cast("int").alias("_slot"), bucket.cast("int").alias("_bucket")]

    def checked(self, df: DataFrame) -> DataFrame:
        """The rows of a batch with the columns of the table; of a state one row per key."""
        names = [f.name for f in self.schema]
        if self.combine != "last":
            return df.select(*names)
        if not self.values:
            return df.select(*names).distinct()
        state = F.struct(*([F.col(self.latest_by).alias("_order")] if self.latest_by else []), *self.values)
        made = df.groupBy(*self.keys).agg(F.max(state).alias("_state"), F.count("*").alias("_n"))
        if not self.latest_by:
            clash = F.raise_error(F.lit(f"two rows of one key in one batch of {self.name}"))
            made = made.withColumn("_state", F.when(F.col("_n") == 1, F.col("_state")).otherwise(clash))
        return made.select(*self.keys, *(F.col(f"_state.{v}").alias(v) for v in self.values))


@dataclass
class Staged:
    """The folders a batch wrote of one table, by cell."""

    table: LedgerTable
    parts: dict[Cell, str]


def cells_of(rows: DataFrame, *tables: LedgerTable) -> list[list[Cell]]:
    """The cells of these rows' keys in each of the tables, in one job: at most slots times buckets
    each, whatever the rows are."""
    found = rows.agg(
        *(F.collect_set(F.struct(*table.cell_columns(0))).alias(f"_{i}") for i, table in enumerate(tables))
    ).first()
    return [sorted((c["_slot"], c["_bucket"]) for c in cells) for cells in found]


class Batch:
    """One batch over the tables of a ledger: stage rows, look at earlier ones, commit once."""

    def __init__(self, ledger: Ledger, number: int):
        self.ledger, self.number = ledger, number
        self.before = ledger.last(before=number)
        self._name = f"{number}-{uuid.uuid4().hex[:8]}"
        self._staged: dict[str, Staged] = {}
        # What an attempt that never committed left of this batch is in nobody's use; an attempt
        # that did is replaced by this one.
        self._stale = [
            found for kind in ("*/batch={}-*", "*/merge={}-*", "_parts/*/*-{}-*") for found in ledger.folders(kind.format(number))
        ]

    def stage(self, table: LedgerTable, df: DataFrame) -> Staged:
        """Write the rows of a batch to new folders, one per cell."""
        self._staged[table.name] = Staged(table, self._store(table, table.checked(df), "batch"))
        return self._staged[table.name]

    def old(self, table: LedgerTable, cells: Iterable[Cell]) -> DataFrame:
        """Rows of these cells as earlier batches left them."""
        return table.at(self.before, cells)

    def changed(
        self, table: LedgerTable, new: DataFrame, cells: Iterable[Cell], keys: Sequence[str] | None = None
    ) -> DataFrame:
        """All rows whose ``keys`` (default the table's) are in ``new``, as they are with this batch.

        ``new`` are the rows of the batch and ``cells`` theirs, the only ones read; ``keys`` must
        hold those that the cells depend on.
        """
        if table.combine == "last":
            new = new.withColumn(_BATCH, F.lit(self.number).cast("long"))
        parts = table.parts(self.before, cells)
        if not parts:
            return table.combined(new)
        keys = list(keys or table.keys)
        return table.combined(table.load(parts).join(new.select(*keys), keys, "left_semi").unionByName(new))

    def _store(self, table: LedgerTable, rows: DataFrame, kind: str, slot: int | None = None) -> dict[Cell, str]:
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema]
        if table.combine == "last":
            fields.append(F.col(_BATCH) if _BATCH in rows.columns else F.lit(self.number).cast("long").alias(_BATCH))
        folder = f"{table.name}/{kind}={self._name}" + ("" if slot is None else f"-{slot}")
        number = self.number if slot is None else slot * FOLD_EVERY
        (
            rows.select(*fields, *table.cell_columns(number))
            # One file per cell and not one per task, split where a cell is large.
            .hint("rebalance", "_slot", "_bucket")
            .write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy("_slot", "_bucket").parquet(f"{self.ledger.root}/{folder}")
        )
        found = {}
        for path in self.ledger.folders(f"{folder}/_slot=*/_bucket=*"):
            slot, bucket = (int(p.split("=")[1]) for p in path.split("/")[-2:])
            found[slot, bucket] = path
        return found

    def commit(self, merge_every: int = MERGE_EVERY, fold_every: int = FOLD_EVERY) -> Commit:
        """Make all staged rows part of their tables in one step.

        Every ``merge_every`` batches the parts since the last base are merged in the tables that
        this batch feeds, every ``fold_every`` batches with the base too; what has been out of use
        for that long is then deleted.
        """
        fold = self.number > 0 and self.number % fold_every == 0
        merge = fold or (self.number > 0 and self.number % merge_every == 0)
        commit = Commit(self.number, dict(self.before.tables), dict(self.before.open))
        for staged in self._staged.values():
            self._enter(commit, staged, merge, fold)
        self.ledger.write(commit)
        for stale in self._stale:
            remove(self.ledger.spark, f"{self.ledger.root}/{stale}")
        if fold:
            self.ledger.vacuum(self.number - fold_every)
        return commit

    def _enter(self, commit: Commit, staged: Staged, merge: bool, fold: bool) -> None:
        name, ledger = staged.table.name, self.ledger
        lists = dict(commit.tables.get(name, {}))
        touched = {str(slot) for slot, _ in staged.parts}
        opened = set(commit.open.get(name, [])) | touched
        cells: dict[Cell, list[list]] = {}
        for slot in opened if merge else touched:
            if slot in lists:
                for bucket, parts in ledger.read_json(f"{ledger.root}/{lists[slot]}").items():
                    cells[int(slot), int(bucket)] = [list(p) for p in parts]
        for cell, path in staged.parts.items():
            cells[cell] = [*cells.get(cell, []), [path, DELTA]]
        if merge:
            cells = self._merged(commit, staged.table, cells, fold)
        for slot in {s for s, _ in cells}:
            path = f"_parts/{name}/{slot}-{self._name}.json"
            ledger.write_json(
                f"{ledger.root}/{path}", {str(b): parts for (s, b), parts in cells.items() if s == slot}
            )
            if str(slot) in lists:
                commit.retired.append(lists[str(slot)])
            lists[str(slot)] = path
        commit.tables[name] = lists
        commit.open[name] = [] if fold else sorted(opened)

    def _merged(
        self, commit: Commit, table: LedgerTable, cells: dict[Cell, list[list]], fold: bool
    ) -> dict[Cell, list[list]]:
        """Cells with their parts merged. A part that is alone only changes its kind."""
        kind = BASE if fold else MERGED
        due = {c: to_merge(parts, fold) for c, parts in cells.items()}
        many = {c: paths for c, paths in due.items() if len(paths) > 1}
        made: dict[Cell, str] = {}
        if many:
            if table.combine == "append":
                # Their slot is that of their batches, which the rows do not tell.
                for (slot, _), paths in many.items():
                    made |= self._store(table, table.load(paths), "merge", slot)
            else:
                rows = table.load([path for paths in many.values() for path in paths])
                made = self._store(table, table.combined(rows, keep_batch=True), "merge")
        out: dict[Cell, list[list]] = {}
        for cell, parts in cells.items():
            kept = [p for p in parts if p[0] not in due[cell]]
            fresh = made.get(cell) if cell in many else next(iter(due[cell]), None)
            out[cell] = kept + ([[fresh, kind]] if fresh else [])
            if cell in many:
                commit.retired += due[cell]
        return out


def to_merge(parts: Sequence[Sequence], fold: bool) -> list[str]:
    """Of the parts of a cell those to become one: all, or those that came after the base."""
    return [path for path, kind in parts if fold or kind != BASE]


def upsert(table: LedgerTable, df: DataFrame) -> None:
    """Insert new keys and replace the values of known ones, as one batch."""
    table.write(df)
