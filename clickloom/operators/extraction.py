"""Row counts and bounded samples of groups, both from one pass over the rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows or groups that a task holds before it hands on what it has.
HELD_ROWS = 200_000


def _first_rows(rows: pa.Table, keys: Sequence[str], order: Sequence[str], n: int) -> pa.Table:
    """The first ``n`` rows of each group in the given order, nulls first."""
    code = np.zeros(rows.num_rows, np.int64)
    for key in keys:
        one = rows[key].combine_chunks().dictionary_encode(null_encoding="encode")
        code = np.unique(code, return_inverse=True)[1] * max(len(one.dictionary), 1) + one.indices.to_numpy()
    sorted_by = [("_code", "ascending"), *((c, "ascending") for c in order)]
    at = pc.sort_indices(
        rows.select(order).append_column("_code", pa.array(code)), sort_keys=sorted_by, null_placement="at_start"
    ).to_numpy()
    code = code[at]
    new = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
    nth = np.arange(len(code)) - np.repeat(new, np.diff(np.append(new, len(code))))
    return rows.take(pa.array(at[nth < n]))


def _parts(keys: Sequence[str], order: Sequence[str], n: int, held_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        new: list[pa.RecordBatch] = []
        counts: Counter = Counter()
        fresh = 0

        def cut() -> pa.Table:
            rows = pa.Table.from_batches(new)
            return _first_rows(rows if held is None else pa.concat_tables([held, rows]), keys, order, n)

        def parts(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            kept = rows.append_column("n", pa.array(np.zeros(rows.num_rows, np.int64)))
            groups = {key: [group[i] for group in counts] for i, key in enumerate(keys)}
            columns = [*keys, *order, "row", "n"]
            types = {c: kept.schema.field(c).type for c in columns}
            schema = pa.schema(list(types.items()))
            for batch in kept.select(columns).combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays(batch.columns, schema=schema)
            yield pa.RecordBatch.from_arrays([
                pa.array(groups[c], types[c]) if c in groups
                else pa.array(list(counts.values()), pa.int64()) if c == "n"
                else pa.nulls(len(counts), types[c])
                for c in columns
            ], schema=schema)

        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(list(keys)).aggregate([([], "count_all")])
            for *group, size in zip(*(found[c].to_pylist() for c in (*keys, "count_all"))):
                counts[tuple(group)] += size
            new.append(batch)
            fresh += batch.num_rows
            # As many new rows as held ones before each sort keep the work in proportion to the rows.
            if fresh >= max(held.num_rows if held is not None else 0, min(held_rows, 50_000)):
                held, new, fresh = cut(), [], 0
                if max(held.num_rows, len(counts)) > held_rows:
                    yield from parts(held)
                    held = None
                    counts.clear()
        if new:
            held = cut()
        if held is not None:
            yield from parts(held)

    return run


def counted_samples(
    df: DataFrame, keys: dict[str, Column], order: dict[str, Column], n: int, held_rows: int = HELD_ROWS
) -> DataFrame:
    """``*keys, *order, row, n``: parts that hold the size of each group and its first ``n`` rows.

    Tasks keep the first ``n`` rows of each group as they read, and count. A part is either a count
    (``row`` is NULL) or a row of the input (``n`` is 0). Parts merge: the sums of ``n`` are the
    sizes, and the first ``n`` of all rows of a group are among its parts. A task with more than
    ``held_rows`` groups or kept rows hands on what it has and begins anew, so its memory is bounded.
    NULL is a group of its own.
    """
    rows = df.select(
        *(c.alias(name) for name, c in (keys | order).items()),
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
    )
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.schema), T.StructField("n", T.LongType())])
    return rows.mapInArrow(_parts(list(keys), list(order), n, held_rows), schema)
