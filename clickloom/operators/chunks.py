"""Lists of distinct values that need not fit in one row.

A list becomes rows of bounded size: ``group..., chunk, position, values``, where ``position`` is the
place in the whole list of the chunk's first value. Values are in order, and what chunk one is in
follows from the bytes of the values before it alone, so a list is cut alike however the rows lie.

Ordinary groups are numbered in one window. The values of a hot group are range-partitioned by
their order into pieces; each piece is numbered for itself, and the counts of the pieces before it,
a row per piece, are added. So neither a task nor a row grows with a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from clickloom.operators.skew import MOST_LISTED, TARGET_ROWS, Hot, cut_in_order, hot_frame, hot_parts, total_chunks
from clickloom.workspace import materialize

CHUNK_BYTES = 1 << 20


def _before(what: Column, w: WindowSpec) -> Column:
    """Sum over the rows ahead of this one."""
    return F.coalesce(F.sum(what).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


def _numbered(rows: DataFrame, w: WindowSpec, start: Column, offset: Column) -> DataFrame:
    """Rows with the number of values and bytes before them."""
    return rows.withColumns({"_at": start + _before(F.lit(1), w), "_offset": offset + _before(F.col("_bytes"), w)})


def chunked_values(
    rows: DataFrame, group: str | Sequence[str], value: str, chunk_bytes: int = CHUNK_BYTES,
    hot: Hot | None = None, **detect,
) -> DataFrame:
    """Distinct values of each group in order, as chunks of about ``chunk_bytes`` bytes.

    A value counts with its length as text and one for a separator; a chunk takes the values that
    begin in its stretch, so it holds at most one value more than its size. NULL values are left
    out; a NULL in the group is a key of its own, but is not cut in pieces. ``hot`` are groups of
    too many distinct values for a task (see :func:`~clickloom.operators.skew.hot_parts`), by
    default looked for.
    """
    group = [group] if isinstance(group, str) else list(group)
    # Spread by group and value: the copies in a hot group meet in many tasks.
    distinct = rows.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("_value")).distinct()
    if hot is None:
        # As good as certain to be among those of the rows; those of few values only cost a piece.
        hot = hot_parts(rows, group, **detect)
    sized = distinct.withColumn("_bytes", F.octet_length(F.col("_value").cast("string")).cast("long") + 1)
    zero = F.lit(0).cast("long")
    whole = Window.partitionBy(*group).orderBy("_value")
    if hot:
        keys, chunks = hot_frame(rows, group, hot), total_chunks(hot)
        target_rows = detect.get("target_rows", TARGET_ROWS)
        pieces = materialize(
            cut_in_order(sized.join(keys.drop("_chunks"), group), [*group, "_value"], chunks, target_rows).drop("_at"),
            "list-pieces",
        )
        sums = pieces.groupBy(*group, "_piece").agg(F.count("*").alias("_n"), F.sum("_bytes").alias("_b"))
        order = Window.partitionBy(*group).orderBy("_piece")
        ahead = sums.select(
            *group, "_piece", _before(F.col("_n"), order).alias("_n_ahead"), _before(F.col("_b"), order).alias("_b_ahead")
        )
        within = Window.partitionBy(*group, "_piece").orderBy("_value")
        # About a row per chunk of a hot key; sent to every task while these are few.
        ahead = F.broadcast(ahead) if chunks <= MOST_LISTED else ahead
        cut = _numbered(pieces.join(ahead, [*group, "_piece"]), within, F.col("_n_ahead"), F.col("_b_ahead"))
        plain = _numbered(sized.join(keys, group, "left_anti"), whole, zero, zero)
        numbered = plain.unionByName(cut.select(*plain.columns))
    else:
        numbered = _numbered(sized, whole, zero, zero)
    chunk = F.expr(f"_offset div {int(chunk_bytes)}L").alias("_chunk")
    lists = numbered.select(*group, chunk, "_at", "_value").groupBy(*group, "_chunk").agg(
        F.min("_at").alias("position"), F.array_sort(F.collect_list("_value")).alias("values")
    )
    # Chunks that one long value reaches over hold nothing; numbers go on without them.
    nth = F.row_number().over(Window.partitionBy(*group).orderBy("_chunk")) - 1
    return lists.select(*group, nth.alias("chunk"), "position", "values")
