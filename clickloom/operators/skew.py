"""Joins and aggregations that stay balanced when a few keys hold most rows.

A key is *hot* when it holds more than ``target_rows`` rows, what one task should get. It is cut
into ``ceil(rows / target_rows)`` chunks, and its rows of the other side are copied to each. There
can be no more hot keys, and at most twice as many chunks, than the input's rows divided by
``target_rows``; neither the size of files nor the number of partitions or keys plays a part.

Row placement is a hash of the row's content and its input partition. Unlike a random number
it is the same when a lost task runs again, and equal rows from different partitions spread. A
count of rows within the partition would not be safe there: rows may arrive in another order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.workspace import materialize

_CHUNKS = "_chunks"
_SALT = "_salt"
_COPIES_ALL = ("inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "left_anti",
               "leftanti")
# Fixed value: the size up to which a side is worth sending to every task.
BROADCAST_LIMIT = 20_971_520
# Items a sketch tracks, least and most; a count of n rows is off by at most _ERROR * n / items.
_TRACKED = (4096, 1_000_000)
_ERROR = 3.5
# Parts of target_rows by which weights are measured.
_GRAINS = 200
_SKETCHED = (T.StringType, T.BooleanType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)
_FINE, _FINE_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Rows of one key that a task can hold, sort and write without trouble.
TARGET_ROWS = 4_000_000
# Hot keys that the driver lists; more are kept as a table.
MOST_LISTED = 20_000


@dataclass(frozen=True)
class HotTable:
    """Hot keys that are too many for a list: a written table of the keys and their chunks, with
    the sum and the largest of these."""

    keys: DataFrame
    total: int
    most: int


Hot = Sequence[Row] | HotTable


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _holds_map(kind: T.DataType) -> bool:
    """Maps have no hash in Spark."""
    return "map<" in kind.simpleString()


def placement(df: DataFrame, n: int | Column) -> Column:
    """A number in ``[0, n)`` per row, stable across task retries."""
    n = F.lit(n) if isinstance(n, int) else n
    plain = [f.name for f in df.schema if not _holds_map(f.dataType)]
    content = F.xxhash64(*(F.col(f"`{c}`") for c in plain), F.spark_partition_id())
    return F.pmod(content, n.cast("bigint")).cast("int")


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a frame, which rests on file sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _pow2(n: float) -> int:
    return 1 << max(int(n) - 1, 1).bit_length()


def hot_keys(
    df: DataFrame,
    on: str | Sequence[str],
    target_rows: int = TARGET_ROWS,
    fraction: float = 0.01,
    seed: int = 9,
    weight: str | None = None,
) -> list[Row]:
    """Keys of more than ``target_rows`` rows, with the chunks to cut each into.

    A sample of the key columns goes through a sketch of heavy hitters, which every task fills for
    itself and which merge: its size follows from the number of rows per ``target_rows``, however
    many different keys there are. Its counts are off by less than ``target_rows`` rows, so beside
    sampling no key of more than twice as many is missed (up to 280,000 times ``target_rows`` rows
    in all; beyond it the error grows with the rows). What is found only steers where rows go;
    every row is joined either way, so an error costs balance, never rows. The list is shorter than
    the input's rows divided by ``target_rows``.

    With ``weight`` each row stands for that many rows: a table of counts tells the hot keys of the
    table it was counted from. A row then enters the sketch once per 200th part of ``target_rows``,
    the rest drawn, so this too is a small pass.
    """
    return _search(df, _names(on), target_rows, fraction, seed, weight, None)


def hot_parts(
    df: DataFrame,
    on: str | Sequence[str],
    target_rows: int = TARGET_ROWS,
    fraction: float = 0.01,
    seed: int = 9,
    weight: str | None = None,
) -> Hot:
    """The same as :func:`hot_keys` however many hot keys there are.

    Up to ``MOST_LISTED`` keys are a list. If there are more, or more rows than a sketch can tell,
    the rows of the sample are counted by key in a shuffle and the hot keys are written to a table,
    so nothing that grows with the input goes through the driver. NULL keys match nothing and are
    not in the table.
    """
    return _search(df, _names(on), target_rows, fraction, seed, weight, MOST_LISTED)


def _search(
    df: DataFrame, on: list[str], target_rows: int, fraction: float, seed: int, weight: str | None, listed: int | None
) -> Hot:
    """The hot keys as a list or, if ``listed`` is given and does not do, as a table."""
    if weight is not None:
        most: float = _GRAINS
        part = F.col(weight).cast("decimal(38,0)") * _GRAINS
        whole = F.floor(part / target_rows).cast("long")
        rest = (part % target_rows).cast("long")
        odd = F.rand(seed) * target_rows < rest
        copies = F.greatest(F.coalesce(whole + odd.cast("long"), F.lit(0)), F.lit(0))
        rows = df.select(*on, copies.alias("_copies")).where(F.col("_copies") > 0)
        rows = rows.select(*on, F.explode(F.sequence(F.lit(1), "_copies")).alias("_copy"))
    else:
        most = target_rows * fraction
        rows = df.select(*on)
        if fraction < 1:
            rows = rows.sample(False, fraction, seed)
    size = estimated_bytes(df.select(*on))
    need = _ERROR * size / 8 / target_rows
    if listed is not None and need > _TRACKED[1]:
        # Likely more than a sketch can tell; a small one counts the rows.
        need = 0
    tracked = _pow2(max(_TRACKED[0], min(_TRACKED[1] // 2, need)))
    # Sketches of up to so many gigabytes of input meet in one task at once.
    groups = size >> 35
    while True:
        n, found = _heavy(rows, on, most, min(tracked, _TRACKED[1]), groups, listed)
        if listed is not None and (_ERROR * n > most * _TRACKED[1] or found is None):
            return _counted(rows, on, most)
        if _ERROR * n <= most * tracked or tracked >= _TRACKED[1]:
            break
        tracked = _pow2(_ERROR * n / most)
    return sorted(found, key=lambda row: (-row[_CHUNKS], repr(row)))


def _counted(rows: DataFrame, on: list[str], most: float) -> Hot:
    """The keys of more than ``most`` of the rows, counted in a shuffle."""
    counts = rows.where(~_any_null(on)).groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    keys = materialize(counts.select(*on, F.ceil(F.col("_n") / most).cast("int").alias(_CHUNKS)), "hot-keys")
    total, largest = keys.agg(F.sum(_CHUNKS), F.max(_CHUNKS)).first()
    return HotTable(keys, total, largest) if total else []


def total_chunks(hot: Hot) -> int:
    return hot.total if isinstance(hot, HotTable) else sum(h[_CHUNKS] for h in hot)


def cut_tasks(df: DataFrame, chunks: int, target_rows: int = TARGET_ROWS) -> int:
    """Tasks that cut so many chunks of ``target_rows`` rows: one per chunk, but small chunks share
    a task, so that there are no more than the shuffle partitions of the session or, if that is
    more, one per ``TARGET_ROWS`` rows."""
    wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(chunks, max(wide, math.ceil(chunks * target_rows / TARGET_ROWS))))


def cut_in_order(df: DataFrame, by: Sequence[str], chunks: int, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Rows cut by a range partitioning into pieces of their order, of ``target_rows`` rows at most:
    ``_at`` is the place of a row in the whole order and ``_piece`` its piece, both ascending. A
    range partitioning done twice may cut at other places, so write the result down."""
    ranged = df.repartitionByRange(cut_tasks(df, chunks, target_rows), *by).sortWithinPartitions(*by)
    return ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "_piece", F.expr(f"_at div {int(target_rows)}L")
    )


def _heavy(
    rows: DataFrame, on: list[str], most: float, tracked: int, groups: int, listed: int | None = None
) -> tuple[int, list[Row] | None]:
    """The number of rows, and the keys that a sketch of ``tracked`` items counts more than ``most``
    times, or None if they are more than ``listed``."""
    plain = len(on) == 1 and isinstance(rows.schema[on[0]].dataType, _SKETCHED)
    packed = F.to_json(F.struct(*on), {"timestampFormat": _FINE, "timestampNTZFormat": _FINE_NTZ})
    group = F.spark_partition_id() % groups if groups > 1 else F.lit(0)
    keyed = rows.select((F.col(on[0]) if plain else packed).alias("_key"), group.alias("_group"))
    # Grouped, so that no rows make no sketch: an empty one cannot be read.
    parts = keyed.groupBy("_group").agg(
        F.expr(f"approx_top_k_accumulate(_key, {tracked})").alias("_sketch"), F.count("*").alias("n")
    )
    if groups > 1:
        parts = parts.groupBy(F.lit(0).alias("_group")).agg(
            F.expr(f"approx_top_k_combine(_sketch, {tracked})").alias("_sketch"), F.sum("n").alias("n")
        )
    items = F.expr(f"filter(approx_top_k_estimate(_sketch, {tracked}), x -> x.count > {most!r})")
    parts = parts.select(items.alias("items"), "n")
    if listed is not None:
        many = F.size("items") > listed
        parts = parts.select(F.when(~many, F.col("items")).alias("items"), "n", many.alias("many"))
    one = parts.first()
    if one is None:
        return 0, []
    if listed is not None and one["many"]:
        return one["n"], None
    if not one["items"]:
        return one["n"], []
    chunks = {item["item"]: math.ceil(item["count"] / most) for item in one["items"]}
    if plain:
        return one["n"], [Row(**{on[0]: key, _CHUNKS: n}) for key, n in chunks.items()]
    schema = T.StructType([rows.schema[k] for k in on])
    texts = rows.sparkSession.createDataFrame(list(chunks.items()), f"_key string, {_CHUNKS} int")
    options = {"timestampFormat": _FINE, "timestampNTZFormat": _FINE_NTZ}
    keys = texts.select(F.from_json("_key", schema, options).alias("_key"), _CHUNKS)
    return one["n"], keys.select("_key.*", _CHUNKS).collect()


def hot_frame(like: DataFrame, on: list[str], hot: Hot) -> DataFrame:
    """The hot keys as a frame. A list is small enough to send to every task: :func:`hot_parts` lists
    up to ``MOST_LISTED`` keys, and by default 10^12 rows have under 250,000 (see :func:`hot_keys`).
    Of a table Spark decides by its size."""
    if isinstance(hot, HotTable):
        return hot.keys
    fields = [like.schema[k] for k in on] + [T.StructField(_CHUNKS, T.IntegerType())]
    fields = [T.StructField(f.name, f.dataType, True) for f in fields]
    rows = [tuple(h[k] for k in on) + (h[_CHUNKS],) for h in hot]
    return F.broadcast(like.sparkSession.createDataFrame(rows, T.StructType(fields)))


def _any_null(on: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in on))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot: Hot | None = None,
    **detect,
) -> DataFrame:
    """Equi-join that cuts the hot keys of ``left`` into chunks and copies their ``right`` rows.

    With no hot key it is the ordinary join, and Spark picks broadcast or sort-merge by size.
    NULL keys match nothing; they are spread over the chunks like a hot key.
    """
    on = _names(on)
    if how not in _COPIES_ALL:
        raise ValueError(f"cannot chunk the left side of a {how} join")
    if hot is None:
        hot = hot_parts(left, on, **detect)
    if not hot:
        return left.join(right, on, how)
    most = hot.most if isinstance(hot, HotTable) else max(h[_CHUNKS] for h in hot)
    chunks = hot_frame(left, on, hot)
    flagged = left.join(chunks, on, "left")
    n = F.when(_any_null(on), F.lit(most)).otherwise(F.coalesce(F.col(_CHUNKS), F.lit(1)))
    salted = flagged.withColumn(_SALT, placement(left, n)).drop(_CHUNKS)
    copied = (
        right.join(chunks, on, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_CHUNKS), F.lit(1)) - 1)))
        .drop(_CHUNKS)
    )
    return salted.join(copied, [*on, _SALT], how).drop(_SALT)


def map_side_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Send ``right`` to every task if Spark estimates it within ``max_bytes``, so that
    ``left`` is not shuffled; otherwise :func:`skew_join`."""
    if estimated_bytes(right) <= max_bytes:
        return left.join(F.broadcast(right), _names(on), how)
    return skew_join(left, right, on, how)


def salted_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], n: int = 10, how: str = "inner"
) -> DataFrame:
    """Salt every key of ``left`` ``n`` ways and copy each ``right`` row ``n`` times."""
    on = _names(on)
    if how not in _COPIES_ALL:
        raise ValueError(f"cannot salt the left side of a {how} join")
    salted = left.withColumn(_SALT, placement(left, n))
    copied = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return salted.join(copied, [*on, _SALT], how).drop(_SALT)


def skew_split_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    n: int | None = None,
    target_rows: int = TARGET_ROWS,
    fraction: float = 0.1,
    seed: int = 9,
) -> DataFrame:
    """Inner join that salts the hot keys of a sample and joins the rest plainly, in one pass.

    All keys above ``target_rows`` are salted, each ``n`` ways or (by default) into as many
    chunks as it needs; other keys have the single salt 0. Both sides are read once.
    """
    hot = hot_parts(left, on, target_rows, fraction, seed)
    if n is not None and isinstance(hot, HotTable):
        hot = HotTable(hot.keys.withColumn(_CHUNKS, F.lit(n)), 0, n)
    elif n is not None:
        hot = [Row(**(h.asDict() | {_CHUNKS: n})) for h in hot]
    return skew_join(left, right, on, "inner", hot)


_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_FIRST = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def salted_agg(
    df: DataFrame,
    keys: str | Sequence[str],
    aggs: dict[str, tuple[str, str]],
    n: int = 10,
) -> DataFrame:
    """Aggregate in two steps: by (keys, salt), then the partial results by keys.

    ``aggs`` maps a result name to (``count`` | ``sum`` | ``min`` | ``max``, column). Partial
    counts are summed in the second step.
    """
    keys = _names(keys)
    first = [
        _FIRST[op](F.lit(1) if column == "*" else F.col(column)).alias(name)
        for name, (op, column) in aggs.items()
    ]
    second = [_MERGE[op](name).alias(name) for name, (op, _) in aggs.items()]
    partial = df.withColumn(_SALT, placement(df, n)).groupBy(*keys, _SALT).agg(*first)
    return partial.groupBy(*keys).agg(*second)
