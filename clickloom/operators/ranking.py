"""Top rows per group and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.skew import placement


def top_n_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, which should end in a unique key.

    Spark cuts each input partition to ``n`` rows per group before the shuffle (for ``n`` up to
    its group-limit threshold), so a group of any size reaches its task as a few rows. Beyond
    the threshold the same is done here in two steps.
    """
    group = [group] if isinstance(group, str) else list(group)
    spark = df.sparkSession
    threshold = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    name = rank or "_rank"
    if n > threshold:
        chunks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        by_chunk = Window.partitionBy(*group, "_chunk").orderBy(*order)
        df = (
            df.withColumn("_chunk", placement(df, chunks))
            .withColumn("_rank", F.row_number().over(by_chunk))
            .where(F.col("_rank") <= n)
            .drop("_chunk", "_rank")
        )
    by_group = Window.partitionBy(*group).orderBy(*order)
    top = df.withColumn(name, F.row_number().over(by_group)).where(F.col(name) <= n)
    return top if rank else top.drop(name)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows overall: each task keeps ``n``, the driver side merges them."""
    return df.orderBy(*order).limit(n)
