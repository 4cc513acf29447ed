"""Append sinks and the replacement of whole groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.schemas import OUTPUT_COLUMNS


def result_rows(df: DataFrame, table: str, task_id: int | None = None) -> DataFrame:
    """The columns of a result table in order, with the task id where the table has one."""
    if task_id is not None:
        df = df.withColumn("task_id", F.lit(task_id).cast("bigint"))
    return df.select(*OUTPUT_COLUMNS[table])


def append(df: DataFrame, path: str) -> None:
    """Add rows to a parquet table."""
    df.write.mode("append").parquet(path)


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None
) -> None:
    """Add rows to a database table, in batches from every task."""
    df.write.mode("append").jdbc(url, table, properties=properties or {})


def replace_groups(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace the groups present in ``df`` and keep all others.

    The table is partitioned by the keys, so only the directories of those groups are written
    anew. Rows are gathered by group before writing, and an oversized group is split over
    several tasks, each with a file of its own.
    """
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
