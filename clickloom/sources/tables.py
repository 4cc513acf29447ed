"""Batch sources: action tables, access logs and database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.functions.dates import parse_time


def read_input(spark: SparkSession, name: str, path: str) -> DataFrame:
    """An input table stored as parquet, read by its fixed schema."""
    return spark.read.schema(schemas.INPUTS[name]).parquet(path)


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make frames visible to SQL text under their names, for the session."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def scan_actions(actions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows whose ``date`` text lies in the closed range; a missing bound is open.

    On a table partitioned by ``date`` the range prunes partitions, otherwise it is pushed to
    the file scan. A text ``action_time`` becomes a timestamp here, once.
    """
    if start is not None:
        actions = actions.where(F.col("date") >= start)
    if end is not None:
        actions = actions.where(F.col("date") <= end)
    if dict(actions.dtypes).get("action_time") == "string":
        actions = actions.withColumn("action_time", parse_time(F.col("action_time")))
    return actions


def scan_clicks(actions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """(city_id, product_id) of every product click in the date range."""
    return (
        scan_actions(actions, start, end)
        .where(F.col("click_product_id").isNotNull())
        .select("city_id", F.col("click_product_id").alias("product_id"))
    )


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    r"""News access log: text fields parted by ``\x01``, missing values written ``null``.

    The format has no quoting. Lines that do not fit it are in :func:`access_log_rejects`.
    """
    return _access_log(spark, path).where("fits").select("row.*")


def access_log_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``line``: the lines of an access log with a wrong number of fields or a bad number."""
    return _access_log(spark, path).where("not fits").select("line")


def _access_log(spark: SparkSession, path: str) -> DataFrame:
    """Each ``line`` with its typed ``row``, and whether it ``fits`` the format."""
    fields = T.StructType.fromDDL(schemas.NEWS_ACCESS)
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.split("value", "\x01").alias("parts")
    )
    given = [F.nullif(F.get("parts", F.lit(i)), F.lit("null")) for i in range(len(fields))]
    typed = [x.try_cast(f.dataType) for x, f in zip(given, fields)]
    fits = F.size("parts") == len(fields)
    for x, y in zip(given, typed):
        fits = fits & (x.isNull() | y.isNotNull())
    row = F.struct(*(y.alias(f.name) for y, f in zip(typed, fields)))
    return lines.select("line", row.alias("row"), fits.alias("fits"))


def read_jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A whole database table.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` for a table
    too large to come through a single connection.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_jdbc_where(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: list[str],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Rows of a database table by predicate, one partition per predicate."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
