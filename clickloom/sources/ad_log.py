"""Ad click log: lines of ``epoch_ms province city userid adid``, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Milliseconds of the years 1 to 9999, the range a timestamp can print.
_FIRST_MS, _LAST_MS = -62135596800000, 253402300799999

_FIELDS = ("ms", "province", "city", "user_id", "ad_id")


def _with_fields(log: DataFrame, column: str) -> DataFrame:
    """The line and its typed fields, NULL where the line has none.

    The line is split and the fields are taken out once: they come out of a generator, so the
    filters that follow refer to them and do not repeat the split.
    """
    part = F.col("_part")
    number = {"ms", "user_id", "ad_id"}
    fields = [F.try_element_at(part, F.lit(i)) for i in range(1, len(_FIELDS) + 1)]
    typed = [
        (f.try_cast("bigint") if name in number else f).alias(name)
        for name, f in zip(_FIELDS, fields)
    ]
    split = log.select(F.col(column).alias("value"), F.split(column, " ").alias("_part"))
    return split.select("value", F.inline(F.array(F.struct(*typed))))


def _readable() -> Column:
    known = F.lit(True)
    for name in _FIELDS:
        known = known & F.col(name).isNotNull()
    return F.coalesce(known & F.col("ms").between(_FIRST_MS, _LAST_MS), F.lit(False))


def parse_ad_log(log: DataFrame, column: str = "value") -> DataFrame:
    """Clicks of the readable lines: ts, date, province, city, user_id, ad_id."""
    ts = F.timestamp_millis("ms")
    return (
        _with_fields(log, column)
        .where(_readable())
        .select(
            ts.alias("ts"), ts.cast("date").cast("string").alias("date"),
            "province", "city", "user_id", "ad_id",
        )
    )


def ad_log_rejects(log: DataFrame, column: str = "value") -> DataFrame:
    """The lines :func:`parse_ad_log` leaves out, as they came."""
    return _with_fields(log, column).where(~_readable()).select("value")


def read_kafka_log(spark: SparkSession, servers: str, topics: str, **options: str) -> DataFrame:
    """Stream of log lines from Kafka; ``topics`` is a comma list. Needs Spark's Kafka package."""
    return (
        spark.readStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "subscribe": topics}, **options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def read_text_log(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of log lines from a folder of text files."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
