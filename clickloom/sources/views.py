"""Click-stream tables derived from the generic test tables (see FIXTURES.md).

Each function takes the raw tables as frames and returns one view, lazily, so a query reads
only the columns it uses. ``start`` / ``end`` also become a range on the raw timestamp, which
the parquet scan can skip row groups by (the text ``date`` is computed and cannot be pushed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SECONDS_INTO_DAY = (
    "(event_id*7919) % (case user_id%5 when 0 then 4 when 1 then 10 when 2 then 60 "
    "when 3 then 600 else 7200 end)"
)


# Schemas of the raw tables in use; with them no read infers anything.
RAW = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
}


class Tables:
    """The raw parquet tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        # Dates and hours below are those of UTC, whatever zone the session came with.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW[name]).parquet(f"{self.folder}/{name}.parquet")

    def event_stream(self) -> DataFrame:
        """The events table as a file stream, whether it is one file or a folder of files."""
        path = f"{self.folder}/events.parquet"
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop_path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        reader = self.spark.readStream.schema(RAW["events"])
        if fs.getFileStatus(hadoop_path).isDirectory():
            return reader.parquet(path)
        return reader.option("pathGlobFilter", "events.parquet").parquet(self.folder)

    def actions(self, start: str | None = None, end: str | None = None) -> DataFrame:
        return user_visit_action(between_days(self.raw("events"), start, end))

    def users(self) -> DataFrame:
        return user_info(self.raw("customer"), self.raw("nation"))

    def products(self) -> DataFrame:
        return product_info(self.raw("part"))

    def cities(self) -> DataFrame:
        return city_info(self.raw("nation"))

    def news(self, start: str | None = None, end: str | None = None) -> DataFrame:
        return news_access(between_days(self.raw("events"), start, end))

    def ad_log(self, events: DataFrame | None = None) -> DataFrame:
        events = self.raw("events") if events is None else events
        return ad_log(events, self.raw("nation"), self.raw("region"))


def between_days(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is not None:
        events = events.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        next_day = F.expr(f"cast('{end}' as timestamp_ntz) + interval 1 day")
        events = events.where(F.col("ts") < next_day)
    return events


def _base(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "user_id", "event_type",
        F.expr("cast(get_json_object(props, '$.k') as bigint)").alias("k"),
        F.expr("cast(cast(ts as date) as string)").alias("d"),
        F.expr(
            "timestamp_seconds(unix_seconds(cast(date_trunc('DAY', ts) as timestamp)) + "
            f"{_SECONDS_INTO_DAY})"
        ).alias("a_ts"),
        F.expr("unix_millis(cast(ts as timestamp))").alias("ms"),
    )


def user_visit_action(events: DataFrame) -> DataFrame:
    return _base(events).selectExpr(
        "d as date",
        "user_id",
        "concat(user_id, '_', d) as session_id",
        "k % 10 as page_id",
        "a_ts as action_time",
        "case when event_type = 'view' then concat('kw', k % 10) end as search_keyword",
        "case when event_type = 'click' then k % 20 end as click_category_id",
        "case when event_type = 'click' then event_id % 150 end as click_product_id",
        "case when event_type = 'signup' then concat(k % 20, ',', (k + 7) % 20) end"
        " as order_category_ids",
        "case when event_type = 'signup' then cast(event_id % 150 as string) end"
        " as order_product_ids",
        "case when event_type = 'purchase' then cast(k % 20 as string) end as pay_category_ids",
        "case when event_type = 'purchase' then cast(event_id % 150 as string) end"
        " as pay_product_ids",
        "user_id % 25 as city_id",
        "event_id as action_id",
    )


def user_info(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey as user_id",
        "c_name as username",
        "c_name as name",
        "cast(c_custkey % 60 as int) as age",
        "c_mktsegment as professional",
        "n_name as city",
        "case when c_custkey % 2 = 0 then 'male' else 'female' end as sex",
    )


def product_info(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey as product_id",
        "p_name as product_name",
        "concat('{\"product_status\": ', p_partkey % 2, '}') as extend_info",
    )


def city_info(nation: DataFrame) -> DataFrame:
    return nation.selectExpr(
        "cast(n_nationkey as bigint) as city_id",
        "n_name as city_name",
        "case n_regionkey when 0 then 'China North' when 1 then 'China East' "
        "when 2 then 'China South' when 3 then 'West North' else 'East North' end as area",
    )


def news_access(events: DataFrame) -> DataFrame:
    return _base(events).selectExpr(
        "d as date",
        "ms as timestamp",
        "case when event_type <> 'signup' and k % 10 <> 0 then user_id end as userid",
        "case when event_type <> 'signup' then k end as pageid",
        "case when event_type <> 'signup' then concat('section', k % 10) end as section",
        "case when event_type = 'signup' then 'register' else 'view' end as action",
    )


def ad_log(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    return (
        _base(events)
        .withColumn("place", F.expr("user_id % 25"))
        .join(nation, F.col("place") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "concat(ms, ' ', replace(r_name, ' ', '_'), ' ', n_name, ' ', user_id, ' ', k % 10)"
            " as value"
        )
    )
