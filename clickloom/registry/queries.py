"""One query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import dates, text
from clickloom.functions.numbers import round_half_up
from clickloom.functions.sql import register_sql_functions
from clickloom.operators import ads, categories, funnel, links, news, panes, products, ranking, sessions
from clickloom.operators import skew
from clickloom.operators.skew import estimated_bytes
from clickloom.plans import jobs
from clickloom.sinks.append import append, replace_groups
from clickloom.sinks.ledger import Ledger, LedgerTable, upsert
from clickloom.sources import ad_log, params, tables
from clickloom.sources.views import Tables
from clickloom.streaming import ads as stream
from clickloom.workspace import materialize, move, work_path

# Parameters of the queries; registry/oracle.py uses the same.
FLOW = (3, 8, 9, 3)
NEWS_DAY = "2024-01-15"
START, END = "2024-01-05", "2024-01-20"
THRESHOLD = 3
FILTER = params.TaskParams(
    start_age=10, end_age=50,
    professionals=("BUILDING", "MACHINERY", "AUTOMOBILE"),
    sex="male",
    keywords=("kw1", "kw2", "kw3", "kw4", "kw5"),
)
CATEGORY_FILTER = params.TaskParams(category_ids=(3, 7, 11))
# The ad job reads the log of the month in so many files, in order of the days.
AD_FILES = 5

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of the tables under its name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Tables(spark, folder))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# -- sources ----------------------------------------------------------------------------------


def _detail_columns(actions: DataFrame) -> DataFrame:
    """Action rows with the time as text, as the detail table stores it."""
    return actions.withColumn("action_time", dates.format_time(F.col("action_time")))


@query
def scan_actions(t: Tables) -> DataFrame:
    actions = tables.scan_actions(t.actions(START, END), START, END)
    return _detail_columns(actions)


@query
def scan_clicks(t: Tables) -> DataFrame:
    return tables.scan_clicks(t.actions(START, END), START, END)


@query
def access_log(t: Tables) -> DataFrame:
    path = work_path(t.spark, "access-log")
    line = F.concat_ws(
        "\x01", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in t.news().columns)
    )
    t.news().select(line.alias("value")).write.text(path)
    return tables.read_access_log(t.spark, path)


def _tasks(t: Tables) -> DataFrame:
    return t.raw("customer").selectExpr(
        "c_custkey as task_id",
        """concat('{"startDate":["2024-01-', lpad(c_nationkey + 1, 2, '0'), '"],"startAge":[',
                  c_custkey % 60, '],"professionals":["', c_mktsegment, ',IT"],"sex":[],',
                  '"targetPageFlow":["3,', c_nationkey, '","9"]}') as task_param""",
    )


@query
def task_params(t: Tables) -> DataFrame:
    return params.read_task_params(_tasks(t))


def _clicks(t: Tables) -> DataFrame:
    return ad_log.parse_ad_log(t.ad_log())


@query
def ad_log_parse(t: Tables) -> DataFrame:
    return _clicks(t).select(
        F.unix_millis("ts").alias("ms"), "date", "province", "city", "user_id", "ad_id"
    )


@query
def ad_log_rejects(t: Tables) -> DataFrame:
    """Lines of ad 3 lose their last field, lines of ad 4 have a word for the user."""
    cut = F.expr(
        "case when value like '% 3' then substring(value, 1, length(value) - 2) "
        "when value like '% 4' then concat('x', value) else value end"
    )
    return ad_log.ad_log_rejects(t.ad_log().select(cut.alias("value")))


# -- sessions ---------------------------------------------------------------------------------


def _sessions(t: Tables) -> DataFrame:
    return sessions.session_aggregate(t.actions(), t.users())


def _filtered(t: Tables) -> DataFrame:
    return sessions.filtered_sessions(t.actions(), t.users(), FILTER)


def _details(t: Tables) -> DataFrame:
    profiles = sessions.session_profiles(t.actions(), FILTER)
    busy = skew.hot_parts(t.actions(), "user_id")
    kept = materialize(sessions.profile_filter(profiles, t.users(), FILTER, busy), "session-kept")
    return sessions.session_details(kept, t.actions())


def _session_text(df: DataFrame) -> DataFrame:
    """Lists and times as text, the form both engines compare alike."""
    return df.withColumns(
        {
            "search_keywords": F.array_join("search_keywords", ","),
            "click_category_ids": F.array_join("click_category_ids", ","),
            "start_time": dates.format_time(F.col("start_time")),
        }
    )


@query
def session_aggregate(t: Tables) -> DataFrame:
    return _session_text(_sessions(t))


@query
def session_filter(t: Tables) -> DataFrame:
    return _session_text(_filtered(t))


@query
def session_filter_categories(t: Tables) -> DataFrame:
    return _session_text(sessions.filtered_sessions(t.actions(), t.users(), CATEGORY_FILTER))


@query
def session_length_stats(t: Tables) -> DataFrame:
    return sessions.session_length_stats(_sessions(t))


@query
def session_hourly_counts(t: Tables) -> DataFrame:
    return sessions.session_hourly_counts(_sessions(t))


@query
def sample_quotas(t: Tables) -> DataFrame:
    return sessions.sample_quotas(_sessions(t), total=1000)


@query
def session_sample(t: Tables) -> DataFrame:
    return sessions.as_extract_rows(sessions.sample_sessions(_sessions(t)))


def _hour_sessions(t: Tables) -> DataFrame:
    """Sessions with their first event's own time, which spreads over all hours."""
    return t.raw("events").groupBy(
        F.expr("concat(user_id, '_', cast(cast(ts as date) as string))").alias("session_id")
    ).agg(F.min(F.col("ts").cast("timestamp")).alias("start_time"))


@query
def sample_quotas_hours(t: Tables) -> DataFrame:
    return sessions.sample_quotas(_hour_sessions(t))


@query
def session_sample_hours(t: Tables) -> DataFrame:
    """Fewer sessions than days, so some days give none."""
    sample = sessions.sample_sessions(_hour_sessions(t), total=25)
    return sample.select("session_id", "date", "hour")


@query
def session_details(t: Tables) -> DataFrame:
    return _detail_columns(_details(t))


@query
def category_events(t: Tables) -> DataFrame:
    return categories.category_events(t.actions()).groupBy("category_id", "kind").agg(
        F.count("*").alias("events")
    )


@query
def session_value_chunks(t: Tables) -> DataFrame:
    """Lists in chunks of eight bytes."""
    chunks = sessions.session_value_chunks(t.actions(), chunk_bytes=8)
    return chunks.withColumn("values", F.array_join("values", ","))


@query
def category_rejects(t: Tables) -> DataFrame:
    """Lists of page 3 get a broken entry, payments of page 4 lose theirs."""
    broken = t.actions().withColumns({
        "order_category_ids": F.expr("if(page_id = 3, concat(order_category_ids, ',n/a'), order_category_ids)"),
        "pay_category_ids": F.expr("if(page_id = 4, replace(pay_category_ids, pay_category_ids, ''), pay_category_ids)"),
    })
    return categories.category_rejects(broken)


@query
def category_counts(t: Tables) -> DataFrame:
    return categories.category_counts(_details(t))


@query
def top_categories(t: Tables) -> DataFrame:
    return categories.top_categories(_details(t))


def _top_sessions(details: DataFrame) -> DataFrame:
    return categories.top_sessions_per_category(details, categories.top_categories(details))


@query
def top_sessions(t: Tables) -> DataFrame:
    return _top_sessions(materialize(_details(t), "session-details"))


@query
def top_session_details(t: Tables) -> DataFrame:
    details = materialize(_details(t), "session-details")
    listed = _top_sessions(details)
    return _detail_columns(categories.top_session_details(listed, details))


@query
def session_job(t: Tables) -> DataFrame:
    """The whole job; the actions of its active sessions are the result at its end."""
    results = jobs.session_job(t.actions(), t.users(), FILTER, task_id=1)
    return _detail_columns(results["session_detail"])


def _session_job(t: Tables, table: str) -> DataFrame:
    return jobs.session_job(t.actions(), t.users(), FILTER, task_id=1)[table]


@query
def session_job_stat(t: Tables) -> DataFrame:
    return _session_job(t, "session_aggr_stat")


@query
def session_job_extract(t: Tables) -> DataFrame:
    return _session_job(t, "session_random_extract")


@query
def session_job_categories(t: Tables) -> DataFrame:
    return _session_job(t, "top10_category")


@query
def session_job_sessions(t: Tables) -> DataFrame:
    return _session_job(t, "top10_session")


@query
def funnel_job(t: Tables) -> DataFrame:
    task = params.TaskParams(page_flow=FLOW)
    return jobs.funnel_job(t.actions(), task, task_id=1)["page_split_convert_rate"]


@query
def product_job(t: Tables) -> DataFrame:
    task = params.TaskParams(start_date=START, end_date=END)
    return jobs.product_job(t.actions(START, END), t.cities(), t.products(), task, 1)["area_top3_product"]


@query
def news_job_counts(t: Tables) -> DataFrame:
    """Pages, visitors and sections of one day in one table."""
    found = jobs.news_job(t.news(NEWS_DAY, NEWS_DAY), NEWS_DAY)
    pv = found["page_pv"].selectExpr("'page_pv' as kind", "cast(pageid as string) as name", "pv as n")
    uv = found["page_uv"].selectExpr("'page_uv' as kind", "cast(pageid as string) as name", "uv as n")
    sections = found["section_pv"].selectExpr("'section_pv' as kind", "section as name", "pv as n")
    return pv.unionByName(uv).unionByName(sections)


@query
def news_job_rates(t: Tables) -> DataFrame:
    found = jobs.news_job(t.news(NEWS_DAY, NEWS_DAY), NEWS_DAY)
    return found["register_rate"].join(found["jump_rate"], "date")


# -- page flows -------------------------------------------------------------------------------


@query
def page_transitions(t: Tables) -> DataFrame:
    return funnel.page_transitions(t.actions())


@query
def page_transitions_split(t: Tables) -> DataFrame:
    """The same with every session of more than eight views cut in pieces as if it were hot."""
    return funnel.page_transitions(t.actions(), target_rows=8, fraction=1)


@query
def page_flow_splits(t: Tables) -> DataFrame:
    return funnel.page_flow_splits(t.actions(), FLOW)


@query
def start_page_pv(t: Tables) -> DataFrame:
    return funnel.start_page_pv(t.actions(), FLOW)


@query
def page_convert_rates(t: Tables) -> DataFrame:
    return funnel.page_convert_rates(t.actions(), FLOW)


@query
def page_convert_text(t: Tables) -> DataFrame:
    return funnel.convert_rate_text(funnel.page_convert_rates(t.actions(), FLOW))


# -- products ---------------------------------------------------------------------------------


def _area_clicks(t: Tables) -> DataFrame:
    return products.area_product_clicks(tables.scan_clicks(t.actions()), t.cities())


@query
def area_product_clicks(t: Tables) -> DataFrame:
    return _area_clicks(t)


@query
def area_product_city_chunks(t: Tables) -> DataFrame:
    """City lists in chunks of 30 bytes, of products of more than three cities put together from pieces."""
    return products.area_product_city_chunks(
        tables.scan_clicks(t.actions()), t.cities(), chunk_bytes=30, target_rows=3, fraction=1
    )


@query
def area_product_sql(t: Tables) -> DataFrame:
    """The same counts as SQL text over views, with the functions registered by name."""
    register_sql_functions(t.spark)
    tables.register_views({"clicks": tables.scan_clicks(t.actions()), "city_info": t.cities()})
    return t.spark.sql(
        """
        select area, product_id, count(*) as click_count,
               listagg(distinct city, ',') within group (order by city) as city_infos
        from (select area, product_id, concat_long_string(city_id, city_name, ':') as city
              from clicks join city_info using (city_id))
        group by area, product_id
        """
    )


@query
def area_top3_product(t: Tables) -> DataFrame:
    return products.area_top_products(_area_clicks(t), t.products())


# -- news -------------------------------------------------------------------------------------


@query
def news_page_pv(t: Tables) -> DataFrame:
    return news.daily_page_pv(t.news(NEWS_DAY, NEWS_DAY), NEWS_DAY)


@query
def news_page_uv(t: Tables) -> DataFrame:
    return news.daily_page_uv(t.news())


@query
def news_section_pv(t: Tables) -> DataFrame:
    return news.daily_section_pv(t.news())


@query
def news_register_rate(t: Tables) -> DataFrame:
    return news.register_rate(t.news())


@query
def news_jump_rate(t: Tables) -> DataFrame:
    return news.jump_rate(t.news())


# -- ads, batch -------------------------------------------------------------------------------


def _blacklist(clicks: DataFrame) -> DataFrame:
    return ads.ad_blacklist(ads.ad_user_clicks(clicks), THRESHOLD)


@query
def ad_user_clicks(t: Tables) -> DataFrame:
    return ads.ad_user_clicks(_clicks(t))


@query
def ad_blacklist(t: Tables) -> DataFrame:
    return _blacklist(_clicks(t))


@query
def ad_filtered_clicks(t: Tables) -> DataFrame:
    clicks = _clicks(t)
    return ads.ad_filtered_clicks(clicks, _blacklist(clicks)).select(
        F.unix_millis("ts").alias("ms"), "date", "province", "city", "user_id", "ad_id"
    )


def _kept_stat(t: Tables) -> DataFrame:
    """Area counts without listed users; the blacklist comes from the same click counts."""
    counts = ads.click_counts(_clicks(t))
    return ads.ad_stat(counts.join(_blacklist(counts), "user_id", "left_anti"))


@query
def ad_stat(t: Tables) -> DataFrame:
    return _kept_stat(t)


@query
def ad_province_top3(t: Tables) -> DataFrame:
    return ads.ad_province_top3(_kept_stat(t))


@query
def ad_province_top3_all_days(t: Tables) -> DataFrame:
    return ads.ad_province_top3(_kept_stat(t), per_day=False)


@query
def ad_click_trend(t: Tables) -> DataFrame:
    return ads.ad_click_trend(_clicks(t))


# -- ads, streams -----------------------------------------------------------------------------


def _click_stream(t: Tables) -> DataFrame:
    return ad_log.parse_ad_log(t.ad_log(t.event_stream()))


def _parts(t: Tables) -> int:
    """One part per 32 MB of log, at most the shuffle partitions of the session."""
    by_size = max(1, estimated_bytes(t.raw("events")) >> 25)
    return min(by_size, int(t.spark.conf.get("spark.sql.shuffle.partitions")))


def _state_parts(t: Tables) -> int:
    """One part per 32 MB of log, at least 4."""
    return min(max(4, _parts(t)), int(t.spark.conf.get("spark.sql.shuffle.partitions")))


def _run(t: Tables, frame: DataFrame, process, root: str, mode: str) -> None:
    """Work through the stream, its state in so many parts."""
    checkpoint = f"{root}/checkpoint"
    stream.start(frame, process, checkpoint, mode, None, _state_parts(t)).awaitTermination()


@query
def ad_blacklist_stream(t: Tables) -> DataFrame:
    """The click pipeline with its feedback; how clicks fall into batches does not matter to
    who is listed in the end."""
    root = work_path(t.spark, "ad-clicks")
    found = stream.AdTables.under(t.spark, f"{root}/tables", buckets=_parts(t))
    _run(t, _click_stream(t), stream.click_batch(found, THRESHOLD), root, "append")
    return found.blacklist.read()


def _stat_stream(t: Tables) -> stream.AdTables:
    """Running counts of the clicks left by a preset blacklist."""
    root = work_path(t.spark, "ad-stat")
    found = stream.AdTables.under(t.spark, f"{root}/tables", "last", _parts(t))
    preset = stream.AdTables.under(t.spark, f"{root}/preset").blacklist
    preset.write(_blacklist(_clicks(t)))
    kept = stream.filter_blacklist(_click_stream(t), preset.read())
    counts = stream.running_ad_stat(kept)
    _run(t, counts, stream.stat_batch(found), root, "update")
    return found


@query
def ad_stat_stream(t: Tables) -> DataFrame:
    return _stat_stream(t).stat.read()


@query
def ad_province_top3_stream(t: Tables) -> DataFrame:
    return _stat_stream(t).read_top3()


@query
def ad_click_trend_stream(t: Tables) -> DataFrame:
    root = work_path(t.spark, "ad-trend")
    found = stream.trend_table(t.spark, f"{root}/ad_click_trend")
    _run(t, stream.click_trend(_click_stream(t)), found.write, root, "update")
    return found.read()


@query
def ad_click_trend_sliding(t: Tables) -> DataFrame:
    root = work_path(t.spark, "ad-sliding")
    found = stream.sliding_table(t.spark, f"{root}/ad_sliding")
    counts = stream.sliding_clicks(_click_stream(t))
    _run(t, counts, found.write, root, "update")
    return found.read().withColumn("window_start", dates.format_time(F.col("window_start")))


@query
def ad_click_trend_panes(t: Tables) -> DataFrame:
    """Windows of 60 minutes that slide by 10 seconds, as runs of equal counts, from a stream."""
    root = work_path(t.spark, "ad-panes")
    found = stream.pane_table(t.spark, f"{root}/tables", _parts(t))
    _run(t, panes.pane_counts(_click_stream(t)), found.write, root, "update")
    runs = panes.window_runs(found.read())
    return runs.withColumns({c: dates.format_time(F.col(c)) for c in ("first_start", "last_start")})


def _ad_job(t: Tables) -> stream.AdTables:
    """The ad job over the log in parts of some days, one micro-batch each; lines of ad 3 are
    broken. Users listed by one batch are left out of the next.

    The log is written once. A part then moves to where the stream looks, and the job goes on from
    its checkpoint, as it does after a stop. A batch is shuffled in one part per 32 MB of log, at
    least one per core.
    """
    root = work_path(t.spark, "ad-job")
    wide = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    shuffled = min(wide, max(_state_parts(t), t.spark.sparkContext.defaultParallelism))
    cut = "case when value like '% 3' then substring(value, 1, length(value) - 2) else value end"
    part = f"(day(timestamp_millis(cast(split(value, ' ')[0] as bigint))) - 1) * {AD_FILES} div 31"
    lines = t.ad_log().select(F.expr(cut).alias("value"), F.expr(part).alias("part"))
    lines.write.partitionBy("part").text(f"{root}/parts")
    for part in range(AD_FILES):
        move(t.spark, f"{root}/parts/part={part}", f"{root}/log/part={part}")
        source = ad_log.read_text_log(t.spark, f"{root}/log")
        query, found = jobs.ad_job(
            source, f"{root}/tables", THRESHOLD, interval=None, buckets=_parts(t), state_partitions=shuffled
        )
        query.awaitTermination()
    return found


@query
def ad_job_user_clicks(t: Tables) -> DataFrame:
    return _ad_job(t).user_clicks.read()


@query
def ad_job_stat(t: Tables) -> DataFrame:
    return _ad_job(t).stat.read()


@query
def ad_job_top3(t: Tables) -> DataFrame:
    return _ad_job(t).read_top3()


@query
def ad_job_trend(t: Tables) -> DataFrame:
    return _ad_job(t).trend.read()


@query
def ad_job_rejects(t: Tables) -> DataFrame:
    return _ad_job(t).read_rejects()


# -- skew kit ---------------------------------------------------------------------------------


def _session_users(joined: DataFrame) -> DataFrame:
    return joined.select("session_id", "user_id", "step_length", "name", "professional", "city")


@query
def salted_agg(t: Tables) -> DataFrame:
    return skew.salted_agg(
        t.actions(), "city_id",
        {
            "actions": ("count", "*"),
            "clicks": ("count", "click_product_id"),
            "page_sum": ("sum", "page_id"),
            "first_action": ("min", "action_id"),
            "last_action": ("max", "action_id"),
        },
    )


@query
def salted_join(t: Tables) -> DataFrame:
    profiles = sessions.session_aggregate(t.actions())
    return _session_users(skew.salted_join(profiles, t.users(), "user_id"))


@query
def skew_split_join(t: Tables) -> DataFrame:
    profiles = sessions.session_aggregate(t.actions())
    return _session_users(
        skew.skew_split_join(profiles, t.users(), "user_id", target_rows=20, fraction=1)
    )


@query
def skew_join(t: Tables) -> DataFrame:
    """Joined with every user of more than five sessions treated as hot."""
    profiles = sessions.session_aggregate(t.actions())
    return _session_users(
        skew.skew_join(profiles, t.users(), "user_id", target_rows=5, fraction=1)
    )


@query
def map_side_join(t: Tables) -> DataFrame:
    profiles = sessions.session_aggregate(t.actions())
    return _session_users(skew.map_side_join(profiles, t.users(), "user_id"))


@query
def top_n_per_group(t: Tables) -> DataFrame:
    return ranking.top_n_per_group(
        t.raw("orders").select("o_custkey", "o_orderkey", "o_totalprice"),
        "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 2, rank="nth",
    )


# -- links ------------------------------------------------------------------------------------


def _links(t: Tables) -> DataFrame:
    return links.resolve_links(links.extract_links(t.raw("pages")))


@query
def page_links(t: Tables) -> DataFrame:
    return _links(t)


@query
def crawl_frontier(t: Tables) -> DataFrame:
    return links.crawl_frontier(_links(t), t.raw("pages"), contains=".example.")


@query
def crawl_rounds(t: Tables) -> DataFrame:
    """Everything that can be reached from the English pages, and how far away it is."""
    pages = t.raw("pages")
    edges = _links(t).join(pages.select("page_id", "url"), "page_id").select("url", "target")
    return links.crawl_rounds(edges, pages.where(F.col("url").contains("/en/")), contains=".example.")


# -- scalar functions -------------------------------------------------------------------------


@query
def number_functions(t: Tables) -> DataFrame:
    return t.raw("lineitem").select(
        "l_orderkey", "l_linenumber",
        round_half_up(F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
        round_half_up(F.col("l_quantity") / 200).alias("two_hundredths"),
    )


@query
def text_functions(t: Tables) -> DataFrame:
    packed = F.expr("concat('name=', c_name, '|note=|segment=', c_mktsegment, '|x=a=b')")
    nation = F.col("c_nationkey").cast("string")
    return t.raw("customer").select(
        "c_custkey",
        text.concat_long_string(F.col("c_custkey"), F.col("c_mktsegment")).alias("joined"),
        text.trim_comma(F.concat(F.lit(",,"), F.col("c_name"), F.lit(","))).alias("trimmed"),
        text.pad_two(nation).alias("padded"),
        text.packed_field(packed, "segment").alias("segment"),
        text.packed_field(packed, "note").alias("note"),
        text.packed_field(packed, "x").alias("x"),
        text.set_packed_field(packed, "segment", nation).alias("repacked"),
        text.remove_random_prefix(text.random_prefix(F.concat(F.lit("k_"), nation))).alias("key"),
        text.is_empty(F.lit("")).alias("empty"),
        text.is_not_empty(F.col("c_name")).alias("not_empty"),
    )


@query
def json_functions(t: Tables) -> DataFrame:
    return t.raw("events").select(
        "event_id",
        text.json_field(F.col("props"), "k").alias("k"),
        text.json_field(F.col("props"), "missing").alias("missing"),
        text.json_field(F.col("event_type"), "k").alias("broken"),
    )


@query
def date_functions(t: Tables) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    now, later = dates.format_time(ts), dates.format_time(ts + F.expr("make_dt_interval(0, user_id)"))
    return t.raw("events").select(
        "event_id",
        now.alias("time"),
        dates.format_date(ts).alias("date"),
        dates.format_date_key(ts).alias("date_key"),
        dates.format_minute(ts).alias("minute"),
        dates.date_hour(ts).alias("date_hour"),
        dates.parse_date_key(dates.format_date_key(ts)).cast("string").alias("day"),
        dates.before(now, later).alias("before"),
        dates.after(now, later).alias("after"),
        dates.minus_seconds(later, now).alias("seconds"),
        dates.minus_seconds(F.col("event_type"), now).alias("unreadable"),
    )


@query
def sql_functions(t: Tables) -> DataFrame:
    register_sql_functions(t.spark)
    return t.spark.sql(
        """
        select product_id,
               concat_long_string(product_id, product_name, '#') as joined,
               json_field(extend_info, 'product_status') as status,
               remove_random_prefix(random_prefix(product_name, 10)) as name
        from {products}
        """,
        products=t.products(),
    )


# -- sinks ------------------------------------------------------------------------------------


@query
def append_sink(t: Tables) -> DataFrame:
    """Two appends of half the areas each, read back."""
    path = work_path(t.spark, "append")
    top = products.area_top_products(_area_clicks(t), t.products())
    append(top.where(F.col("area").startswith("China")), path)
    append(top.where(~F.col("area").startswith("China")), path)
    return t.spark.read.schema(top.schema).parquet(path)


@query
def upsert_sink(t: Tables) -> DataFrame:
    """Per user the last order date, from the open orders first, then the finished and the pending
    ones, then those of any other status or none."""
    table = LedgerTable(
        Ledger(t.spark, work_path(t.spark, "upsert")), "last_orders",
        "o_custkey bigint, status string, orders bigint, last_order bigint", ["o_custkey"], buckets=_parts(t),
    )
    known = ("O", "F", "P")
    status = F.col("o_orderstatus")
    others = ~F.coalesce(status.isin(*known), F.lit(False))
    for chosen in (*(status == s for s in known), others):
        upsert(
            table,
            t.raw("orders").where(chosen).groupBy("o_custkey").agg(
                F.max("o_orderstatus").alias("status"),
                F.count("*").alias("orders"),
                F.max("o_orderkey").alias("last_order"),
            ),
        )
    return table.read()


@query
def replace_groups_sink(t: Tables) -> DataFrame:
    """Order counts per (status, priority); the groups of status F are then replaced by sums."""
    path = work_path(t.spark, "groups")
    orders = t.raw("orders").withColumnRenamed("o_orderstatus", "status")
    keys = ["status", "o_orderpriority"]
    replace_groups(orders.groupBy(*keys).agg(F.count("*").alias("n")), path, keys)
    changed = orders.where(F.col("status") == "F").groupBy(*keys).agg(F.sum("o_custkey").alias("n"))
    replace_groups(changed, path, keys)
    schema = "n bigint, status string, o_orderpriority string"
    return t.spark.read.schema(schema).parquet(path).select(*keys, "n")
