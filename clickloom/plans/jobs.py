"""The jobs. A batch job takes input frames and returns its result tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions import dates
from clickloom.operators import categories, funnel, news, products, sessions
from clickloom.operators.ads import BLACKLIST_THRESHOLD
from clickloom.operators.skew import hot_parts
from clickloom.sinks.append import append, result_rows
from clickloom.sources.params import TaskParams
from clickloom.sources.tables import scan_actions, scan_clicks
from clickloom.streaming import ads as stream
from clickloom.workspace import materialize, work_path

TOP_CATEGORIES = 10
TOP_SESSIONS = 3


def session_job(
    actions: DataFrame, users: DataFrame, params: TaskParams, task_id: int, extract: int = 100,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Session statistics, extraction, hot categories, active sessions and their actions.

    Three frames feed several results and are written out once: the profiles (all actions are
    aggregated a single time), those that pass the filter, and the actions of the latter. The
    profiles hold the number of actions of every session, so they also tell which sessions
    are hot when the actions are joined. Lists of keywords and categories are built for the
    extracted sessions alone.

    They lie under ``folder`` if one is given. The results read them, so delete it when the
    results are written: ``with scratch(spark, "job") as folder: write_results(...)``.
    """
    spark = actions.sparkSession
    folder = folder or work_path(spark, "session-job")
    actions = scan_actions(actions, params.start_date, params.end_date)
    profiles = materialize(sessions.session_profiles(actions, params), "profiles", f"{folder}/profiles")
    kept = materialize(
        sessions.profile_filter(profiles, users, params, hot=None), "kept", f"{folder}/kept"
    )
    hot = hot_parts(profiles, "session_id", weight="step_length")
    details = materialize(sessions.session_details(kept, actions, hot), "details", f"{folder}/details")
    top_categories = categories.top_categories(details, TOP_CATEGORIES)
    top_sessions = categories.top_sessions_per_category(details, top_categories, TOP_SESSIONS)
    top_details = categories.top_session_details(top_sessions, details)
    sample = sessions.with_lists(sessions.sample_sessions(kept, extract), details, hot)
    extracted = sessions.as_extract_rows(sample)
    found = {
        "session_aggr_stat": sessions.session_length_stats(kept),
        "session_random_extract": extracted,
        "top10_category": top_categories,
        "top10_session": top_sessions,
        "session_detail": top_details,
    }
    return {table: result_rows(df, table, task_id) for table, df in found.items()}


def funnel_job(actions: DataFrame, params: TaskParams, task_id: int) -> dict[str, DataFrame]:
    """Conversion rates of the task's page flow as one text."""
    views = scan_actions(actions, params.start_date, params.end_date)
    rates = funnel.page_convert_rates(views, params.page_flow)
    text = funnel.convert_rate_text(rates)
    table = "page_split_convert_rate"
    return {table: result_rows(text, table, task_id)}


def product_job(
    actions: DataFrame, cities: DataFrame, catalog: DataFrame, params: TaskParams, task_id: int
) -> dict[str, DataFrame]:
    """Top products per area."""
    clicks = scan_clicks(actions, params.start_date, params.end_date)
    top = products.area_top_products(products.area_product_clicks(clicks, cities), catalog)
    return {"area_top3_product": result_rows(top, "area_top3_product", task_id)}


def news_job(
    access: DataFrame, date: str | None = None, folder: str | None = None
) -> dict[str, DataFrame]:
    """The five indicators of one day, by default yesterday.

    The log is read once: its lines, counted by page and user, are written under ``folder`` (see
    :func:`session_job`), and all five are made of that.
    """
    spark = access.sparkSession
    if date is None:
        date = spark.range(1).select(dates.yesterday()).first()[0]
    visits = materialize(news.visits(access, date), "visits", f"{folder or work_path(spark, 'news-job')}/visits")
    return {
        "page_pv": news.daily_page_pv(visits),
        "page_uv": news.daily_page_uv(visits),
        "section_pv": news.daily_section_pv(visits),
        "register_rate": news.register_rate(visits),
        "jump_rate": news.jump_rate(visits),
    }


def ad_job(
    lines: DataFrame, root: str, threshold: int = BLACKLIST_THRESHOLD, interval: str | None = stream.INTERVAL,
    buckets: int = 1, state_partitions: int | None = None,
) -> tuple[StreamingQuery, stream.AdTables]:
    """Start the real-time ad statistics over a stream of log lines.

    Its tables lie under ``root``, with the checkpoint from which a new start goes on. ``buckets``
    as in :meth:`~clickloom.streaming.ads.AdTables.under`, and a batch is shuffled in
    ``state_partitions`` parts (see :func:`~clickloom.streaming.ads.start`).
    """
    tables = stream.AdTables.under(lines.sparkSession, f"{root}/tables", buckets=buckets)
    query = stream.start(
        lines, stream.job_batch(tables, threshold), f"{root}/checkpoint", interval=interval,
        state_partitions=state_partitions,
    )
    return query, tables


def write_results(results: dict[str, DataFrame], root: str) -> None:
    """Append each result to its table under ``root``."""
    for table, df in results.items():
        append(df, f"{root.rstrip('/')}/{table}")

