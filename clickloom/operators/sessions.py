"""Session profiles, their filter, length statistics, extraction and details."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import predicates as p
from clickloom.functions.dates import date_hour, format_time
from clickloom.functions.numbers import ratio
from clickloom.operators.chunks import CHUNK_BYTES, chunked_values
from clickloom.operators.extraction import counted_samples
from clickloom.operators.ranking import top_n_per_group
from clickloom.operators.skew import Hot, hot_parts, skew_join
from clickloom.sources.params import TaskParams
from clickloom.workspace import materialize

# Bucket name, lowest and highest value (both inside; None is open).
VISIT_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
STEP_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)


def session_aggregate(
    actions: DataFrame, users: DataFrame | None = None, hot: Hot | None = None
) -> DataFrame:
    """One row per session: user, distinct keywords and clicked categories, lengths, start.

    With ``users`` the profile gains age, professional, city and sex, and sessions of unknown
    users drop out. ``hot`` are users of too many sessions for a task, by default looked for among
    those of many actions.

    Actions are first reduced to one row per (session, keyword, category). That step combines
    on the map side and spreads a giant session over many tasks; only its distinct values
    meet in the second step, which builds the lists. Where the lists of a session may be too
    long for a row, take :func:`session_profiles` and :func:`session_value_chunks`.
    """
    keyword = F.when(F.col("search_keyword") != "", F.col("search_keyword"))
    pieces = (
        actions.select(
            "session_id", "user_id", "action_time",
            keyword.alias("keyword"), F.col("click_category_id").alias("category"),
        )
        .groupBy("session_id", "keyword", "category")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min("action_time").alias("first_time"),
            F.max("action_time").alias("last_time"),
            F.count("*").alias("steps"),
        )
    )
    sessions = (
        pieces.groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            F.array_sort(F.collect_set("keyword")).alias("search_keywords"),
            F.array_sort(F.collect_set("category")).alias("click_category_ids"),
            F.min("first_time").alias("start_time"),
            F.max("last_time").alias("end_time"),
            F.sum("steps").alias("step_length"),
        )
        .select(
            "session_id", "user_id", "search_keywords", "click_category_ids",
            (F.unix_seconds("end_time") - F.unix_seconds("start_time")).alias("visit_length"),
            "step_length", "start_time",
        )
    )
    if users is None:
        return sessions
    # A user has no more sessions than actions, and counting these needs no sessions.
    return with_user_info(sessions, users, hot_parts(actions, "user_id") if hot is None else hot)


def with_user_info(
    sessions: DataFrame, users: DataFrame, hot: Hot | None = None
) -> DataFrame:
    """Inner join of sessions with user facts. Sessions of hot users (by default looked for) join
    in chunks."""
    facts = users.select("user_id", "age", "professional", "city", "sex")
    joined = skew_join(sessions, facts, "user_id", hot=hot)
    return joined.select(*sessions.columns, "age", "professional", "city", "sex")


def session_value_chunks(
    actions: DataFrame, sessions: DataFrame | None = None, hot: Hot | None = None,
    chunk_bytes: int = CHUNK_BYTES, **detect,
) -> DataFrame:
    """The lists of :func:`session_aggregate` for sessions of any size: chunks of the distinct
    keywords (``kind`` ``keyword``) and clicked categories (``category``, as text in the order of
    their numbers) of all sessions, or of the given ones."""
    if sessions is not None:
        actions = session_details(sessions, actions, hot)
    if hot is None:
        hot = hot_parts(actions, "session_id", **detect)
    made = []
    for kind, column in (("keyword", "search_keyword"), ("category", "click_category_id")):
        filled = actions.where(F.col(column).cast("string") != "")
        chunks = chunked_values(filled, "session_id", column, chunk_bytes, hot, **detect)
        made.append(chunks.select(
            "session_id", F.lit(kind).alias("kind"), "chunk", "position", F.col("values").cast("array<string>").alias("values")
        ))
    return made[0].unionByName(made[1])


def session_filter(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions meeting every given parameter."""
    return sessions.where(
        p.all_of(
            p.between(F.col("age"), params.start_age, params.end_age),
            p.in_list(F.col("professional"), params.professionals),
            p.in_list(F.col("city"), params.cities),
            p.equal(F.col("sex"), params.sex),
            p.any_in(F.col("search_keywords"), params.keywords),
            p.any_in(F.col("click_category_ids"), params.category_ids),
        )
    )


def session_profiles(actions: DataFrame, params: TaskParams) -> DataFrame:
    """One row per session with its lengths, its start, and whether it meets the keyword and the
    category parameter (``has_keyword``, ``has_category``).

    What the filter asks of keywords and categories is folded in while counting, so however
    many different ones a session has, its row stays small; :func:`with_lists` builds the
    lists for the sessions that are delivered.
    """

    def meets(value: Column, wanted: Sequence | None) -> Column:
        if not wanted:
            return F.lit(True)
        return F.coalesce(F.bool_or(value.isin(list(wanted))), F.lit(False))

    keyword = F.when(F.col("search_keyword") != "", F.col("search_keyword"))
    return (
        actions.groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            (F.unix_seconds(F.max("action_time")) - F.unix_seconds(F.min("action_time"))).alias("visit_length"),
            F.count("*").alias("step_length"),
            F.min("action_time").alias("start_time"),
            # An empty keyword is no keyword, on either side.
            meets(keyword, params.keywords).alias("has_keyword"),
            meets(F.col("click_category_id"), params.category_ids).alias("has_category"),
        )
    )


def profile_filter(
    profiles: DataFrame, users: DataFrame, params: TaskParams, hot: Hot | None = None
) -> DataFrame:
    """The :func:`session_profiles` that meet every given parameter, with user facts."""
    known = with_user_info(profiles, users, hot)
    return known.where(
        p.all_of(
            p.between(F.col("age"), params.start_age, params.end_age),
            p.in_list(F.col("professional"), params.professionals),
            p.in_list(F.col("city"), params.cities),
            p.equal(F.col("sex"), params.sex),
            F.col("has_keyword"), F.col("has_category"),
        )
    ).drop("has_keyword", "has_category")


def with_lists(
    sessions: DataFrame, actions: DataFrame, hot: Hot | None = None
) -> DataFrame:
    """Add the distinct keywords and clicked categories of the given sessions."""
    keyword = F.when(F.col("search_keyword") != "", F.col("search_keyword"))
    mine = session_details(sessions, actions, hot).select(
        "session_id", keyword.alias("keyword"), F.col("click_category_id").alias("category")
    )
    lists = mine.distinct().groupBy("session_id").agg(
        F.array_sort(F.collect_set("keyword")).alias("search_keywords"),
        F.array_sort(F.collect_set("category")).alias("click_category_ids"),
    )
    return sessions.join(lists, "session_id")


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """What :func:`session_filter` keeps of :func:`session_aggregate`, with lists built for the
    kept sessions alone. The kept sessions are written out once."""
    busy = hot_parts(actions, "user_id")
    kept = materialize(profile_filter(session_profiles(actions, params), users, params, busy), "session-kept")
    columns = [
        "session_id", "user_id", "search_keywords", "click_category_ids", "visit_length", "step_length",
        "start_time", "age", "professional", "city", "sex",
    ]
    return with_lists(kept, actions).select(*columns)


def session_length_stats(sessions: DataFrame) -> DataFrame:
    """Session count, and for each length bucket the count and its share of the sessions.

    One row. A visit of 0 seconds is in no bucket. Without sessions the shares are NULL.
    """
    inside = {}
    for kind, buckets in (("visit_length", VISIT_BUCKETS), ("step_length", STEP_BUCKETS)):
        for name, low, high in buckets:
            top = "" if high is None else f" and {kind} <= {high}"
            inside[f"{kind}_{name}"] = f"{kind} >= {low}{top}"
    counts = sessions.selectExpr(
        "count(*) as session_count",
        *(f"count_if({condition}) as {name}" for name, condition in inside.items()),
    )
    # One rounding body for all shares keeps the generated code small.
    shares = F.transform(
        F.array(*inside), lambda count: ratio(count, F.col("session_count"))
    )
    return counts.withColumn("_shares", shares).selectExpr(
        *counts.columns, *(f"_shares[{i}] as {name}_ratio" for i, name in enumerate(inside))
    )


def session_hourly_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per hour of their start, keyed ``yyyy-MM-dd_HH``."""
    return sessions.groupBy(date_hour(F.col("start_time")).alias("date_hour")).agg(
        F.count("*").alias("session_count")
    )


def _date_and_hour() -> dict[str, Column]:
    return {"date": F.date_format("start_time", "yyyy-MM-dd"), "hour": F.date_format("start_time", "HH")}


def sample_quotas(sessions: DataFrame, total: int = 100) -> DataFrame:
    """Sessions to extract per (date, hour) by :func:`share_quotas`; the sessions are read once."""
    hourly = sessions.groupBy(*(c.alias(name) for name, c in _date_and_hour().items())).agg(
        F.count("*").alias("session_count")
    )
    return share_quotas(materialize(hourly, "hourly-sessions"), total)


def share_quotas(hourly: DataFrame, total: int = 100) -> DataFrame:
    """How many of the ``session_count`` sessions of each (date, hour) are extracted: ``total``
    of them, or all if there are fewer.

    The days share them evenly; a day with fewer sessions than its part gives all, and the
    other days share what is left (odd ones go to the earliest days). Within a day the hours
    share in proportion to their sessions, the largest remainders rounded up (ties: the earlier
    hour). All of it is integer arithmetic on the hourly counts.
    """
    # One row per day from here: days in order of their size, those that give all come first.
    daily = hourly.groupBy("date").agg(F.sum("session_count").alias("day_count"))
    every = Window.partitionBy()
    by_size = Window.orderBy("day_count", "date")
    before = F.coalesce(
        F.sum("day_count").over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    wanted = F.least(F.lit(total).cast("long"), F.sum("day_count").over(every))
    daily = (
        daily.withColumn("wanted", wanted)
        .withColumn("days_left", F.count("*").over(every) - F.row_number().over(by_size) + 1)
        .withColumn("all_of_it", F.col("day_count") * F.col("days_left") <= F.col("wanted") - before)
        .withColumn("rest", F.col("wanted") - F.coalesce(F.sum(F.when(F.col("all_of_it"), F.col("day_count"))).over(every), F.lit(0)))
        .withColumn("sharing", F.count_if(~F.col("all_of_it")).over(every))
        .withColumn("nth", F.row_number().over(Window.orderBy("all_of_it", "date")))
    )
    share = F.expr("rest div sharing + if(nth <= rest % sharing, 1, 0)")
    daily = daily.select("date", "day_count", F.when(F.col("all_of_it"), F.col("day_count")).otherwise(share).alias("day_quota"))
    day = Window.partitionBy("date")
    return (
        hourly.join(daily, "date")
        .withColumn("part", F.expr("day_quota * session_count div day_count"))
        .withColumn("over", F.expr("day_quota * session_count % day_count"))
        .withColumn("missing", F.col("day_quota") - F.sum("part").over(day))
        .withColumn("nth", F.row_number().over(day.orderBy(F.desc("over"), "hour")))
        .select(
            "date", "hour", "session_count",
            (F.col("part") + (F.col("nth") <= F.col("missing")).cast("long")).alias("quota"),
        )
    )


def sample_sessions(sessions: DataFrame, total: int = 100, seed: int = 9) -> DataFrame:
    """Extract sessions by the quotas of :func:`sample_quotas`, picked by a seeded hash.

    The sessions are read once: tasks count each (date, hour) and keep its first ``total`` picks,
    as no quota exceeds that. Both are written out; the quotas are made of the counts and applied
    to the picks.
    """
    when = _date_and_hour()
    pick = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("session_id")))
    rows = sessions.withColumns(when)
    order = {"_pick": pick, "_id": F.col("session_id")}
    parts = materialize(
        counted_samples(rows, {c: F.col(c) for c in when}, order, total), "session-picks"
    )
    hourly = parts.groupBy(*when).agg(F.sum("n").alias("session_count"))
    quotas = share_quotas(hourly, total).select(*when, "quota")
    cut = top_n_per_group(parts.where("row is not null"), list(when), [F.col(c) for c in order], total, rank="_nth")
    return cut.join(quotas, list(when)).where(F.col("_nth") <= F.col("quota")).select("row.*")


def session_details(
    sessions: DataFrame, actions: DataFrame, hot: Hot | None = None
) -> DataFrame:
    """The actions of the given sessions. Actions of hot sessions are joined in chunks."""
    return skew_join(actions, sessions.select("session_id"), "session_id", "left_semi", hot)


def as_extract_rows(sessions: DataFrame) -> DataFrame:
    """Sessions in the text form of the extraction table."""
    return sessions.select(
        "session_id",
        format_time(F.col("start_time")).alias("start_time"),
        F.array_join("search_keywords", ",").alias("search_keywords"),
        F.array_join("click_category_ids", ",").alias("click_category_ids"),
    )
