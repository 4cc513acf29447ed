"""Hot categories and their most active sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ranking import top_n, top_n_per_group
from clickloom.operators.skew import BROADCAST_LIMIT, map_side_join
from clickloom.workspace import materialize


_LISTS = {"order_category_ids": "order", "pay_category_ids": "pay"}


def _listed(column: str, wanted) -> Column:
    """Of the entries of an id list those that ``wanted`` (of number and text) chooses, with their kind."""
    entries = F.transform(F.split(column, ","), lambda t: F.struct(
        t.try_cast("bigint").alias("category_id"), F.lit(_LISTS[column]).alias("kind"), t.alias("value")))
    chosen = F.filter(entries, lambda e: wanted(e["category_id"]))
    return F.coalesce(chosen, F.array().cast("array<struct<category_id:bigint,kind:string,value:string>>"))


def _used(*columns: str) -> Column:
    return F.coalesce(*(F.col(c).cast("string") for c in columns)).isNotNull()


def category_events(details: DataFrame) -> DataFrame:
    """One row per category an action clicked, ordered or paid: (category_id, kind). Entries of id
    lists that are no numbers are in :func:`category_rejects`."""
    clicked = F.when(F.col("click_category_id").isNotNull(), F.array(F.struct(
        F.col("click_category_id").alias("category_id"), F.lit("click").alias("kind"), F.lit("").alias("value"))))
    nothing = F.array().cast("array<struct<category_id:bigint,kind:string,value:string>>")
    every = F.concat(F.coalesce(clicked, nothing), *(_listed(c, lambda i: i.isNotNull()) for c in _LISTS))
    return details.where(_used("click_category_id", *_LISTS)).select(F.inline(every)).drop("value")


def category_rejects(details: DataFrame) -> DataFrame:
    """The entries of order and payment lists that are no numbers, as they came: (session_id, kind, value)."""
    every = F.concat(*(_listed(c, lambda i: i.isNull()) for c in _LISTS))
    return details.where(_used(*_LISTS)).select("session_id", F.inline(every)).drop("category_id")


def category_counts(details: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category; an absent kind counts 0."""
    return category_events(details).groupBy("category_id").agg(
        *(F.count_if(F.col("kind") == kind).alias(f"{kind}_count")
          for kind in ("click", "order", "pay"))
    )


def top_categories(details: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` categories with the most clicks, then orders, then payments."""
    order = [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")]
    return top_n(category_counts(details), order, n)


def top_sessions_per_category(details: DataFrame, categories: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` sessions that clicked each given category most often.

    ``categories`` is a top list; it joins before the count, so only clicks on listed
    categories are shuffled. Its size is known to Spark when it comes from a limit.
    """
    clicks = details.where(F.col("click_category_id").isNotNull()).select(
        F.col("click_category_id").alias("category_id"), "session_id"
    )
    counts = (
        clicks.join(categories.select("category_id"), "category_id", "left_semi")
        .groupBy("category_id", "session_id")
        .agg(F.count("*").alias("click_count"))
    )
    return top_n_per_group(
        counts, "category_id", [F.desc("click_count"), F.asc("session_id")], n
    ).select("category_id", "session_id", "click_count")


def top_session_details(
    top_sessions: DataFrame, details: DataFrame, distinct_sessions: bool = False,
    max_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The actions of the top sessions, once per category the session is listed for.

    The list is written out, so its size is known: within ``max_bytes`` it goes to every
    task and the details are not shuffled, otherwise the join cuts hot sessions.
    """
    listed = top_sessions.select("session_id")
    if distinct_sessions:
        listed = listed.distinct()
    listed = materialize(listed, "top-sessions")
    return map_side_join(details, listed, "session_id", max_bytes=max_bytes).select(*details.columns)
