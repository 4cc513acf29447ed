"""Real-time ad statistics.

Two kinds of queries. The click pipeline runs batch operators per micro-batch, because what it
filters by (the blacklist) is what it produces. The running counts and trends are native
stateful aggregations; their state is bounded by a watermark.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators import ads
from clickloom.sinks.ledger import FOLD_EVERY, MERGE_EVERY, Batch, Cell, Ledger, LedgerTable, cells_of
from clickloom.sources.ad_log import ad_log_rejects, parse_ad_log

# Fixed value: the micro-batch interval.
INTERVAL = "5 seconds"
_STARTING = threading.Lock()


@dataclass
class AdTables:
    """The tables the click pipeline keeps under one root. A batch feeds all of them at once."""

    ledger: Ledger
    user_clicks: LedgerTable
    blacklist: LedgerTable
    stat: LedgerTable
    top3: LedgerTable
    trend: LedgerTable
    rejects: LedgerTable

    @classmethod
    def under(cls, spark: SparkSession, root: str, stat_combine: str = "sum", buckets: int = 1) -> AdTables:
        """``stat_combine="last"`` when the stat batches hold totals instead of increments.
        ``buckets`` parts a day and cannot change later: the clicks of a day by 10 million is a good number."""
        ledger = Ledger(spark, root)
        return cls(
            ledger,
            user_clicks=LedgerTable(
                ledger, "ad_user_click_count", "date string, user_id bigint, ad_id bigint, click_count bigint",
                ["date", "user_id", "ad_id"], "sum", "date", ["user_id"], buckets,
            ),
            blacklist=LedgerTable(ledger, "ad_blacklist", "user_id bigint", ["user_id"], buckets=buckets),
            stat=LedgerTable(
                ledger, "ad_stat", "date string, province string, city string, ad_id bigint, click_count bigint",
                ["date", "province", "city", "ad_id"], stat_combine, "date", ["province", "ad_id"], buckets,
            ),
            top3=LedgerTable(
                ledger, "ad_province_top3",
                "date string, province string, top array<struct<ad_id: bigint, click_count: bigint>>",
                ["date", "province"], "last", "date",
            ),
            trend=trend_table(spark, root, combine="sum", ledger=ledger),
            rejects=LedgerTable(ledger, "rejects", "value string", combine="append"),
        )

    def read_rejects(self) -> DataFrame:
        """The lines no batch could read."""
        return self.rejects.read()

    def read_top3(self) -> DataFrame:
        return _listed(self.top3.read())


def _listed(top: DataFrame) -> DataFrame:
    """Top lists as rows."""
    return top.select("date", "province", F.inline("top"))


def trend_table(
    spark: SparkSession, path: str, combine: str = "last", ledger: Ledger | None = None
) -> LedgerTable:
    """Clicks per minute and ad; each batch holds the new totals of the minutes it touched, or
    (``combine="sum"``) what it adds to them."""
    return LedgerTable(
        ledger or Ledger(spark, path), "ad_click_trend",
        "date string, hour string, minute string, ad_id bigint, click_count bigint",
        ["date", "hour", "minute", "ad_id"], combine, "date",
    )


def at_once(spark: SparkSession, *works: Callable[[], object]) -> None:
    """Run independent pieces of a batch side by side; Spark shares its tasks among their jobs."""
    with ThreadPoolExecutor(len(works)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(w)) for w in works]:
            done.result()


def job_batch(
    tables: AdTables, threshold: int = ads.BLACKLIST_THRESHOLD, merge_every: int = MERGE_EVERY,
    fold_every: int = FOLD_EVERY,
) -> Callable[[DataFrame, int], None]:
    """The whole ad job on one micro-batch of log lines.

    Four outputs come from one source: user counts with the blacklist they feed, area counts
    and province top lists of the clicks left by the blacklist as earlier batches made it, and
    the trend of all clicks. Every output adds to the key of a click whenever the click comes,
    so none is too late; lines that cannot be read are kept as they came. All of them commit
    together.
    """

    def process(lines: DataFrame, batch_id: int) -> None:
        batch = tables.ledger.begin(batch_id)
        lines = lines.persist()
        try:
            clicks = parse_ad_log(lines)
            at_once(
                lines.sparkSession,
                lambda: batch.stage(tables.rejects, ad_log_rejects(lines)),
                lambda: batch.stage(tables.trend, ads.ad_click_trend(clicks)),
                lambda: _stage_clicks(batch, tables, clicks, threshold),
            )
        finally:
            lines.unpersist()
        batch.commit(merge_every, fold_every)

    return process


def click_batch(
    tables: AdTables, threshold: int = ads.BLACKLIST_THRESHOLD, merge_every: int = MERGE_EVERY,
    fold_every: int = FOLD_EVERY,
) -> Callable[[DataFrame, int], None]:
    """The work of the click pipeline on one micro-batch of parsed clicks.

    1. Count the batch by user, and drop users listed by earlier batches. Counting first
       makes a hot user a handful of rows before any join.
    2. Write, side by side, the user counts and area counts of the batch, the users whose total
       for a (date, ad) of this batch reached the threshold (they are filtered from the next batch
       on), and the new top lists of its provinces.

    It reads only what batches with lower numbers wrote, so running a batch again gives the
    same rows again; and of the kept tables only the cells the batch has clicks of.
    """

    def process(clicks: DataFrame, batch_id: int) -> None:
        batch = tables.ledger.begin(batch_id)
        _stage_clicks(batch, tables, clicks, threshold)
        batch.commit(merge_every, fold_every)

    return process


def _stage_clicks(batch: Batch, tables: AdTables, clicks: DataFrame, threshold: int) -> None:
    counts = ads.click_counts(clicks).persist()
    try:
        listed, users, places, tops = cells_of(counts, tables.blacklist, tables.user_clicks, tables.stat, tables.top3)
        kept = counts.join(batch.old(tables.blacklist, listed), "user_id", "left_anti").persist()
        by_user, by_place = ads.ad_user_clicks(kept), ads.ad_stat(kept)
        try:
            at_once(
                clicks.sparkSession,
                lambda: batch.stage(tables.user_clicks, by_user),
                lambda: batch.stage(
                    tables.blacklist, ads.ad_blacklist(batch.changed(tables.user_clicks, by_user, users), threshold)
                ),
                lambda: batch.stage(tables.stat, by_place),
                lambda: batch.stage(tables.top3, _top_lists(batch, tables, by_place, places, tops)),
            )
        finally:
            kept.unpersist()
    finally:
        counts.unpersist()


def _top_lists(
    batch: Batch, tables: AdTables, stat: DataFrame, places: list[Cell], tops: list[Cell], n: int = 3
) -> DataFrame:
    """New top lists of the (date, province) of a batch.

    Counts only grow, so an ad that is neither on the old list nor in the batch still has ``n``
    better ones: the new list is the top of the old list and the ads of the batch.
    """
    group = ["date", "province"]
    best = ads.province_clicks(batch.changed(tables.stat, stat, places, [*group, "ad_id"]))
    if tables.top3.parts(batch.before, tops):
        old = _listed(batch.old(tables.top3, tops).join(stat.select(*group), group, "left_semi"))
        best = old.unionByName(best).groupBy(*group, "ad_id").agg(F.max("click_count").alias("click_count"))
    ranked = ads.ad_province_top3(best, n).groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("click_count")).alias("down"), "ad_id"))).alias("top")
    )
    lists = F.transform("top", lambda t: F.struct(t["ad_id"].alias("ad_id"), (-t["down"]).alias("click_count")))
    return ranked.select(*group, lists.alias("top"))


def filter_blacklist(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Stream of clicks without those of listed users (stream-static anti join)."""
    return clicks.join(blacklist.select("user_id"), "user_id", "left_anti")


def running_ad_stat(clicks: DataFrame, lateness: str | None = None) -> DataFrame:
    """Running clicks per (date, province, city, ad).

    Clicks of any age count and the state keeps every key. With a ``lateness`` days older than
    the watermark leave the state, and clicks later than that are dropped.
    """
    if lateness is not None:
        clicks = clicks.withWatermark("ts", lateness)
    counts = clicks.groupBy(F.window("ts", "1 day"), "province", "city", "ad_id").agg(
        F.count("*").alias("click_count")
    )
    return counts.select(
        F.date_format("window.start", "yyyy-MM-dd").alias("date"),
        "province", "city", "ad_id", "click_count",
    )


def click_trend(clicks: DataFrame, lateness: str | None = None) -> DataFrame:
    """Clicks per minute and ad; with a ``lateness`` a minute is final once the watermark has
    passed it, and later clicks are dropped."""
    if lateness is not None:
        clicks = clicks.withWatermark("ts", lateness)
    counts = clicks.groupBy(F.window("ts", "1 minute"), "ad_id").agg(
        F.count("*").alias("click_count")
    )
    start = F.col("window.start")
    return counts.select(
        F.date_format(start, "yyyy-MM-dd").alias("date"),
        F.date_format(start, "HH").alias("hour"),
        F.date_format(start, "mm").alias("minute"),
        "ad_id", "click_count",
    )


def sliding_clicks(
    clicks: DataFrame, length: str = "60 minutes", slide: str = "10 minutes",
    lateness: str | None = None,
) -> DataFrame:
    """Clicks per ad in windows of ``length`` that start every ``slide``.

    A click is in ``length / slide`` windows. The copies are counted within each task before
    anything is shuffled. For many windows per click, see :mod:`clickloom.operators.panes`.
    """
    if lateness is not None:
        clicks = clicks.withWatermark("ts", lateness)
    windows = clicks.groupBy(F.window("ts", length, slide), "ad_id").agg(
        F.count("*").alias("click_count")
    )
    return windows.select(
        F.col("window.start").alias("window_start"), "ad_id", "click_count"
    )


def start(
    stream: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    interval: str | None = INTERVAL,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a query; it continues from ``checkpoint`` if that exists.

    ``interval=None`` works through what is there now and stops. ``state_partitions`` is the
    number of parts the state of a new stateful query is kept in; it cannot change afterwards,
    so it should follow the size the state will have. By default it is the shuffle partitions
    of the session, as in Spark.
    """
    writer = stream.writeStream.outputMode(mode).foreachBatch(process)
    writer = writer.option("checkpointLocation", checkpoint)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    if state_partitions is None:
        return writer.start()
    # A query takes the setting of its session over when it starts; one starts at a time.
    conf = stream.sparkSession.conf
    with _STARTING:
        before = conf.get("spark.sql.shuffle.partitions")
        conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        try:
            return writer.start()
        finally:
            conf.set("spark.sql.shuffle.partitions", before)


def pane_table(spark: SparkSession, path: str, buckets: int = 1) -> LedgerTable:
    """Clicks per pane and ad, fed by the updates of :func:`~clickloom.operators.panes.pane_counts`
    over a stream; :func:`~clickloom.operators.panes.window_runs` makes windows of it."""
    return LedgerTable(
        Ledger(spark, path), "ad_panes", "date string, pane timestamp, ad_id bigint, click_count bigint",
        ["date", "pane", "ad_id"], "last", "date", ["ad_id"], buckets,
    )


def sliding_table(spark: SparkSession, path: str) -> LedgerTable:
    return LedgerTable(
        Ledger(spark, path), "ad_sliding", "window_start timestamp, ad_id bigint, click_count bigint",
        ["window_start", "ad_id"],
    )


def stat_batch(tables: AdTables) -> Callable[[DataFrame, int], None]:
    """Batch work for :func:`running_ad_stat`: take over the new totals and bring the lists up to date."""

    def process(updates: DataFrame, batch_id: int) -> None:
        batch = tables.ledger.begin(batch_id)
        updates = updates.persist()
        try:
            places, tops = cells_of(updates, tables.stat, tables.top3)
            at_once(
                updates.sparkSession,
                lambda: batch.stage(tables.stat, updates),
                lambda: batch.stage(tables.top3, _top_lists(batch, tables, updates, places, tops)),
            )
        finally:
            updates.unpersist()
        batch.commit()

    return process
