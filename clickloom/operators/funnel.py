"""Page flows: consecutive page views and the conversion rate of each step of a flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from clickloom.functions.numbers import ratio
from clickloom.operators.skew import TARGET_ROWS, Hot, cut_in_order, hot_frame, hot_parts, total_chunks
from clickloom.workspace import materialize

_ORDER = ("action_time", "action_id")


def page_transitions(
    actions: DataFrame, hot: Hot | None = None, **detect
) -> DataFrame:
    """(session_id, from_page, to_page) for each two consecutive views of a session."""
    return page_steps(actions, hot, **detect).where("follows").drop("follows")


def page_steps(actions: DataFrame, hot: Hot | None = None, **detect) -> DataFrame:
    """Every view with the one before it in its session: (session_id, from_page, to_page,
    follows), where ``follows`` is true, or NULL on the first view of a session.

    Views are ordered by time, then action id, which is unique in its session. An ordinary
    session is one window group; a hot session (see :func:`clickloom.operators.skew.hot_parts`)
    is cut into pieces of its order, for which its views are written out once.
    """
    views = actions.select("session_id", "page_id", *_ORDER)
    if hot is None:
        hot = hot_parts(views, "session_id", **detect)
    if hot:
        return _pair_pieces(views, hot, detect.get("target_rows", TARGET_ROWS))
    w = Window.partitionBy("session_id").orderBy(*_ORDER)
    return _paired(views, w)


def _paired(
    views: DataFrame, w: WindowSpec, page: str = "page_id", before: str = "page_id"
) -> DataFrame:
    """Each row's ``page`` with the ``before`` of the row ahead of it in its window group;
    ``follows`` is NULL on the first row."""
    return views.select(
        "session_id",
        F.lag(before).over(w).alias("from_page"),
        F.col(page).alias("to_page"),
        F.lag(F.lit(True)).over(w).alias("follows"),
    )


def _pair_pieces(views: DataFrame, hot: Hot, target_rows: int) -> DataFrame:
    """Pair the views of hot sessions in pieces, then close the seams between the pieces.

    A range partitioning by session and order cuts the hot sessions into pieces of about equal
    size, wherever in time or ids the views lie; a task takes as many pieces as it can hold. The
    piece of each view is written down, since a range partitioning done twice may cut at other
    places. Views are paired within their piece; for the seams the first and last page of each
    piece are enough.
    """
    chunks = hot_frame(views, ["session_id"], hot)
    mine = views.join(chunks.drop("_chunks"), "session_id")
    pieces = materialize(
        cut_in_order(mine, ["session_id", *_ORDER], total_chunks(hot), target_rows), "session-pieces"
    )
    others = views.join(chunks, "session_id", "left_anti")
    cold = _paired(others, Window.partitionBy("session_id").orderBy(*_ORDER))
    within = _paired(pieces, Window.partitionBy("session_id", "_piece").orderBy("_at"))
    ends = pieces.groupBy("session_id", "_piece").agg(
        F.min_by("page_id", "_at").alias("first_page"), F.max_by("page_id", "_at").alias("last_page")
    )
    seams = _paired(
        ends, Window.partitionBy("session_id").orderBy("_piece"), "first_page", "last_page"
    )
    # The first view of each piece comes from the seams, which know what went before it.
    return cold.unionByName(within.where("follows")).unionByName(seams)


def _steps(flow: Sequence[int]) -> list[tuple[int, int]]:
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    return list(zip(flow, flow[1:]))


def page_flow_splits(
    actions: DataFrame, flow: Sequence[int], hot: Hot | None = None
) -> DataFrame:
    """Views per step of the flow (``from_to``); a step never taken has no row."""
    steps = sorted(set(_steps(flow)))
    pairs = page_transitions(actions, hot)
    wanted = F.struct("from_page", "to_page").isin(
        [F.struct(F.lit(a).cast("bigint"), F.lit(b).cast("bigint")) for a, b in steps]
    )
    return (
        pairs.where(wanted)
        .groupBy(F.concat_ws("_", "from_page", "to_page").alias("page_split"))
        .agg(F.count("*").alias("pv"))
    )


def start_page_pv(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Views of the flow's first page in any session (one row)."""
    return actions.agg(F.count_if(F.col("page_id") == flow[0]).alias("start_pv"))


def page_convert_rates(
    actions: DataFrame,
    flow: Sequence[int],
    missing_as: int = 1,
    hot: Hot | None = None,
) -> DataFrame:
    """One row per step position: its views, the views before it, and their ratio.

    The first step is divided by the views of the start page, each later one by the step
    before it. A step without views, or a start page without views, counts ``missing_as``.
    All steps and the start page come out of one scan and one aggregation.
    """
    steps = _steps(flow)
    # Every view is the end of one step row, so the start page is counted in the same pass.
    counters = page_steps(actions, hot).agg(
        F.count_if(F.col("to_page") == flow[0]).alias("pv_0"),
        *(
            F.count_if(F.col("follows") & (F.col("from_page") == a) & (F.col("to_page") == b)).alias(f"pv_{i}")
            for i, (a, b) in enumerate(steps, 1)
        ),
    )
    # An absent count is NULL here and takes the stand-in.
    seen = [F.col("pv_0")] + [F.col(f"pv_{i}") for i in range(1, len(steps) + 1)]
    filled = [F.when(c > 0, c).otherwise(F.lit(missing_as).cast("bigint")) for c in seen]
    rows = F.array(
        *(
            F.struct(
                F.lit(i).alias("step"),
                F.lit(f"{a}_{b}").alias("page_split"),
                filled[i].alias("pv"),
                filled[i - 1].alias("base_pv"),
            )
            for i, (a, b) in enumerate(steps, 1)
        )
    )
    return (
        counters.select(F.inline(rows))
        .withColumn("convert_rate", ratio(F.col("pv"), F.col("base_pv")))
    )


def convert_rate_text(rates: DataFrame) -> DataFrame:
    """All steps in one text: ``a_b=rate|b_c=rate``, a repeated step once."""
    by_split = rates.groupBy("page_split").agg(F.max_by("convert_rate", "step").alias("rate"),
                                               F.min("step").alias("step"))
    pieces = F.array_sort(F.collect_list(F.struct("step", "page_split", "rate")))
    text = F.transform(
        pieces, lambda s: F.concat(s["page_split"], F.lit("="), s["rate"].cast("string"))
    )
    return by_split.agg(F.array_join(text, "|").alias("convert_rate"))
