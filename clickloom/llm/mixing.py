"""Mix sources to target weights by hash thresholds found from histograms.

A source whose target is ``k`` times its size and a rest takes every document ``k`` times, and
once more those whose hash lies under a threshold. The threshold comes from word sums by
(source, hash bucket): the bucket in which the running sum passes the rest is refined, first
into finer buckets, then by single hashes, while all other buckets stay sums. Documents are
never sorted; the choice depends on ids and texts alone, so a rerun agrees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.workspace import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
# The hash has 60 bits: two levels of 12-bit buckets, then single hashes.
_LEVELS = (48, 36)
_END = 1 << 60


def word_count(text: Column) -> Column:
    """Words in a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(doc_id: Column, text: Column) -> Column:
    """A 60-bit hash of a document, the same in every run."""
    key = F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))
    )
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP
) -> DataFrame:
    """Target words of each source, from a table of ``source`` and ``size``.

    Sources in code point order, NULL last, have the weights in turn and share ``share`` times
    all words. No target exceeds ``cap`` times its source; the excess goes to the others by
    weight. With sources in order of ``cap * size / weight`` those that stop come first, so one
    running sum over the sources (one row each) finds the common level of the rest.
    """
    named = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    turn = F.array(*map(F.lit, weights))[(rank - 1) % len(weights)]
    most = F.col("source_size") * cap
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", F.asc_nulls_last("source")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    level = (
        (F.col("total") * F.lit(float(share)) - F.coalesce(F.sum(most).over(before), F.lit(0)))
        / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    return (
        named.withColumn("weight", turn.cast("long"))
        .withColumn("ratio", most.cast("double") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("level", level)
        .withColumn("open", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything))
        .select(
            "source", "source_size",
            F.when(F.col("ratio") > F.col("level"), F.col("weight") * F.col("open"))
            .otherwise(most.cast("double")).alias("target"),
        )
    )


def _passing(rows: DataFrame, plan: DataFrame, shift: int, above: int | None) -> DataFrame:
    """The bucket of each source where the running sum passes the rest: ``at`` its lower end,
    ``base`` the words before it. Sources that never pass end at the top."""
    bucket = F.shiftright("h", shift)
    if above is None:
        within = rows.select("source", "size", bucket.alias("b"))
        start = plan.withColumn("base", F.lit(0).cast("long"))
    else:
        edge = plan.where("inside").select(F.col("source").alias("s"), (F.shiftright("at", above)).alias("a"))
        within = rows.join(
            edge, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", above) == F.col("a"))
        ).select("source", "size", bucket.alias("b"))
        start = plan
    sums = within.groupBy("source", "b").agg(F.sum("size").alias("words"))
    ran = sums.withColumn("to", F.sum("words").over(Window.partitionBy("source").orderBy("b")))
    joined = ran.withColumnRenamed("source", "s").join(
        start.select("source", "rest", "base"), F.col("s").eqNullSafe(F.col("source"))
    )
    first = (
        joined.where(F.col("base") + F.col("to") > F.col("rest"))
        .groupBy("s")
        .agg(F.min(F.struct("b", (F.col("base") + F.col("to") - F.col("words")).alias("base"))).alias("x"))
        .select("s", F.shiftleft("x.b", shift).alias("new_at"), F.col("x.base").alias("new_base"))
    )
    out = start.join(first, F.col("source").eqNullSafe(F.col("s")), "left")
    if above is None:
        return out.select(
            *plan.columns, F.coalesce("new_at", F.lit(_END)).alias("at"),
            F.coalesce("new_base", "base").alias("base"),
            F.coalesce(F.col("new_base") < F.col("rest"), F.lit(False)).alias("inside"),
        )
    keep = [c for c in plan.columns if c not in ("at", "base", "inside")]
    return out.select(
        *keep, F.coalesce("new_at", "at").alias("at"), F.coalesce("new_base", "base").alias("base"),
        (F.col("inside") & F.coalesce(F.col("new_base") < F.col("rest"), F.lit(True))).alias("inside"),
    )


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` (source, source_size, target) with ``times`` and ``below``: every document
    counts ``times`` times, and once more if its hash is below ``below``.

    At the end of a threshold the hash is taken whole or not, whichever ends nearer the target.
    """
    size, target = F.col("source_size"), F.col("target")
    times = F.when(size > 0, F.floor(target / size)).otherwise(0)
    plan = plan.withColumn("times", times.cast("long")).withColumn(
        "rest", F.greatest(target - F.col("times") * size, F.lit(0.0))
    )
    plan = materialize(plan, "mix-plan")
    above = None
    for shift in _LEVELS:
        plan = materialize(_passing(rows, plan, shift, above), "mix-plan")
        above = shift
    edge = plan.where("inside").select(
        F.col("source").alias("s"), F.shiftright("at", above).alias("a"), "base", "rest"
    )
    inside = rows.join(
        edge, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", above) == F.col("a"))
    )
    single = inside.groupBy("source", "h").agg(
        F.sum("size").alias("words"), F.first("base").alias("base"), F.first("rest").alias("rest")
    )
    to = F.col("base") + F.sum("words").over(Window.partitionBy("source").orderBy("h"))
    last = (
        single.withColumn("to", to).where(F.col("to") * 2 - F.col("words") >= F.col("rest") * 2)
        .groupBy("source").agg(F.min("h").alias("below"))
    )
    return plan.join(
        last.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left"
    ).select(
        "source", "source_size", "target", "times",
        F.when(F.col("inside"), F.coalesce("below", F.col("at") + (1 << above)))
        .otherwise(F.col("at")).alias("below"),
    )


def plan_mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **kinds
) -> tuple[DataFrame, DataFrame]:
    """``(rows, plan)``: a narrow table of all documents (doc_id, source, size, h), written
    once, and the thresholds of each source (see :func:`thresholds`)."""
    rows = materialize(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
            word_count(F.col(f"`{text}`")).alias("size"),
            place(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("h"),
        ),
        "mix-rows",
    )
    plan = thresholds(rows, materialize(targets(rows, **kinds), "mix-targets"))
    return rows, materialize(plan, "mix-plan")


def taken_times(h: Column) -> Column:
    """How often the mix takes a document with hash ``h``."""
    return F.col("times") + F.when(h < F.col("below"), 1).otherwise(0)


def mix_report(docs: DataFrame, **columns) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document.

    NULL texts have size 0 and are taken 0 words; NULL is a source like others; documents with
    one id and text share their hash and are taken together; no rows give no rows.
    """
    rows, plan = plan_mix(docs, **columns)
    return rows.join(
        plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    ).select(
        "doc_id", "size", "source_size", "target", (taken_times(F.col("h")) * F.col("size")).alias("taken")
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **kinds
) -> DataFrame:
    """The documents as mixed: a row for each time one is taken, with the columns as given."""
    _, plan = plan_mix(docs, doc_id, text, source, **kinds)
    plan = plan.withColumnRenamed("source", "s").withColumnRenamed("target", "goal")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.col(f"`{source}`").alias("_source"), place(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("_h"),
    )
    met = rows.join(plan, F.col("_source").eqNullSafe(F.col("s")))
    times = F.explode(F.array_repeat(F.lit(1), taken_times(F.col("_h")).cast("int")))
    return met.select("doc", times.alias("_one")).select("doc.*")
