"""Quality scores of documents from boosted trees over statistics of their whole texts.

The model is fitted on the driver on a bounded sample of labelled rows (:data:`SAMPLE`, the rows
with the smallest hash of their id, so every run takes the same); all documents are scored in
tasks. Scores use nothing but the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom.llm import boosting
from clickloom.llm.stats import BASE, FEATURES, base_counts, features
from clickloom.llm.words import Texts, slices

#: The most labelled rows a model is fitted on.
SAMPLE = 20_000
THRESHOLD = 0.7


def _mapped(docs: DataFrame, text: str, make: Callable, names: list[str], types: list[str]) -> DataFrame:
    """Other columns of ``docs`` inside ``doc``, then what ``make`` gives for each text."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    kept = F.struct(*others) if others else F.struct(F.lit(1).alias("_"))
    source = docs.select(kept.alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = source.drop("text").schema
    for name, kind in zip(names, types):
        schema = schema.add(StructType.fromDDL(f"{name} {kind}")[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                texts = Texts(batch.column(1).slice(a, b - a))
                made = make(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *made], ["doc", *names]
                )

    return source.mapInArrow(run, schema)


def _features(texts: Texts) -> tuple[dict[str, np.ndarray], np.ndarray]:
    hashes = texts.hashes()
    base = base_counts(texts, hashes)
    return base, features(texts, hashes, base)


def training_rows(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, doc_id: str = "doc_id",
    text: str = "text", label: str = "quality", sample: int = SAMPLE,
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``sample`` labelled documents.

    Labels of an id are averaged (0.5 or more is 1); NULL ids and labels are left out, and
    so are ids that ``usable`` (over ``id``) excludes.
    """
    marks = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").alias("mark")).dropna()
    if usable is not None:
        marks = marks.where(usable)
    chosen = (
        marks.groupBy("id").agg((F.avg("mark") >= 0.5).cast("int").alias("mark"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    # At most SAMPLE rows of an id and a mark go to every task.
    found = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(chosen), "id"
    )
    made = _mapped(
        found, "text", lambda t: [pa.array(list(_features(t)[1]), pa.list_(pa.float64()))],
        ["x"], ["array<double>"],
    )
    # Ids that repeat in the documents could exceed the sample; the same bound holds again.
    rows = made.select("doc.mark", "x", "doc.id").orderBy(F.xxhash64("id"), "id", F.xxhash64("x")).limit(sample)
    table = rows.select("mark", "x").toArrow()
    marks = table.column("mark").to_numpy().astype(float)
    flat = table.column("x").combine_chunks().flatten().to_numpy()
    return flat.reshape(-1, len(FEATURES)), marks


def not_held_out(doc_id: Column) -> Column:
    """Ids whose CRC-32 (of the id as text) leaves another rest than 2 by 4."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "utf-8")) % 4 == 2


def score(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """Other columns of ``docs`` in ``doc`` and the ``score`` of each text, 0 to 1.

    Learned from ``labels`` that are not held out. An empty or NULL text is scored as a text
    without words. Without labels every score is 0.5.
    """
    x, y = training_rows(docs, labels, not_held_out(F.col("id")), doc_id, text, sample=sample)
    forest = boosting.train(x, y)
    return _mapped(docs, text, lambda t: [pa.array(forest.score(_features(t)[1]))], ["score"], ["double"])


def quality_report(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    made = score(docs, labels, doc_id, text, **kw)
    key = F.col(f"doc.`{doc_id}`")
    return made.select(
        key.alias("doc_id"), held_out(key).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The documents that the classifier accepts, with the columns as given."""
    whole = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"),
    )
    made = score(whole, labels.withColumnRenamed(doc_id, "doc_id"), **kw)
    return made.where(F.col("score") >= THRESHOLD).select("doc.whole").select("whole.*")


# --- quality rules: base rules, then trees that are monotonic in chosen statistics ---

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
RULE_THRESHOLD = 0.5
#: More symbols, repeated lines, repeated windows or exclamation marks never raise a score.
MONOTONE = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "exclamation_share": -1}


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])


def rules_report(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``score`` and ``kept`` of each document.

    A document is kept if it passes the base rules and its monotonic score is at least
    :data:`RULE_THRESHOLD`. NULL and empty texts have no words and fail the base rules.
    """
    x, y = training_rows(docs, labels, None, doc_id, text, sample=sample)
    signs = {FEATURES.index(name): sign for name, sign in MONOTONE.items()}
    forest = boosting.train(x, y, signs)

    def make(texts: Texts) -> list[pa.Array]:
        base, x = _features(texts)
        failed, points = base_failed(base), forest.score(x)
        columns = [pa.array(base[name], pa.int64()) for name in BASE]
        return [*columns, pa.array(failed), pa.array(points), pa.array(~failed & (points >= RULE_THRESHOLD))]

    names = [*BASE, "base_failed", "score", "kept"]
    made = _mapped(docs, text, make, names, ["long"] * len(BASE) + ["boolean", "double", "boolean"])
    return made.select(F.col(f"doc.`{doc_id}`").alias("doc_id"), *names)
