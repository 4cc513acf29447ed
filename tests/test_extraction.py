from __future__ import annotations

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.operators import extraction, sessions

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(["x", None]), st.integers(0, 9)), max_size=60)


@given(ROWS, st.integers(1, 4), st.integers(1, 12), st.integers(1, 7))
@settings(deadline=None)
def test_parts_hold_counts_and_first_rows(rows, n, held_rows, batch):
    """However often a task hands on its parts, they merge to the counts and the first rows."""
    fields = {"k": pa.string(), "l": pa.string(), "o": pa.int64(), "row": pa.int64()}
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in part], fields[c]) for i, c in enumerate(("k", "l", "o"))]
            + [pa.array(range(at, at + len(part)), pa.int64())], list(fields)
        )
        for at in range(0, len(rows), batch) for part in [rows[at : at + batch]]
    ]
    parts = [r for b in extraction._parts(["k", "l"], ["o"], n, held_rows)(iter(batches)) for r in b.to_pylist()]
    for group in {r[:2] for r in rows}:
        mine = [r for r in parts if (r["k"], r["l"]) == group]
        whole = sorted(r[2] for r in rows if r[:2] == group)
        assert sum(r["n"] for r in mine) == len(whole)
        kept = [r for r in mine if r["row"] is not None]
        assert sorted(r["o"] for r in kept)[:n] == whole[:n]
        assert all(rows[r["row"]] == (r["k"], r["l"], r["o"]) for r in kept)
        assert len({r["row"] for r in kept}) == len(kept)
    assert {(r["k"], r["l"]) for r in parts} == {r[:2] for r in rows}


def test_a_hot_hour_sends_few_rows_on(spark):
    """Parts are bounded by tasks, groups and sample size, not by the rows of a group."""
    df = spark.range(100_000, numPartitions=4).withColumn("k", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.lit(None)))
    parts = extraction.counted_samples(df, {"k": F.col("k")}, {"o": F.md5(F.col("id").cast("string"))}, 5).collect()
    assert len(parts) == 4 * 2 * (5 + 1)
    assert sum(p.n for p in parts if p.k == "hot") == 66_666
    want = [r.id for r in df.where("k = 'hot'").orderBy(F.md5(F.col("id").cast("string"))).limit(5).collect()]
    got = sorted((p.o, p.row.id) for p in parts if p.row is not None and p.k == "hot")
    assert [i for _, i in got[:5]] == want


def test_sessions_are_read_once(spark, tmp_path):
    """The sessions are evaluated a single time for counts and picks, unreadable times included."""
    rows = [(f"s{i}", f"2024-01-0{1 + i % 3} 0{i % 4}:00:00", ["k", "l"][: i % 3]) for i in range(90)] + [("s", None, None)]
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "session_id string, t string, words array<string>")
    df = df.withColumn("start_time", F.to_timestamp("t")).mapInArrow(seen, "session_id string, t string, words array<string>, start_time timestamp")
    got = sessions.sample_sessions(df, total=20)
    found = got.collect()
    got.count()
    assert read.value == len(rows) and len(found) in (19, 20)
    assert got.columns == [*df.columns, "date", "hour"]
    assert all(r.t == f"{r.date} {r.hour}:00:00" == str(r.start_time) for r in found)
