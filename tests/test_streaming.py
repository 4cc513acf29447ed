from __future__ import annotations

import os
import random
import uuid
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickloom.operators import ads
from clickloom.sources.ad_log import parse_ad_log, read_text_log
from clickloom.streaming import ads as stream

DAY = 86_400_000
START = 1_704_067_200_000  # 2024-01-01


def line(ms, user, ad, place=("P", "c")):
    return f"{ms} {place[0]} {place[1]} {user} {ad}"


def put(folder: Path, name: str, lines) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def run(spark, source, process, checkpoint, mode="append", shape=lambda clicks: clicks, per_batch=1):
    clicks = parse_ad_log(read_text_log(spark, str(source), per_batch))
    stream.start(shape(clicks), process, str(checkpoint), mode, interval=None).awaitTermination()


def by_hand(batches, threshold):
    """User counts and blacklist of a run over these batches of (day, user, ad)."""
    counts, listed = Counter(), set()
    for batch in batches:
        counted = [c for c in batch if c[1] not in listed]
        counts.update(counted)
        listed |= {user for day, user, ad in counted if counts[day, user, ad] >= threshold}
    return counts, listed


def write_batches(source, seed, cuts):
    rng = random.Random(seed)
    clicks = [(rng.randrange(2), rng.randrange(5), rng.randrange(2)) for _ in range(90)]
    batches = []
    for i in range(cuts):
        part = clicks[i * 90 // cuts:(i + 1) * 90 // cuts]
        put(source, f"{i}.log", [line(START + day * DAY + n, user, ad) for n, (day, user, ad) in enumerate(part)])
        batches.append([(f"2024-01-0{day + 1}", user, ad) for day, user, ad in part])
    return batches


@pytest.mark.parametrize("cuts", [1, 3])
def test_click_pipeline_and_its_feedback(spark, tmp_path, cuts):
    batches = write_batches(tmp_path / "log", 4, cuts)
    # Files are taken in order of their age.
    for i in range(cuts):
        os.utime(tmp_path / "log" / f"{i}.log", (1_700_000_000 + i, 1_700_000_000 + i))
    tables = stream.AdTables.under(spark, str(tmp_path / "out"))
    run(spark, tmp_path / "log", stream.click_batch(tables, 7, merge_every=2), tmp_path / "cp")
    counts, listed = by_hand(batches, 7)
    assert rows_of(tables.user_clicks.read()) == sorted((*k, n) for k, n in counts.items())
    assert rows_of(tables.blacklist.read()) == sorted((u,) for u in listed)
    areas = Counter()
    for (day, _, ad), n in counts.items():
        areas[day, "P", "c", ad] += n
    stat = tables.stat.read()
    assert rows_of(stat) == sorted((*k, n) for k, n in areas.items())
    assert rows_of(tables.read_top3()) == rows_of(ads.ad_province_top3(stat))


def test_blacklist_does_not_depend_on_the_batches(spark, tmp_path):
    found = []
    for cuts in (1, 2):
        root = tmp_path / str(cuts)
        root.mkdir()
        write_batches(root / "log", 11, cuts)
        tables = stream.AdTables.under(spark, str(root / "out"))
        run(spark, root / "log", stream.click_batch(tables, 8), root / "cp")
        found.append(rows_of(tables.blacklist.read()))
    assert found[0] == found[1] != []


def test_a_replayed_batch_gives_the_same_tables(spark, tmp_path):
    put(tmp_path / "log", "0.log", [line(START + i, 1, 1) for i in range(5)] + [line(START, 2, 1)])
    tables = stream.AdTables.under(spark, str(tmp_path / "out"))
    process = stream.click_batch(tables, 5)
    clicks = parse_ad_log(spark.read.text(str(tmp_path / "log")))
    for _ in range(2):
        process(clicks, 0)
    assert rows_of(tables.user_clicks.read()) == [("2024-01-01", 1, 1, 5), ("2024-01-01", 2, 1, 1)]
    assert rows_of(tables.blacklist.read()) == [(1,)]
    # In the next batch the listed user is filtered.
    process(clicks, 1)
    assert rows_of(tables.user_clicks.read()) == [("2024-01-01", 1, 1, 5), ("2024-01-01", 2, 1, 2)]


def test_running_stat_goes_on_after_a_restart(spark, tmp_path):
    tables = stream.AdTables.under(spark, str(tmp_path / "out"), stat_combine="last")
    process = stream.stat_batch(tables)
    lines = [line(START + i * 1000, 1, i % 5, ("P", "ab"[i % 2])) for i in range(40)]
    put(tmp_path / "log", "0.log", lines[:15])
    run(spark, tmp_path / "log", process, tmp_path / "cp", "update", stream.running_ad_stat)
    put(tmp_path / "log", "1.log", lines[15:])
    run(spark, tmp_path / "log", process, tmp_path / "cp", "update", stream.running_ad_stat)
    batch = ads.ad_stat(parse_ad_log(spark.read.text(str(tmp_path / "log"))))
    assert rows_of(tables.stat.read()) == rows_of(batch)
    assert rows_of(tables.read_top3()) == rows_of(ads.ad_province_top3(batch))


def test_late_clicks_are_dropped_only_past_the_watermark(spark, tmp_path):
    table = stream.trend_table(spark, str(tmp_path / "trend"))
    hour = 3_600_000
    for i, (name, ms) in enumerate([("a", 5 * hour), ("b", int(4.5 * hour)), ("c", 2 * hour)]):
        put(tmp_path / "log", f"{name}.log", [line(START + ms, 1, 1)])
        run(
            spark, tmp_path / "log", table.write, tmp_path / "cp", "update",
            lambda clicks: stream.click_trend(clicks, lateness="60 minutes"),
        )
    assert rows_of(table.read()) == [("2024-01-01", "04", "30", 1, 1), ("2024-01-01", "05", "00", 1, 1)]
    everything = stream.trend_table(spark, str(tmp_path / "all"))
    run(
        spark, tmp_path / "log", everything.write, tmp_path / "cp2", "update",
        stream.click_trend,
    )
    assert len(rows_of(everything.read())) == 3


def test_sliding_windows_by_hand(spark, tmp_path):
    rng = random.Random(2)
    clicks = [(rng.randrange(3 * 3600), rng.randrange(2)) for _ in range(60)]
    put(tmp_path / "log", "0.log", [line(START + s * 1000, 1, ad) for s, ad in clicks])
    table = stream.sliding_table(spark, str(tmp_path / "sliding"))
    run(
        spark, tmp_path / "log", table.write, tmp_path / "cp", "update",
        lambda c: stream.sliding_clicks(c, "60 minutes", "20 minutes"),
    )
    expected = defaultdict(int)
    for second, ad in clicks:
        for back in range(3):
            expected[(second // 1200 - back) * 1200, ad] += 1
    got = table.read().selectExpr(f"unix_seconds(window_start) - {START // 1000}", "ad_id", "click_count")
    assert rows_of(got) == sorted((*k, n) for k, n in expected.items())


def test_stream_anti_join(spark, tmp_path):
    put(tmp_path / "log", "0.log", [line(START, u, 1) for u in (1, 2, 3)])
    listed = spark.createDataFrame([(2,)], "user_id bigint")
    seen = []
    run(
        spark, tmp_path / "log", lambda df, _: seen.extend(r["user_id"] for r in df.collect()),
        tmp_path / "cp", shape=lambda clicks: stream.filter_blacklist(clicks, listed),
    )
    assert sorted(seen) == [1, 3]


def test_a_running_query_triggers_every_five_seconds():
    class Writer:
        def __init__(self):
            self.calls = {}

        def __getattr__(self, name):
            def call(*args, **kwargs):
                self.calls[name] = (args, kwargs)
                return self

            return call

    class Stream:
        writeStream = Writer()

    stream.start(Stream(), print, "cp", mode="update")
    calls = Stream.writeStream.calls
    assert calls["trigger"] == ((), {"processingTime": "5 seconds"})
    assert calls["outputMode"] == (("update",), {})
    assert calls["option"] == (("checkpointLocation", "cp"), {})


def test_the_ad_job_keeps_late_clicks_and_broken_lines(spark, tmp_path):
    from clickloom.plans.jobs import ad_job

    days = [3, 2, 1]  # each file is older than the one before
    for i, day in enumerate(days):
        lines = [line(START + day * DAY + n * 1000, 1, 1) for n in range(4)] + [f"broken {i}"]
        put(tmp_path / "log", f"{i}.log", lines)
        os.utime(tmp_path / "log" / f"{i}.log", (1_700_000_000 + i, 1_700_000_000 + i))
    source = read_text_log(spark, str(tmp_path / "log"), 1)
    query, tables = ad_job(source, str(tmp_path / "out"), threshold=4, interval=None)
    query.awaitTermination()
    assert rows_of(tables.blacklist.read()) == [(1,)]
    assert rows_of(tables.user_clicks.read()) == [("2024-01-04", 1, 1, 4)]
    assert sum(r.click_count for r in tables.trend.read().collect()) == 12
    assert rows_of(tables.read_rejects()) == [(f"broken {i}",) for i in range(3)]


def test_a_batch_that_breaks_off_leaves_all_tables_as_they_were(spark, tmp_path, monkeypatch):
    """The user counts are written, the top lists are not: readers see neither."""
    source = lambda day: spark.createDataFrame(
        [(line(START + day * DAY + i, i % 4, i % 2),) for i in range(9)] + [(f"broken {day}",)], "value string"
    )
    tables = stream.AdTables.under(spark, str(tmp_path))
    process = stream.job_batch(tables, 3)
    state = lambda: [
        rows_of(df) for df in (tables.user_clicks.read(), tables.blacklist.read(), tables.stat.read(),
                               tables.read_top3(), tables.trend.read(), tables.read_rejects())
    ]
    process(source(0), 0)
    before = state()
    good = stream._top_lists

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(stream, "_top_lists", broken)
    with pytest.raises(RuntimeError, match="lost"):
        process(source(1), 1)
    assert state() == before and all(before)
    monkeypatch.setattr(stream, "_top_lists", good)
    process(source(1), 1)
    once = state()
    assert len(once[4]) == 2 * len(before[4]) and once[5] == [("broken 0",), ("broken 1",)]
    process(source(1), 1)
    assert state() == once


@given(st.lists(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 1), st.integers(0, 5), st.integers(1, 4)), max_size=12),
                min_size=2, max_size=4))
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_top_lists_kept_up_to_date_equal_a_full_ranking(spark, tmp_path, batches):
    """Only the old lists and the ads of a batch are ranked; ties are decided by ad."""
    tables = stream.AdTables.under(spark, f"{tmp_path}/{uuid.uuid4()}")
    process = stream.click_batch(tables, 10**6)
    schema = "ts timestamp, date string, province string, city string, user_id bigint, ad_id bigint"
    for number, rows in enumerate(batches):
        clicks = [(None, f"2024-01-0{d + 1}", f"P{p}", f"c{ad % 2}", 1, ad) for d, p, ad, n in rows for _ in range(n)]
        process(spark.createDataFrame(clicks, schema), number)
    assert rows_of(tables.read_top3()) == rows_of(ads.ad_province_top3(tables.stat.read()))
