from __future__ import annotations

from clickloom.sinks.append import append, append_jdbc, replace_groups, result_rows

SCHEMA = "date string, k bigint, n bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_replaced_groups(spark, tmp_path):
    path = str(tmp_path / "groups")
    replace_groups(frame(spark, [("d1", 1, 1), ("d1", 1, 2), ("d1", 2, 3), ("d2", 1, 4)]), path, ["date", "k"])
    replace_groups(frame(spark, [("d1", 1, 9), ("d3", 1, 5)]), path, ["date", "k"])
    got = spark.read.schema("n bigint, date string, k bigint").parquet(path).select("date", "k", "n")
    assert rows_of(got) == [("d1", 1, 9), ("d1", 2, 3), ("d2", 1, 4), ("d3", 1, 5)]


def test_append_and_result_columns(spark, tmp_path):
    df = spark.createDataFrame([(3, 2, 1, 0)], "pay_count bigint, category_id bigint, click_count bigint, order_count bigint")
    rows = result_rows(df, "top10_category", task_id=8)
    assert rows.columns == ["task_id", "category_id", "click_count", "order_count", "pay_count"]
    for _ in range(2):
        append(rows, str(tmp_path / "top"))
    assert rows_of(spark.read.parquet(str(tmp_path / "top"))) == [(8, 2, 1, 0, 3)] * 2


def test_jdbc_append_passes_its_options():
    class Writer:
        def mode(self, mode):
            self.saved = mode
            return self

        def jdbc(self, *args, **kwargs):
            self.call = (args, kwargs)

    class Frame:
        write = Writer()

    append_jdbc(Frame(), "jdbc:x", "ad_blacklist", {"user": "u"})
    assert Frame.write.saved == "append"
    assert Frame.write.call == (("jdbc:x", "ad_blacklist"), {"properties": {"user": "u"}})
