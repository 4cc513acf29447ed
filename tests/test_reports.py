"""Products, news indicators, ads in batch form, links."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickloom.operators import ads, links, news, products


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- products


@pytest.fixture(scope="module")
def cities(spark):
    return spark.createDataFrame(
        [
            (1, "A", "China North"), (11, "A", "China North"), (2, None, "China Middle"),
            (3, "C", "West South"), (4, "D", "East North"),
        ],
        "city_id bigint, city_name string, area string",
    )


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(
        [
            (1, "p1", '{"product_status": 0}'), (2, "p2", '{"product_status": 1}'),
            (3, "p3", "{broken"), (4, "p4", None), (5, "p5", '{"product_status": "0"}'),
        ],
        "product_id bigint, product_name string, extend_info string",
    )


def clicks(spark, rows):
    return spark.createDataFrame(rows, "city_id bigint, product_id bigint")


def test_area_clicks_and_city_list(spark, cities):
    df = clicks(spark, [(1, 1), (11, 1), (11, 1), (2, 1), (99, 1), (None, 1)])
    assert tuples(products.area_product_clicks(df, cities)) == [
        ("China Middle", 1, 1, "2:null"), ("China North", 1, 3, "11:A,1:A"),
    ]


def test_top_products_status_level_and_ties(spark, cities, catalog):
    rows = [(3, 3)] * 2 + [(3, 2)] * 2 + [(3, 1)] * 2 + [(3, 4)] * 2 + [(3, 99)] * 9
    rows += [(2, 5), (4, 2), (1, 4)]
    top = products.area_top_products(
        products.area_product_clicks(clicks(spark, rows), cities), catalog
    )
    got = [(r["area"], r["area_level"], r["product_id"], r["product_status"]) for r in top.collect()]
    assert sorted(got) == [
        ("China Middle", "B Level", 5, "Self"), ("China North", "A Level", 4, "Third Party"),
        ("East North", "D Level", 2, "Third Party"), ("West South", "C Level", 1, "Self"),
        ("West South", "C Level", 2, "Third Party"), ("West South", "C Level", 3, "Third Party"),
    ]


def test_levels_can_be_given(spark):
    row = spark.range(1).select(
        products.area_level(F.lit("X"), {"X": "top"}), products.area_level(F.lit("Y"), {"X": "top"})
    ).first()
    assert tuple(row) == ("top", "D Level")


# -- news


@pytest.fixture(scope="module")
def access(spark):
    rows = [
        ("d1", 1, 7, "a", "view"), ("d1", 1, 7, "a", "view"), ("d1", 2, 7, "a", "view"),
        ("d1", None, 7, "a", "view"), ("d1", None, 7, "a", "view"), ("d1", None, 8, "b", "view"),
        ("d1", 3, 8, "b", "view"), ("d1", None, None, None, "register"),
        ("d2", None, None, None, "register"), ("d2", 1, 7, "a", "view"),
    ]
    return spark.createDataFrame(
        rows, "date string, userid bigint, pageid bigint, section string, action string"
    )


def test_news(access):
    assert [tuple(r) for r in news.daily_page_pv(access, "d1").collect()] == [
        ("d1", 7, 5), ("d1", 8, 2),
    ]
    # Anonymous views count as one visitor.
    assert [tuple(r) for r in news.daily_page_uv(access, "d1").collect()] == [
        ("d1", 7, 3), ("d1", 8, 2),
    ]
    assert [tuple(r) for r in news.daily_section_pv(access, "d1").collect()] == [
        ("d1", "a", 5), ("d1", "b", 2),
    ]
    assert tuples(news.register_rate(access)) == [("d1", 1, 3, 0.33), ("d2", 1, 0, None)]
    assert tuples(news.jump_rate(access)) == [("d1", 2, 4, 0.5), ("d2", 1, 1, 1.0)]
    assert news.daily_page_pv(access).count() == 3


# -- ads


@pytest.fixture(scope="module")
def ad_clicks(spark):
    rows = (
        [("d1", "P", "a", 1, 1)] * 3 + [("d1", "P", "b", 1, 1)] * 2 + [("d2", "P", "a", 1, 1)]
        + [("d1", "P", "a", 2, a) for a in (1, 2, 2, 3, 3, 4)] + [("d2", "Q", "c", 3, 9)] * 2
    )
    return spark.createDataFrame(
        rows, "date string, province string, city string, user_id bigint, ad_id bigint"
    )


def test_ads(ad_clicks):
    per_user = ads.ad_user_clicks(ad_clicks)
    assert ("d1", 1, 1, 5) in tuples(per_user)
    assert tuples(ads.ad_user_clicks(ads.click_counts(ad_clicks))) == tuples(per_user)
    assert tuples(ads.ad_blacklist(per_user, 5)) == [(1,)]
    assert tuples(ads.ad_blacklist(per_user)) == []
    kept = ads.ad_filtered_clicks(ad_clicks, ads.ad_blacklist(per_user, 5))
    assert {r["user_id"] for r in kept.collect()} == {2, 3} and kept.count() == 8
    stat = ads.ad_stat(ad_clicks)
    assert tuples(ads.ad_stat(ads.click_counts(ad_clicks))) == tuples(stat)
    assert ("d1", "P", "b", 1, 2) in tuples(stat)
    assert tuples(ads.ad_province_top3(stat)) == [
        ("d1", "P", 1, 6), ("d1", "P", 2, 2), ("d1", "P", 3, 2), ("d2", "P", 1, 1),
        ("d2", "Q", 9, 2),
    ]
    assert tuples(ads.ad_province_top3(stat, per_day=False)) == [
        ("d1", "P", 1, 6), ("d1", "P", 2, 2), ("d1", "P", 3, 2), ("d2", "Q", 9, 2),
    ]


# -- links


def test_links(spark):
    html = """
      <a href="/abs">x</a> <a href='rel/p.html'>x</a> <img src="http://o.org/i.png">
      <a href="https://s.org">x</a> <a href="//cdn.org/x.js">x</a> <a href="#top">x</a>
      <a href="javascript:f()">x</a> <a href="mailto:a@b">x</a> <a href="">x</a>
      <a href="/abs">again</a> <a HREF="/upper">x</a> <a href="it's">x</a>
    """
    pages = spark.createDataFrame(
        [
            (1, "http://u:p@h.com:80/d/e.html?q=1", html), (2, "https://h.com:8080/x", '<a href="y">'),
            (3, "http://h.com/z", "<p>none</p>"), (4, "http://h.com/z", None),
        ],
        "page_id bigint, url string, html string",
    )
    found = links.resolve_links(links.extract_links(pages))
    assert tuples(found) == sorted(
        [
            (1, "/abs", "http://h.com/abs"),
            (1, "rel/p.html", "http://u:p@h.com:80/d/rel/p.html"),
            (1, "http://o.org/i.png", "http://o.org/i.png"),
            (1, "https://s.org", "https://s.org"),
            (1, "//cdn.org/x.js", "http://cdn.org/x.js"),
            (1, "it's", "http://u:p@h.com:80/d/it's"),
            (2, "y", "https://h.com:8080/y"),
        ],
        key=repr,
    )
    assert [
        tuple(r)[0] for r in pages.select(links.host_base(F.col("url"))).limit(2).collect()
    ] == ["http://h.com", "https://h.com:8080"]
    visited = spark.createDataFrame([("http://h.com/abs",)], "url string")
    assert tuples(links.crawl_frontier(found, visited, "h.com")) == [
        ("http://u:p@h.com:80/d/it's",), ("http://u:p@h.com:80/d/rel/p.html",),
        ("https://h.com:8080/y",),
    ]
    assert links.crawl_frontier(found, visited).count() == 6


def test_links_of_pages_without_a_path_and_schemes_in_upper_case(spark):
    from clickloom.operators import links

    df = spark.createDataFrame(
        [("http://a.com", "x.html"), ("http://a.com/p/q", "HTTP://b.com/x"), ("http://a.com/p/q", "x"), ("http://a.com/", "y")],
        "url string, link string",
    )
    got = [r.t for r in df.select(links.resolve_link(df.url, df.link).alias("t")).collect()]
    assert got == ["http://a.com/x.html", "HTTP://b.com/x", "http://a.com/p/x", "http://a.com/y"]


@pytest.mark.parametrize("seed", range(3))
def test_crawl_rounds_equal_a_queue(spark, tmp_path, seed):
    """Circles, a page of very many links, dead ends, seeds that repeat or are unknown."""
    import random
    from collections import deque

    rng = random.Random(seed)
    edges = [(f"http://a/{rng.randrange(60)}", f"http://{rng.choice('ab')}/{rng.randrange(90)}") for _ in range(80)]
    edges += [("http://a/3", f"http://a/{i}") for i in range(40, 60)] + [(f"http://a/{i}", f"http://a/{i + 1}") for i in range(200, 206)]
    edges += edges[:5] + [("http://a/1", "http://a/1"), (None, "http://a/2"), ("http://a/2", None)]
    seeds = ["http://a/3", "http://a/3", "http://a/200", "http://nowhere/", None]
    expected, queue = {}, deque((s, 0) for s in seeds if s)
    while queue:
        url, depth = queue.popleft()
        if url not in expected:
            expected[url] = depth
            queue.extend((t, depth + 1) for u, t in edges if u == url and t and "a/" in t)
    web = spark.createDataFrame(edges, "url string, target string")
    start = spark.createDataFrame([(s,) for s in seeds], "url string")
    for n, more in enumerate(({}, {"target_rows": 5, "fraction": 1})):
        got = links.crawl_rounds(web, start, "a/", folder=str(tmp_path / str(n)), **more)
        assert {r["url"]: r["depth"] for r in got.collect()} == expected and got.count() == len(expected)
    assert max(expected.values()) >= 6
    two = links.crawl_rounds(web, start, "a/", most_rounds=2, folder=str(tmp_path / "two"))
    assert {r["url"]: r["depth"] for r in two.collect()} == {u: d for u, d in expected.items() if d <= 2}
    assert links.crawl_rounds(web, start.limit(0), folder=str(tmp_path / "none")).collect() == []
