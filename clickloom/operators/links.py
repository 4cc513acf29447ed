"""Link tables from raw pages: extraction, resolution against the page, the frontier, and crawls in rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.skew import hot_parts, skew_join
from clickloom.workspace import materialize, work_path

# The attributes that hold links, and the starts of links that lead nowhere.
LINK_PATTERN = r"""(?:src|href)=(?:"[^"]+"|'[^']+')"""
DROPPED_STARTS = ("#", "javascript:", "mailto:")


def extract_links(pages: DataFrame) -> DataFrame:
    """(page_id, url, link): each distinct ``src`` or ``href`` value of each page."""
    quoted = F.regexp_extract_all("html", F.lit(LINK_PATTERN), F.lit(0))
    value = F.transform(quoted, lambda m: F.regexp_replace(m, "^[a-z]+=.|.$", ""))

    def leads_somewhere(link: Column) -> Column:
        dropped = reduce(lambda a, b: a | b, (link.startswith(s) for s in DROPPED_STARTS))
        return (link != "") & ~dropped

    links = F.array_distinct(F.filter(value, leads_somewhere))
    return pages.select("page_id", "url", F.explode(links).alias("link"))


def host_base(url: Column) -> Column:
    """``scheme://host[:port]`` of a URL; user info and port 80 are left out."""
    scheme = F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    authority = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":80$", "")
    return F.concat(scheme, F.lit("://"), host)


def resolve_link(page_url: Column, link: Column) -> Column:
    """Full URL of a link found on a page.

    A link beside a page without a path is below the page's host. The scheme of a full link
    may be in upper case.
    """
    scheme = F.regexp_extract(page_url, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    folder = F.when(
        page_url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://[^/]*$"), host_base(page_url)
    ).otherwise(F.regexp_replace(page_url, "/[^/]*$", ""))
    return (
        F.when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(host_base(page_url), link))
        .when(link.rlike("^(?i)https?:"), link)
        .otherwise(F.concat(folder, F.lit("/"), link))
    )


def resolve_links(links: DataFrame) -> DataFrame:
    """(page_id, link, target) with the full URL of each link."""
    target = resolve_link(F.col("url"), F.col("link"))
    return links.select("page_id", "link", target.alias("target"))


def crawl_frontier(links: DataFrame, visited: DataFrame, contains: str = "") -> DataFrame:
    """Distinct targets containing a text and not visited yet.

    Targets are made distinct first: that combines on the map side, and afterwards no URL is
    hot, however many pages link to it.
    """
    wanted = links.select(F.col("target").alias("url")).where(F.col("url").contains(contains))
    return wanted.distinct().join(visited.select("url").distinct(), "url", "left_anti")


def crawl_rounds(
    links: DataFrame, seeds: DataFrame, contains: str = "", most_rounds: int | None = None,
    folder: str | None = None, **detect,
) -> DataFrame:
    """Breadth-first crawl of a web given by the links of its pages: (url, depth) of every URL that can
    be reached from the seeds, with the fewest links to follow.

    ``links`` are (``url``, ``target``), the full URL of a page and of one of its links; only targets
    that contain a text are followed. A URL without a page is reached but leads nowhere. The crawl
    ends when a round finds nothing new, or after ``most_rounds``.

    The links are written once, each distinct pair in one place, and every round is a table of its
    own under ``folder`` (by default in the shared folder): what was visited is never held by the
    driver, and a round follows only the links of the pages found by the one before. A page of
    very many links is cut in chunks, and a target that all pages link to is made distinct in each
    task before it is looked up among the visited ones.
    """
    spark = links.sparkSession
    folder = folder or work_path(spark, "crawl")
    followed = links.where(F.col("target").contains(contains)).select("url", "target")
    edges = materialize(followed.where(F.col("url") != F.col("target")).distinct(), "edges", f"{folder}/edges")
    hot = hot_parts(edges, "url", **detect)
    found = materialize(seeds.select("url").where(F.col("url").isNotNull()).distinct(), "found", f"{folder}/found/depth=0")
    depth = 0
    while (most_rounds is None or depth < most_rounds) and not found.isEmpty():
        depth += 1
        visited = spark.read.schema("url string").parquet(*(f"{folder}/found/depth={d}" for d in range(depth)))
        reached = skew_join(edges, found, "url", "left_semi", hot).select(F.col("target").alias("url")).distinct()
        found = materialize(reached.join(visited, "url", "left_anti"), "found", f"{folder}/found/depth={depth}")
    return spark.read.schema("url string, depth int").parquet(f"{folder}/found")
