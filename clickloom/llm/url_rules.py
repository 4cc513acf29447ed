"""URL filter rules, indexed by the rarest literal token of each.

A rule is a text. ``||host/path`` fits the host and all its subdomains where the path starts with
the rule's; other patterns fit anywhere in the URL after its scheme. In a pattern ``*`` stands for
any characters and ``^`` for a place that is no letter or digit (or an end of the URL); at a
pattern's start ``||`` stands for the start of a label of the host and ``|`` for the start of the
host, at its end ``|`` stands for the end. Every rule becomes one regular expression.

A token is a run of ASCII letters and digits, in lower case. A run of a pattern is a token of every
URL that the pattern fits if what is next to it on both sides is no letter, digit or ``*``. A rule
is filed under the one of these tokens that the fewest URLs of the corpus have; a rule without any
under the empty token, which every URL has. The tokens of a URL fetch its candidates, and only
their regular expressions run. A rule is thus never missed, whatever the counts are.

Up to a stated size the index goes to every task. A larger one is joined by token, hot tokens cut
in chunks, so neither the number of rules nor a token in all URLs limits it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.skew import skew_join

# An index of so many rules, of so many characters together, is sent to every task.
SENT_RULES = 100_000
SENT_CHARACTERS = 20_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)
_TOKEN = re.compile("[0-9A-Za-z]+")
_LABEL = r"^(?:[^/?#]*\.)?"
RULE = "rule string, verdict string, hosts boolean, rank array<bigint>, regex string, tokens array<string>"


@dataclass(frozen=True)
class Rule:
    """``hosts`` marks a host-and-path rule (``text`` is then ``host/path``, its path read exactly);
    other texts are patterns, read without regard to case."""

    text: str
    verdict: str
    hosts: bool = False


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case. Path:
    then up to ``?``, ``#`` or the end. Both empty without ``://`` and for NULL."""
    host = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _subject(url: Column) -> Column:
    """What rules are matched with: the host in lower case and all that follows it."""
    rest = F.regexp_extract(url, r"://[^/?#]*([\s\S]*)", 1)
    return F.concat(host_and_path(url)[0], F.coalesce(rest, F.lit("")))


def _pieces(rule: Rule) -> tuple[str, str, str]:
    """Start anchor, body and end anchor of a rule."""
    text = rule.text
    if rule.hosts:
        host, slash, path = text.partition("/")
        if re.search(r"[?#]", text):
            raise ValueError(f"a host rule has no ? or #: {text}")
        return "||", host.translate(_TO_LOWER) + slash + path, ""
    start = "||" if text.startswith("||") else "|" if text.startswith("|") else ""
    body = text[len(start) :]
    return (start, body[:-1], "|") if body.endswith("|") else (start, body, "")


def regex_of(rule: Rule) -> str:
    """The regular expression of a rule, the same for Java and (with :func:`compiled`) Python."""
    start, body, end = _pieces(rule)
    special = {} if rule.hosts else {"*": r"[\s\S]*", "^": r"(?:^|(?![\s\S])|[^0-9A-Za-z])"}
    out = {"||": _LABEL, "|": "^", "": ""}[start]
    out += "".join(special.get(c, c if _TOKEN.fullmatch(c) or c > "\x7f" else "\\x%02x" % ord(c)) for c in body)
    if rule.hosts and "/" not in body:
        out += r"(?=/|(?![\s\S]))"
    return ("" if rule.hosts else "(?i)") + out + (r"(?![\s\S])" if end else "")


def compiled(regex: str) -> re.Pattern:
    """In Python; as in Java only ASCII letters are equal in both cases."""
    return re.compile(regex, re.ASCII)


def tokens_of(rule: Rule) -> list[str]:
    """The tokens that every URL has which the rule fits."""
    start, body, end = _pieces(rule)

    def closed(i: int) -> bool:
        if i < 0:
            return bool(start)
        if i == len(body):
            return bool(end) or (rule.hosts and "/" not in body)
        return rule.hosts or body[i] != "*"

    runs = [r for r in _TOKEN.finditer(body) if closed(r.start() - 1) and closed(r.end())]
    return sorted({r.group().translate(_TO_LOWER) for r in runs})


def rank_of(rule: Rule) -> list[int]:
    """Which of the fitting rules decides: the smallest. Host rules first, the longest of them;
    then patterns, those that allow before those that block, and the longest."""
    allows = 0 if rule.verdict == "allow" else 1
    if rule.hosts:
        return [0, -len(rule.text), -len(rule.text.partition("/")[0]), allows]
    return [1, allows, -len(rule.text), 0]


def rule_frame(like: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rules as a frame for :func:`judge`."""
    return like.sparkSession.createDataFrame(
        [(r.text, r.verdict, r.hosts) for r in rules], "rule string, verdict string, hosts boolean"
    )


def compile_rules(rules: DataFrame) -> DataFrame:
    """Regular expression, rank and tokens of the rules (``rule, verdict, hosts``); repeated rules once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [Rule(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("rule", "verdict", "hosts")))]
            yield pa.record_batch(
                [batch.column("rule"), batch.column("verdict"), batch.column("hosts"),
                 pa.array([rank_of(r) for r in rows], pa.list_(pa.int64())),
                 pa.array([regex_of(r) for r in rows], pa.string()),
                 pa.array([tokens_of(r) for r in rows], pa.list_(pa.string()))],
                ["rule", "verdict", "hosts", "rank", "regex", "tokens"],
            )

    known = rules.where(F.col("rule").isNotNull()).select(
        "rule", "verdict", F.coalesce("hosts", F.lit(False)).alias("hosts")
    )
    return known.distinct().mapInArrow(run, RULE)


def _url_tokens(subject: Column) -> Column:
    """The different tokens of a URL, and the empty one."""
    found = F.regexp_extract_all(F.translate(subject, _UPPER, _LOWER), F.lit("([0-9a-z]+)"), F.lit(1))
    return F.array_union(found, F.array(F.lit("")))


def _text_tokens(subject: str) -> set[str]:
    return {*_TOKEN.findall(subject.translate(_TO_LOWER)), ""}


def token_counts(urls: DataFrame, rules: DataFrame, sent: bool) -> DataFrame:
    """``token, n``: in how many rows of ``subject`` each token of the rules is."""
    if sent:
        wanted = frozenset(t for r in rules.select("tokens").collect() for t in r["tokens"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n: Counter[str] = Counter()
            for batch in batches:
                for subject in batch.column("subject").to_pylist():
                    n.update(_text_tokens(subject) & wanted)
            yield pa.record_batch([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["token", "n"])

        return urls.select("subject").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    # Counted before the join: a token in all URLs is then a row per task.
    counted = urls.select(F.explode(_url_tokens(F.col("subject"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return counted.join(wanted, "token", "left_semi")


def rule_index(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """Compiled rules with the ``token`` each is filed under."""
    each = rules.withColumn("token", F.explode_outer("tokens")).join(counts, "token", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token")))
    # A host rule and a pattern may share a text, so the expression is part of the key.
    return each.groupBy("rule", "verdict", "hosts", "regex").agg(
        F.first("rank").alias("rank"), rarest.alias("_rarest")
    ).select("_rarest.token", "rank", "regex", "rule", "verdict", "hosts")


class Index:
    """The index in a task."""

    def __init__(self, rows: Sequence[tuple]) -> None:
        self.by_token: dict[str, list[tuple]] = {}
        for token, rank, regex, rule, verdict, hosts in sorted(rows, key=lambda r: (r[1], r[3], r[4])):
            self.by_token.setdefault(token, []).append((rank, rule, verdict, hosts, compiled(regex)))

    def candidates(self, subject: str) -> list[tuple]:
        found = [c for t in _text_tokens(subject) if t in self.by_token for c in self.by_token[t]]
        return sorted(found, key=lambda c: c[:3])

    def decide(self, subject: str) -> tuple | None:
        """The first rule, by rank, among the candidates whose expression fits."""
        return next((c for c in self.candidates(subject) if c[4].search(subject)), None)


def _decided_in_tasks(pages: DataFrame, index: DataFrame) -> DataFrame:
    rows = [(r["token"], list(r["rank"]), r["regex"], r["rule"], r["verdict"], r["hosts"]) for r in index.collect()]

    @F.pandas_udf("rule string, verdict string, hosts boolean")
    def decide(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        found = Index(rows)
        for part in parts:
            made = [d[1:4] if (d := found.decide(s)) else (None, None, None) for s in part]
            yield pd.DataFrame(made, columns=["rule", "verdict", "hosts"], dtype=object)

    return pages.withColumn("_decided", decide("_subject"))


def _decided_by_join(pages: DataFrame, index: DataFrame, target_rows: int) -> DataFrame:
    urls = pages.select("_subject").distinct()
    tokens = urls.withColumn("token", F.explode(_url_tokens(F.col("_subject"))))
    candidates = skew_join(tokens, index, "token", target_rows=target_rows)
    hits = (
        candidates.where(F.expr("_subject rlike regex"))
        .groupBy("_subject")
        .agg(F.min(F.struct("rank", "rule", "verdict", "hosts")).alias("_best"))
        .select("_subject", F.struct("_best.rule", "_best.verdict", "_best.hosts").alias("_decided"))
    )
    return skew_join(pages, hits, "_subject", "left", target_rows=target_rows)


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url",
    sent_rules: int = SENT_RULES, sent_characters: int = SENT_CHARACTERS, target_rows: int = 4_000_000,
) -> DataFrame:
    """All columns of ``pages`` with ``host, path, rule, pattern, verdict`` after them.

    ``rule`` is the host rule that decides, or NULL; ``pattern`` is the pattern that decides where no
    host rule fits, or NULL; where neither fits the verdict is ``default``. Of equally long host
    rules that of the longer host wins, then one that allows. Every row is judged by itself: a NULL
    or empty URL has an empty host and path and can only fit patterns that fit the empty text.
    Columns of ``pages`` with one of the five names are replaced; the URL's own column may not have one.
    """
    names = ("host", "path", "rule", "pattern", "verdict")
    host, path = host_and_path(F.col(f"`{url}`"))
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in names]
    packed = pages.select(F.struct(*kept).alias("_row"), host.alias("_host"), path.alias("_path"),
                          _subject(F.col(f"`{url}`")).alias("_subject"))
    size = rules.agg(F.count("*").alias("n"), F.sum(F.length("rule")).alias("c")).first()
    sent = size["n"] <= sent_rules and (size["c"] or 0) <= sent_characters
    ready = compile_rules(rules)
    urls = pages.select(_subject(F.col(f"`{url}`")).alias("subject"))
    index = rule_index(ready, token_counts(urls, ready, sent))
    decided = _decided_in_tasks(packed, index) if sent else _decided_by_join(packed, index, target_rows)
    return decided.select(
        "_row.*", F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.when(F.col("_decided.hosts"), F.col("_decided.rule")).alias("rule"),
        F.when(~F.col("_decided.hosts"), F.col("_decided.rule")).alias("pattern"),
        F.coalesce("_decided.verdict", F.lit(default)).alias("verdict"),
    )


def keep_allowed(pages: DataFrame, rules: DataFrame, **options) -> DataFrame:
    """Pages whose URL is allowed, with their own columns."""
    own = [f"_row.`{c}`" for c in pages.columns]
    judged = judge(pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("_row"),
                                F.col(f"`{options.pop('url', 'url')}`").alias("url")), rules, **options)
    return judged.where(F.col("verdict") == "allow").select(*own)
