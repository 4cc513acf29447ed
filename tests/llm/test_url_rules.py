from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import registry, url_rules
from clickloom.llm.url_rules import Rule

SCHEMA = "page_id long, url string, token string, n int, _row string, host string"
RULES = registry.URL_RULES + [
    Rule("^ads^*banner", "block"), Rule("|shop.", "block"), Rule("^track^", "block"), Rule("@x|", "block"),
    Rule("track/ok", "allow"), Rule("a.b.org", "block", True), Rule("b.org/x", "allow", True),
]
URLS = [
    "http://a.example.org/es/1", "https://EXAMPLE.org/en/12?q=/es/", "http://org/x", "http://x.org", "http://norg/", "http://a.org:80/",
    "http://x.example.com/fr/3", "http://x.example.com/de/3#top", "http://com/fr", "http://m.casino-win.example.net/", "ftp://free-bets.net",
    "http://u@example.org/es/", "http:///org/x", "no scheme org/", "", None, "http://x?a.org/b", "http://h.net/en?u=http://x.org/", "://",
    "http://shop.de/", "http://x.de/shop./ads/9/banner", "http://x.de/ads/ban", "http://x.de/Track", "http://x.de/track/ok", "http://x.de/backtrack",
    "http://a.b.org/x/1", "http://a.b.org/y", "http://c.a.b.org", "http://b.org/x", "http://é.org/es/\n", "http://x.de/é@x", "http://x.net/\n/track\n",
    "http://x.net/" + "a-" * 100_000 + "track", "http://blog.spam-farm.example.net/en/1", "http://notspam-farm.net/",
]


def brute(url, rules=RULES):
    """Host rules by string comparison; patterns by a matcher without regular expressions."""
    host = path = rest = ""
    if url is not None and "://" in url:
        after = url.split("://", 1)[1]
        cut = min((after.find(c) for c in "/?#" if c in after), default=len(after))
        host, rest = re.sub("[A-Z]", lambda m: m.group().lower(), after[:cut]), after[cut:]
        path = re.split("[?#]", rest)[0]
    best = None
    for r in rules:
        if r.hosts:
            h, slash, p = r.text.partition("/")
            if (host == h or host.endswith("." + h)) and (path.startswith(slash + p) if slash else path[:1] in ("", "/")):
                rank = (len(r.text), len(h), r.verdict == "allow")
                best = max(best or (rank, r), (rank, r), key=lambda b: b[0])
    if best:
        return host, path, best[1].text, None, best[1].verdict
    subject = re.sub("[A-Z]", lambda m: m.group().lower(), host + rest)
    found = [r for r in rules if not r.hosts and fits(r.text.lower(), subject, len(host))]
    if found:
        r = min(found, key=lambda r: (r.verdict != "allow", -len(r.text), r.text))
        return host, path, None, r.text, r.verdict
    return host, path, None, None, "allow"


def fits(pattern, subject, host):
    starts = range(len(subject) + 1)
    if pattern.startswith("||"):
        pattern, starts = pattern[2:], [0] + [i + 1 for i in range(host) if subject[i] == "."]
    elif pattern.startswith("|"):
        pattern, starts = pattern[1:], [0]
    ends = pattern.endswith("|")
    places = set(starts)
    for c in pattern[:-1] if ends else pattern:
        if c == "*":
            places = set(range(min(places), len(subject) + 1)) if places else places
        elif c == "^":
            sep = lambda i: not re.fullmatch("[0-9a-z]", subject[i])
            places = {i for i in places if i in (0, len(subject))} | {i + 1 for i in places if i < len(subject) and sep(i)}
        else:
            places = {i + 1 for i in places if subject[i : i + 1] == c}
    return len(subject) in places if ends else bool(places)


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "t", 1, "r", "old") for i, u in enumerate(urls)], SCHEMA)


@pytest.mark.parametrize("sent", [100_000, 0])
def test_equals_brute_force(spark, sent):
    """In tasks and by the join, which treats every token of two URLs as hot."""
    pages = frame(spark, URLS + URLS[:5])
    made = url_rules.judge(pages, url_rules.rule_frame(pages, RULES + RULES[:3]), sent_rules=sent, target_rows=2)
    assert made.columns == ["page_id", "url", "token", "n", "_row", "host", "path", "rule", "pattern", "verdict"]
    got = sorted(made.select("page_id", "host", "path", "rule", "pattern", "verdict").collect())
    for row, url in zip(got, URLS + URLS[:5]):
        assert tuple(row)[1:] == brute(url), url and url[:80]
    assert len(got) == len(URLS) + 5


@given(st.lists(st.tuples(st.sampled_from(["", "|", "||"]), st.text("ab-/.^*", min_size=1, max_size=6), st.sampled_from(["", "|"])),
                min_size=1, max_size=6),
       st.text("abA-/.?#", max_size=12))
@settings(max_examples=400, deadline=None)
def test_candidates_miss_no_rule(patterns, tail):
    rules = [Rule(a + b + c, "block") for a, b, c in patterns if not b.endswith("|")]
    url = "http://" + tail
    host = brute(url, [])[0]
    subject = host + tail[len(host) :]
    index = url_rules.Index([
        ((url_rules.tokens_of(r) or [""])[0], url_rules.rank_of(r), url_rules.regex_of(r), r.text, r.verdict, r.hosts) for r in set(rules)
    ])
    made = index.decide(subject)
    assert (None, *(made[1:3] if made else (None, "allow"))) == brute(url, rules)[2:]


def test_only_rules_of_a_token_run(spark):
    """A rule is filed under its rarest token, so URLs without it never meet the rule."""
    urls = [f"http://www.site{i % 7}.com/page/{i}" for i in range(300)] + ["http://www.rare.com/page/1"]
    pages = frame(spark, urls)
    rules = url_rules.compile_rules(url_rules.rule_frame(pages, [Rule("||www.rare.com/page/", "block"), Rule("e/1", "block")]))
    subjects = pages.select(url_rules._subject(pages.url).alias("subject"))
    for sent in (True, False):
        rows = url_rules.rule_index(rules, url_rules.token_counts(subjects, rules, sent)).collect()
        assert {r["rule"]: r["token"] for r in rows} == {"||www.rare.com/page/": "rare", "e/1": ""}


def test_keep_allowed_and_empty_tables(spark):
    pages = frame(spark, URLS)
    rules = url_rules.rule_frame(pages, RULES)
    kept = url_rules.keep_allowed(pages, rules)
    assert kept.columns == pages.columns
    assert sorted(r["page_id"] for r in kept.collect()) == [i for i, u in enumerate(URLS) if brute(u)[-1] == "allow"]
    assert url_rules.judge(pages.limit(0), rules).collect() == []
    none = url_rules.judge(pages, rules.limit(0)).collect()
    assert len(none) == len(URLS) and {r["verdict"] for r in none} == {"allow"}


def test_many_rules(spark):
    rng = random.Random(3)
    hosts = [f"h{rng.randrange(400)}.d{rng.randrange(30)}.net" for _ in range(300)]
    rules = [Rule(f"{h}/{rng.choice('ab')}", rng.choice(["allow", "block"]), True) for h in hosts]
    rules = list({r.text: r for r in rules}.values())
    urls = [f"http://{rng.choice(['', 'x.'])}{rng.choice(hosts)}/{rng.choice('abc')}{i}" for i in range(400)]
    pages = frame(spark, urls)
    for sent in (1000, 0):
        got = url_rules.judge(pages, url_rules.rule_frame(pages, rules), sent_rules=sent).orderBy("page_id").collect()
        assert [(r["rule"], r["verdict"]) for r in got] == [(b[2], b[4]) for b in (brute(u, rules) for u in urls)]
