import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cubestar.llm import url_rules
from cubestar.llm.queries import SITE_RULES

URLS = [
    "http://WWW.Example.com/en/1",
    "http://example.com/en/1",
    "http://a.www.example.com/en/",
    "http://notexample.com/en/1",
    "http://x.example.com/EN/1",
    "http://x.net/es/1?a=b",
    "http://x.net/es",
    "http://x.net",
    "http://x.net?/es/",
    "ftp://x.net#/fr/",
    "http://x.net/fr/#top",
    "no scheme/x.net/fr/",
    "",
    None,
    "http://spam-farm.example.org/en/1",
    "http://myspam-farm.example.org/",
    "http://x.org/?next=http://casino-win.net/es/",
    "://cheap-pills/",
    "http://" + "a" * 50_000 + ".com/" + "b" * 50_000,
    "http://x.com.evil.org/\nhttp://free-bets.x/",
    "http://kKspam-farm.org/",
    "https://x.org/dir/Setup.EXE?x=1",
    "https://x.org/setup.exec",
    "http://cheap-pills-24-7.shop.net/",
    "http://a.cheap-pillsx.net/",
    "http://x.org/calendar/2024/1/31",
    "http://x.org/list?page=20000&x=1",
    "http://x.org/list?page=200",
    "http://casino-club77.x.org/",
    "http://x.org/a?PHPSESSID=0123456789abcdef0",
    "http://x.org/-bets-for-free-/",
]


def expected(url):
    after = (url or "").partition("://")[2]
    host = re.match("[^/?#]*", after)[0]
    path = re.match("[^?#]*", after[len(host) :])[0]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host = host.translate(lower)
    fits = [(len(h + p), h + p, a) for a, h, p in SITE_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    junk = [n for n, p in url_rules.DEFAULT_PATTERNS if re.search(p, (url or "").translate(lower))]
    rule, action = max(fits)[1:] if fits else (None, "block" if junk else "allow")
    return host, path, rule, action, min(junk) if junk else None


def test_edges(spark):
    rows = [(i, u, "x", 1, "y") for i, u in enumerate([*URLS, *URLS[:3]])] + [(None, URLS[0], None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, row int, _url string")
    got = url_rules.judge_urls(pages, SITE_RULES)
    assert got.columns == ["page_id", "url", "row", "_url", "host", "path", "rule", "verdict", "pattern"]
    assert got.count() == len(rows)
    for r in got.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"], r["pattern"]) == expected(r["url"]), r["url"]


def test_empty_table_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://spam-farm.org/")], "page_id long, url string")
    assert url_rules.judge_urls(pages.limit(0), SITE_RULES).count() == 0
    assert url_rules.judge_urls(pages, (), ()).first()["verdict"] == "allow"


def test_paths_without_a_closing_slash(spark):
    pages = spark.createDataFrame([("http://a.org/english",), ("http://a.org/e",)], "url string")
    got = url_rules.judge_urls(pages, [("block", "a.org", "/en")], ())
    assert [r["verdict"] for r in got.orderBy(F.length("url").desc()).collect()] == ["block", "allow"]


def test_required_tokens():
    found = {n: url_rules.required_tokens(p) for n, p in url_rules.DEFAULT_PATTERNS}
    assert found == {
        "ad-tracker": ("ads",), "adult-host": ("adult",), "betting": ("bets", "free"), "calendar-trap": ("calendar",),
        "casino-host": ("casino",), "comment-reply": ("replytocom",), "deep-page": ("page",), "link-farm": ("farm",),
        "login-page": ("login", "php", "wp"), "pill-shop": ("pills",), "program-file": (), "session-id": ("phpsessid",),
    }
    for pattern, tokens in (
        ("abc", ()), ("^abc$", ("abc",)), ("/abc/", ("abc",)), ("/abc[0-9]*/", ()), ("/abc(?:/|x)", ()),
        ("/(?:x-)?abc/", ("abc",)), ("/x?abc/", ()), ("/(?:ab|cd)/", ()), ("/(?:ab-cd|cd)/", ("cd",)), ("/ab(?:-c)*[.]d[?]", ("ab", "d")),
        ("[^a-z0-9]ab[^/]", ()), ("[^a-z0-9]ab[^a-z0-9]", ("ab",)), ("/(?:/ab/){1}", ("ab",)), ("/.*ab/", ()),
    ):
        assert url_rules.required_tokens(pattern) == tokens, pattern


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_every_match_holds_the_required_tokens(data):
    part = st.sampled_from(["ab", "c", "/", "-", "[.]", "[0-9]*", "(?:x|-y)", "(?:-z)?", "[^a-z0-9]", "(?:ab/|c/)", "q?", "(?:/ab)+"])
    pattern = "".join(data.draw(st.lists(part, min_size=1, max_size=6)))
    tokens = url_rules.required_tokens(pattern)
    text = data.draw(st.text("abcqxyz09/-. ", max_size=3)) + data.draw(st.from_regex(pattern, fullmatch=True))
    text += data.draw(st.text("abcqxyz09/-. ", max_size=3))
    if re.search(pattern, text) and not re.search("[^a-z0-9/. -]", text):
        assert set(tokens) <= set(re.split("[^a-z0-9]+", text)), pattern


def test_rarest_literal(spark):
    rules = [url_rules.site_rule("block", "example.com", "/en/"), url_rules.pattern_rule("p", "block", "[./]spam-farm[.]")]
    urls = spark.createDataFrame([(t,) for t in ["a.example.com", "example.com/en/", "spam-farm.com", "spam.org"]], "_url string")
    index = url_rules.rarest_literals(urls, F.split("_url", "[^a-z0-9]+"), rules)
    assert {r["name"]: r["token"] for r in index.collect()} == {"example.com/en/": "en", "p": "farm"}


def test_thousands_of_rules(spark, monkeypatch):
    """A url's tokens fetch the few rules that can fit; lists and joins agree."""
    rules = tuple(url_rules.pattern_rule(f"r{i:05}", "block", f"[./-]w{i}-(?:a|b)[0-9]*[./]") for i in range(5000))
    urls = [f"http://x.w{i}-a{i % 7}.net/w{i + 1}" for i in range(0, 6000, 40)]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    expected = [f"r{i:05}" if i < 5000 else None for i in range(0, 6000, 40)]
    for listed in (20_000, 0):
        monkeypatch.setattr(url_rules, "MAX_LISTED_TOKENS", listed)
        got = {r["url"]: r["pattern"] for r in url_rules.judge_urls(pages, (), rules).collect()}
        assert [got[u] for u in urls] == expected
    frame = pages.withColumnRenamed("url", "_url")
    tokens = F.array_distinct(F.split("_url", "[^a-z0-9]+"))
    index = url_rules.rarest_literals(frame, tokens, list(rules))
    candidates = frame.select(F.explode(url_rules._fetching(tokens, list(rules))).alias("token")).join(index, "token")
    assert candidates.count() <= 2 * len(urls)


def test_expressions_run_on_candidates_only(spark):
    """The regular expressions stand above the join with the index, and no Python runs."""
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = url_rules.judge_urls(pages, SITE_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" in plan and "Python" not in plan and "Arrow" not in plan
