import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from corpuslab.llm import op13_url_filter as op13

SF = "/root/testdata/sf0.001"
URLS = [
    (1, "https://www.example.com/en/1"),
    (2, "HTTP://WWW.Example.COM/en/1#top"),
    (3, "https://blog.example.com/en/"),
    (4, "https://example.com/en"),
    (5, "https://notexample.com/en/x"),
    (6, "https://a.net/es/1?x=/fr/"),
    (7, "https://a.net/fr"),
    (8, "https://a.org/x.com/y"),
    (9, "https://a.org?x.com/"),
    (10, "https://com/"),
    (11, "https://a.com"),
    (12, None),
    (13, ""),
    (14, "a.com/en/"),
    (15, "://"),
    (16, "http:///en/x"),
    (17, "x?u=http://b.com/"),
    (18, "http://a.org/photo.JPG"),
    (19, "http://a.org/photo.jpg?size=1"),
    (20, "http://a.org/a?q=1&utm_source=x"),
    (21, "http://a.org/a#utm_source=x"),
    (22, "http://user@a.net:80/es/"),
    (23, "http://a.net:80/es/"),
    (24, "http://a.org/" + "x/" * 40_000 + "cart/1"),
    (24, "http://a.org/" + "x/" * 40_000 + "cart/1"),
    (None, "http://ÄA.org/é/login"),
    (25, "http://a.org/new\nline.zip"),
]


def expected(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    written = re.match(r"[^/?#]*", rest)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in written)
    path = re.match(r"[^?#]*", rest[len(written) :])[0]
    fits = [
        (len(rule), rule, action)
        for action, rule in op13.DOMAIN_RULES
        if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0]))
        and path.startswith("/" + rule.split("/", 1)[1])
    ]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    return df.selectExpr("*", "'x' AS host", "'y' AS blocked_by", "'z' AS rule").repartition(2)


def test_odd_urls(spark):
    got = op13.judged(pages(spark, URLS)).collect()
    assert len(got) == len(URLS)
    by_id = {r.page_id: r for r in got}
    for page_id, url in URLS:
        host, path, rule, action = expected(url)
        row = by_id[page_id]
        assert (row.host, row.path, row.rule) == (host, path, rule), url
        if rule:
            assert row.verdict == action and row.blocked_by is None
        assert row.rule is not None or (row.verdict == "block") == (row.blocked_by is not None)
    globs = {i: by_id[i].blocked_by for i in (12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 24, None, 25)}
    assert globs == {
        12: ".", 13: ".", 14: ".", 15: ".", 16: ".[/?]**", 17: None, 18: "**/*.jpg", 19: "**/*.jpg?**",
        20: "**[?&]utm_[a-z]*", 21: None, 24: "**/cart/**", None: "**/login", 25: "**/*.zip",
    }
    assert op13.judged(pages(spark, [])).count() == 0


def test_query_is_its_sql(spark):
    base = duckdb.connect()
    base.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    base.executemany("INSERT INTO pages VALUES (?, ?)", URLS)
    found = base.execute(op13.OP13_SQL)
    names = [d[0] for d in found.description]
    got = op13.judged(pages(spark, URLS)).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, found.fetchall()))
    base.execute(f"CREATE OR REPLACE VIEW given AS SELECT * FROM '{SF}/pages.parquet'")
    query = op13.op13_url_filter(spark, SF)
    assert {"page_id", "host", "path", "rule", "verdict"} <= set(query.columns)
    assert query.count() == base.execute("SELECT count(*) FROM given").fetchone()[0]


PIECES = st.sampled_from(["a", "b", ".", "/", "?", "*", "**", "[ab]", "[^a]", "[a-c]", "Z", "é"])


def plain(glob, fold):
    out, at = b"(?s)", 0
    raw = glob.encode()
    for kind, fits in op13.parts_of(glob):
        members = b"[" + b"".join(re.escape(bytes([b])) for b in sorted(op13.folded(fits) if fold and kind == "one" else fits)) + b"]"
        out += members if kind == "one" else members + b"*"
    assert at <= len(raw)
    return re.compile(out)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.tuples(st.lists(PIECES, max_size=40).map("".join), st.booleans()), min_size=1, max_size=12),
    st.lists(st.text("abcz./?é", max_size=30), min_size=1, max_size=20),
)
def test_automaton_against_expressions(globs, strings):
    machine = op13.Automaton([op13.Glob(g, fold) for g, fold in globs])
    raw = [s.encode() for s in strings]
    ends = np.cumsum([0, *map(len, raw)])
    flat = np.frombuffer(b"".join(raw) + b"\0", np.uint8)
    got = machine.fits(flat, ends[:-1], np.diff(ends))
    wanted = [[bool(plain(g, fold).fullmatch(s)) for g, fold in globs] for s in raw]
    assert got.tolist() == wanted


def test_many_rules_and_ties(spark):
    """Thousands of rules span many words of states; equal lengths: the longer host."""
    rules = [("block", f"site{i}.example/{'p' * (i % 50)}") for i in range(3_000)]
    rules += [("allow", "b.com/"), ("block", "com/ab"), ("block", "b.com/"), ("allow", "[x].org/*")]
    urls = [(i, f"http://m.site{i}.example/{'p' * 49}") for i in range(0, 3_000, 7)]
    urls += [(-1, "http://b.com/ab"), (-2, "http://[x].org/*y"), (-3, "http://x.org/y")]
    got = {r.page_id: (r.rule, r.verdict) for r in op13.judged(pages(spark, urls), rules, ()).collect()}
    assert got[-1] == ("b.com/", "allow") and got[-2] == ("[x].org/*", "allow") and got[-3] == (None, "allow")
    assert all(got[i] == (rules[i][1], "block") for i, _ in urls if i >= 0)
    with pytest.raises(ValueError):
        op13.domain_glob("com")
    with pytest.raises(ValueError):
        op13.Automaton([op13.Glob("a[b")])
