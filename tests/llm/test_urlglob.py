import random
import re

import pytest
from pyspark.sql import functions as F

from quirework.llm.urlglob import GlobRule, Rule, ShiftAnd, filter_urls, host_of, path_of


def regex_of(glob):
    out, i = "", 0
    while i < len(glob):
        if glob[i : i + 2] == "**":
            out, i = out + ".*", i + 2
        else:
            out, i = out + {"*": "[^/]*", "?": "."}.get(glob[i], re.escape(glob[i])), i + 1
    return re.compile(out.encode() if isinstance(out, str) else out, re.DOTALL)


def test_automaton_equals_regular_expressions():
    rng = random.Random(8)
    for turn in range(60):
        globs = ["".join(rng.choice(("a", "b", "/", "*", "**", "?", ".")) for _ in range(rng.randrange(0, 9))) for _ in range(rng.choice((1, 5, 40)))]
        urls = ["".join(rng.choice("ab/.c") for _ in range(rng.randrange(0, 14) * rng.choice((1, 1, 9)))).encode() for _ in range(40)]
        got = ShiftAnd(globs).match(urls, room=(1 << 22, 60, 1)[turn % 3])
        for i, u in enumerate(urls):
            for j, g in enumerate(globs):
                assert got[i, j] == bool(regex_of(g).fullmatch(u)), (g, u)


def test_wide_characters_and_many_words():
    m = ShiftAnd([f"*{i:05d}" for i in range(200)] + ["*é?*"])
    hit = m.match(["x00123".encode(), "aéb".encode()])
    assert hit[0].nonzero()[0].tolist() == [123] and hit[1].nonzero()[0].tolist() == [200]


@pytest.mark.parametrize(("url", "host", "path"), [
    ("http://A.Example.ORG/x?q#f", "a.example.org", "/x"), ("http://h", "h", ""), ("http://h?x", "h", ""), ("http://h#x/y", "h", ""),
    (None, "", ""), ("", "", ""), ("no scheme/x", "", ""), ("a://b://c/d", "b:", "//c/d"), ("x\n://h\n/p\n?", "h\n", "/p\n"),
])
def test_host_and_path(spark, url, host, path):
    r = spark.createDataFrame([(url,)], "u string").select(host_of(F.col("u")), path_of(F.col("u"))).first()
    assert tuple(r) == (host, path)


def test_verdicts(spark):
    rules = [Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "com/de/")]
    rows = [(1, "http://example.org/es/1", "example.org/es/", "block"), (2, "http://a.example.org/en/", "org/", "allow"), (3, "http://badexample.org/es/", "org/", "allow"),
            (4, "http://org", None, "allow"), (5, "http://x.com/org/es/", None, "allow"), (6, "http://x.com/de/", "com/de/", "block"), (7, "http://x.net/wp-login.php", None, "block"),
            (8, None, None, "allow"), (8, None, None, "allow"), (9, "http://x.org/wp-login.php", "org/", "allow"), (10, "http://x.net/" + "a" * 5000, None, "allow")]
    pages = spark.createDataFrame([(i, u, "x") for i, u, _, _ in rows], "page_id long, url string, host string")
    got = sorted((r.id, r.rule or "", r.verdict) for r in filter_urls(pages, rules).collect())
    assert got == sorted((i, r or "", v) for i, _, r, v in rows)
    assert filter_urls(pages.where("page_id < 0"), rules).count() == 0
    assert {r.verdict for r in filter_urls(pages, [], [GlobRule("block", "**")]).collect()} == {"block"}


def test_one_very_long_url_takes_no_room_of_others(spark):
    import resource

    long = b"a" * 3_000_000 + b"/wp-login.php"
    m = ShiftAnd(["**/wp-login.php", "*b"])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    hit = m.match([b"xb", long, *[b"c"] * 2000])
    assert hit[0].tolist() == [False, True] and hit[1].tolist() == [True, False] and hit.sum() == 2
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # kB


def test_null_ids_and_default_globs(spark):
    urls = ["http://x.zip", "http://x.zip/", "http://x.net/a.zip", "http://x.net/a.zip?q", "http://x.net/a.zips", "http://x.net/a/feed", "http://x.net/feeds", "http://x.net/a/sitemap-1.xml", "http://x.net/json"]
    pages = spark.createDataFrame([(None, u) for u in urls], "page_id long, url string")
    got = {r.host + r.path: r.verdict for r in filter_urls(pages, []).collect()}
    assert [k for k, v in got.items() if v == "block"] == ["x.net/a.zip", "x.net/a/feed", "x.net/a/sitemap-1.xml"]
