"""Url rules against a plain search over all of them, and on odd rows."""

import random
import re

import duckdb
import pytest

from starloom.llm import url_filters
from starloom.operators import ranges

SCHEMA = "page_id long, url string, host string, id long, rule string, `key` string"
FIRST_LABELS = ["a", "b", "www", "", "A", "é", "ab"]


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = [
        (len(h) + len(p), len(h), h + p, v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fitting, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def rows(frame):
    return sorted(map(tuple, frame.select("page_id", "host", "path", "rule", "verdict").collect()), key=str)


def expected(urls, rules):
    return sorted([(i, *plain(url, rules)) for i, url in urls], key=str)


@pytest.mark.parametrize("partitions", [1, 7])
def test_same_as_a_search_over_all_rules(spark, partitions, monkeypatch):
    rng = random.Random(partitions)
    tops = ["net", "org", "com", "b.net", "a.b.net", "ab"]
    paths = ["", "/", "/a", "/a/", "/a/b/", "/a/bc", "/\U0010ffff", "/a\x00"]

    def host():
        return ".".join([rng.choice(FIRST_LABELS) for _ in range(rng.randrange(3))] + [rng.choice(tops)])

    rules = {(host().lower().lstrip("."), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(150)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = []
    for i in range(3_000):
        # One url holds a third of all rows.
        url = "http://www.b.net/a/b/c" if i % 3 == 0 else f"x://{host()}{rng.choice(paths)}{rng.choice(['', 'b', '/c?x', '#/a'])}"
        urls.append((i, url))
    monkeypatch.setattr(ranges.sampled, "__defaults__", (8,))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        pages = spark.createDataFrame(urls, "page_id long, url string").repartition(3)
        assert rows(url_filters.judged(pages, url_filters.rule_table(spark, tuple(rules)))) == expected(urls, rules)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_many_rules_in_small_batches(spark):
    """The stack goes on over batches, and every range knows the rules opened before it."""
    rules = [("net", "/", "block"), *[(f"h{i}.net", f"/{j}/", "allow") for i in range(60) for j in range(5)]]
    urls = [(i, f"http://w.h{i % 70}.net/{i % 7}/x") for i in range(2_000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        pages = spark.createDataFrame(urls, "page_id long, url string")
        assert rows(url_filters.judged(pages, url_filters.rule_table(spark, tuple(rules)))) == expected(urls, rules)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


ODD = [
    None,
    "",
    "net/",
    "://net/",
    "http://",
    "http:///en/",
    "HTTP://EXAMPLE.NET/en/x",
    "http://example.net",
    "http://example.net?/en/",
    "http://example.net/EN/",
    "http://a.example.net/en/",
    "http://badexample.net/en/",
    "http://example.net:80/en/",
    "http://example.net./en/",
    "http://.net/",
    "http://x.org/fr/y://example.com/de/",
    "http://example.com/de/\n?x",
    "http://ÄÖ.example.com/de/",
    "http://" + "a." * 20_000 + "net/",
    "http://example.com/de/" + "x" * 100_000,
]


def test_odd_urls(spark, tmp_path):
    urls = [*enumerate(ODD), (5, ODD[6]), (5, ODD[6]), (None, ODD[9])]
    rows_in = [(i, url, "own", 7, "own", "own") for i, url in urls] + [(40, "http://b.net/", None, None, None, None)]
    pages = spark.createDataFrame(rows_in, SCHEMA).repartition(2)
    found = url_filters.judged(pages, url_filters.rule_table(spark))
    assert rows(found) == expected([r[:2] for r in rows_in], url_filters.RULES)
    # The SQL agrees on them too.
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        by_sql = db.execute(url_filters.SQL).fetchall()
    assert sorted(map(tuple, by_sql), key=str) == rows(found)


def test_no_pages_and_no_rules(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert rows(url_filters.judged(none, url_filters.rule_table(spark))) == []
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    nothing = spark.createDataFrame([], "host string, path string, verdict string")
    assert rows(url_filters.judged(pages, nothing, default="block")) == [(1, "a.net", "/", None, "block")]


def test_odd_rules(spark):
    rules = spark.createDataFrame(
        [(None, "/", "block"), ("", "/", "block"), ("A.Net", None, "allow"), ("a.net", "", "block"), ("net", "/xy/", "allow")],
        "host string, path string, verdict string",
    )
    pages = spark.createDataFrame([(1, "q://w.a.net"), (2, "q://b.net/xy/"), (3, "q://a.net/xy/")], "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_filters.judged(pages, rules).collect()}
    # Equal rules: block. The longer text wins, though its host is shorter.
    assert found == {1: ("a.net", "block"), 2: ("net/xy/", "allow"), 3: ("net/xy/", "allow")}


def test_one_long_host_makes_no_more_keys_than_rules_have_labels(spark):
    urls = spark.createDataFrame([(1, "a." * 5_000 + "net", "/" + "x" * 5_000)], "id long, host string, path string")
    found = url_filters._points(urls, 3, 4).collect()
    assert [bytes(r["key"]) for r in found] == [b"net//xxx", b"net.a//xxx", b"net.a.a//xxx"]
