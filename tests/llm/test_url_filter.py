import json

import pytest
import xxhash

from tidemark.llm import url_filter
from tidemark.llm.queries import URL_RULES


@pytest.fixture(scope="module")
def weights(spark):
    return url_filter.train(url_filter.labelled_table(spark))


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


URLS = [
    None, "", "no scheme", "http://", "http://Example.NET", "http://example.net/en/x", "http://a.example.net/en", "http://a.example.net/en/?q#f",
    "https://www.org/fr/1", "https://x.ORG/fr", "https://notorg/fr/", "https://example.com/de/1?x=/", "https://m.example.com/de", "https://example.com?x=/de/",
    "https://anexample.com/de/1", "ftp://b.net/", "ftp://b.net", "ftp://b.net:80/", "a://b://c.net/", "x\ny://d.net/\np?q", "http://ÉCOLE.net/fr/É",
    "http://" + "long" * 5000 + ".com/" + "p" * 20_000, "http://www.casino-bets.test/en/1", "http://quiet.test/en/1",
]


def test_hosts_paths_and_rules(spark, weights):
    frame = spark.createDataFrame([(i, u, "h", "g") for i, u in enumerate(URLS)], "page_id long, url string, host string, grams string")
    rows = {r.page_id: r for r in url_filter.judge(frame, URL_RULES, weights).collect()}
    for i, url in enumerate(URLS):
        host, path = split(url)
        assert (rows[i].host, rows[i].path) == (host, path)
        fitting = [(len(h + p), a, h + p) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if fitting:
            assert (rows[i].verdict, rows[i].rule) == max(fitting)[1:]
        else:
            assert rows[i].rule is None and rows[i].verdict == ("block" if rows[i].score >= 0.5 else "allow")
    assert rows[len(URLS) - 2].verdict == "block" and rows[len(URLS) - 1].verdict == "allow"


def test_features_are_hashed_character_ngrams(spark):
    row = url_filter.features(spark.createDataFrame([("ab.cé", "/x")], "host string, path string")).first()

    def chained(*parts):
        seed = 42
        for part in parts:
            seed = xxhash.xxh64_intdigest(part.encode(), seed)
        return (seed - (1 << 64) if seed >> 63 else seed) % url_filter.BUCKETS

    expected = []
    for kind, text in (("host", "^ab.cé$"), ("path", "^/x$")):
        expected += [chained(kind, *text[i:i + n]) for n in url_filter.SIZES for i in range(len(text) - n + 1)]
    assert row.grams == expected


def test_training_separates_the_labelled_table(spark, weights):
    frame = spark.createDataFrame([(u, y) for u, y in url_filter.LABELLED], "page_id string, label int").withColumnRenamed("page_id", "url")
    rows = url_filter.judge(frame, [], weights, keep=("url", "label")).collect()
    assert sum((r.verdict == "block") == (r.label == 1) for r in rows) >= 0.97 * len(rows)
    assert url_filter.train(frame.limit(0)) == [0.0] * (url_filter.BUCKETS + 1)


def test_no_rows_and_no_python(spark, weights):
    frame = spark.createDataFrame([], "page_id long, url string")
    judged = url_filter.judge(frame, URL_RULES, weights)
    assert judged.collect() == []
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert json.dumps(weights)


def test_a_bounded_sample_does_not_depend_on_row_order(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_LABELLED", 30)
    rows = url_filter.labelled_table(spark).collect()
    ordered, turned = (spark.createDataFrame(part, "url string, label int").coalesce(1) for part in (rows, rows[::-1]))
    assert url_filter.train(ordered, epochs=2) == url_filter.train(turned.repartition(5), epochs=2)


def test_kept_columns_with_names_of_the_result(spark):
    urls = spark.createDataFrame([(1, "http://a.net/x", "h", "g", 3.5, "dot"), (2, None, None, None, None, None)],
                                 "page_id int, url string, Host string, grams string, score double, `a.b` string")
    weights = [0.0] * (url_filter.BUCKETS + 1)
    found = url_filter.judge(urls, [("block", "net", "/")], weights, keep=["page_id", "Host", "grams", "score", "a.b"])
    assert found.columns == ["page_id", "kept_Host", "kept_grams", "kept_score", "a.b", "host", "path", "rule", "verdict", "score"]
    assert [tuple(r) for r in found.orderBy("page_id").collect()] == [
        (1, "h", "g", 3.5, "dot", "a.net", "/x", "net/", "block", 0.5), (2, None, None, None, None, "", "", None, "block", 0.5)]
