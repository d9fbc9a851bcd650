import time

import duckdb

from seisloom.llm import url_filter

SF = "/root/testdata/sf0.001"


def test_hosts_paths_and_rules(spark):
    urls = [
        ("https://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/"),
        ("http://example.net/fr/1", "example.net", "/fr/1", "net/"),
        ("http://badexample.net/en/", "badexample.net", "/en/", "net/"),
        ("http://x.org/fr/2", "x.org", "/fr/2", "org/fr/"),
        ("http://x.org/fr", "x.org", "/fr", None),
        ("http://example.com?a=/de/", "example.com", "", None),
        ("ftp://example.com/de/x://y", "example.com", "/de/x:", "example.com/de/"),
        ("no scheme", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
        ("http://net", "net", "", None),
        ("http://a\n.net/p\nq", "a\n.net", "/p\nq", "net/"),
    ]
    df = spark.createDataFrame([(i, u, "mine", "mine") for i, (u, *_) in enumerate(urls)], "page_id long, url string, verdict string, suffix string")
    labelled = spark.createDataFrame([("http://a.com/", 0)], "url string, label int")
    out = {r.page_id: r for r in url_filter.judge_urls(df, labelled).collect()}
    for i, (_, host, path, rule) in enumerate(urls):
        assert (out[i].host, out[i].path, out[i].rule) == (host, path if rule != "example.com/de/" else "/de/x://y", rule), urls[i]
        assert out[i].verdict == {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}.get(rule, "allow")
    assert out[0].suffix == "mine"


def test_trees_learn_held_out_urls(spark):
    good = [f"https://news.site{i}.example.org/story/{i}" for i in range(150)]
    bad = [f"http://win-{i}-cash-{i % 7}.example.org/p?id={i}&ref={i}&t=1" for i in range(150)]
    rows = [(u, 0) for u in good] + [(u, 1) for u in bad]
    train = spark.createDataFrame(rows[::2], "url string, label int")
    test = spark.createDataFrame(rows[1::2], "url string, label int")
    out = url_filter.judge_urls(test, train, rules={}).collect()
    assert sum((r.verdict == "block") == (r.label == 1) for r in out) >= 0.95 * len(out)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(df).count() == 0


def test_fixed_rules_decide(spark):
    """Verdicts are written out: the rules are not asked for what they should say."""
    want = {
        "http://example.net/fr/1": "block", "http://other.net/": "block", "https://a.example.net/en/1": "allow", "http://example.com/de/1": "block",
        "http://x.org/fr/2": "allow", "http://badexample.net/en/": "block",
    }
    df = spark.createDataFrame([(u,) for u in want], "url string")
    for label in (0, 1):  # whatever the trees would say
        labelled = spark.createDataFrame([("http://a.com/", label)], "url string, label int")
        assert {r.url: r.verdict for r in url_filter.judge_urls(df, labelled).collect()} == want


def test_suffix_rates_cover_all_labelled_urls(spark):
    """400 sites, 20 URLs drawn: every site has its rate, over all of its URLs."""
    rows = [(f"http://h{j}.s{i}.t{i % 2}/p{j}", int(i % 4 == 0)) for i in range(400) for j in range(2)]
    model = url_filter.train(spark.createDataFrame(rows, "url string, label int"), sample=20)
    base, prior = 0.25, url_filter.PRIOR
    assert {r.site: round(r.site_rate, 9) for r in model.sites.collect()} == {
        f"s{i}.t{i % 2}": round((2 * (i % 4 == 0) + prior * base) / (2 + prior), 9) for i in range(400)}
    assert {r.suffix: round(r.suffix_rate, 9) for r in model.suffixes.collect()} == {
        "t0": round((200 + prior * base) / (400 + prior), 9), "t1": round(prior * base / (400 + prior), 9)}


def test_rules_as_sql_has_them(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = {r[0]: r[1:] for r in duckdb.sql(url_filter.RULES_SQL).fetchall()}
    out = url_filter.op2_url_filter(spark, SF)
    assert out.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    rows = out.collect()
    assert len(rows) == len(want) and sum(r.rule is not None for r in rows) > 0
    for r in rows:
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)


def test_long_urls_and_repeated_rows(spark):
    urls = ["http://" + "a." * 500_000 + "net/x", "http://" + "é" * 500_000 + ".org/fr/" + "z" * 500_000, "http://a.net/?" + "p&" * 500_000]
    df = spark.createDataFrame([(u,) for u in urls * 2], "url string")
    labelled = spark.createDataFrame([(f"http://{'ab'[i % 2]}{i}.com/{i}", i % 2) for i in range(60)], "url string, label int")
    url_filter.judge_urls(df.limit(0), labelled).count()
    began = time.time()
    out = url_filter.judge_urls(df, labelled).groupBy("rule", "verdict").count().collect()
    assert sorted(tuple(r) for r in out) == [("net/", "block", 4), ("org/fr/", "allow", 2)]
    assert time.time() - began < 60


def test_entropy(spark):
    df = spark.createDataFrame([("aabb",), ("aaaa",), ("abcd",), ("",), ("x.y",)], "host string").selectExpr("host", "'' AS url", "'' AS path")
    got = {r.host: r.e for r in url_filter.lexical_features(df, "url", "host", "path").selectExpr("host", "lexical.entropy AS e").collect()}
    assert {k: round(v, 6) for k, v in got.items()} == {"aabb": 1.0, "aaaa": 0.0, "abcd": 2.0, "": 0.0, "x.y": 1.584963}


def test_own_label_is_not_among_the_statistics(spark):
    """Each host is a site of its own with an arbitrary label: nothing can be learnt, and held-out hosts say so."""
    rows = [(f"http://a.s{i}.com/p", int(i * 2654435761 % 2**32 > 2**31)) for i in range(600)]
    assert url_filter.held_out_auc(spark.createDataFrame(rows, "url string, label int")) < 0.65
