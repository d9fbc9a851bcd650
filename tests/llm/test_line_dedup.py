from collections import Counter, defaultdict

from seisloom.llm import line_dedup


def brute(rows, ratio, least):
    pages, seen = Counter(), defaultdict(Counter)
    for host, text in rows:
        pages[host] += 1
        for line in set(text.split("\n") if text is not None else []):
            seen[host][line] += 1
    out = []
    for host, text in rows:
        if text is not None:
            text = "\n".join(x for x in text.split("\n") if not (seen[host][x] >= least and seen[host][x] > ratio * pages[host]))
        out.append((host, text))
    return out


def test_against_brute_force(spark):
    rows = [("h", f"head\nbody {i}\n\nfoot {i % 3}") for i in range(30)] + [(None, "head\nx"), (None, None), ("h", ""), ("g", "head")]
    for ratio, least in ((0.5, 2), (0.3, 2), (0.9, 2)):
        df = spark.createDataFrame(rows, "source string, text string")
        found = line_dedup.drop_boilerplate(df, ratio=ratio, min_pages=least)
        assert sorted(map(str, [(r.source, r.text) for r in found.collect()])) == sorted(map(str, brute(rows, ratio, least)))


def test_columns_and_cases(docs, empty):
    out = line_dedup.drop_boilerplate(docs, ratio=0.5, min_pages=2)
    assert out.columns == [*docs.columns, "lines_dropped"] and out.count() == docs.count()
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[1].text.endswith("away") and by_id[1].lines_dropped == 1
    assert by_id[3].text is None and by_id[4].text == ""
    assert line_dedup.drop_boilerplate(empty).count() == 0


def test_copies_count_once(spark):
    df = spark.createDataFrame([("h", "same page")] * 8 + [("h", f"page {i}\nfoot") for i in range(8)], "source string, text string")
    out = [r.text for r in line_dedup.drop_boilerplate(df, ratio=0.3, min_pages=2, distinct_pages=True).collect()]
    assert out.count("same page") == 8 and not any("foot" in t for t in out)


def test_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = duckdb.sql(line_dedup.ORACLE)
    out = line_dedup.op1_line_dedup(spark, sf).select(*want.columns)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want.fetchall()))
