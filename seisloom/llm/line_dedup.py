"""Line dedup by site-relative frequency (operator 1, DataFrame functions only).

A line of a host is boilerplate if it is in more than ``ratio`` of the host's
pages and in ``min_pages`` of them at least. Boilerplate lines go, the other
lines keep their order.

Scale: pages leave the scan as arrays of 128-bit line hashes. Lines are counted
by (host, line), combined before the shuffle, so a host with a third of all
pages meets in no task. At most ``mean lines of a page / ratio`` lines of a host
can be boilerplate, however many pages it has; this list joins the pages by
host, and texts are only shuffled if the lists are too large to broadcast
(Spark decides by their measured size, and splits a hot host). A page's lines are
looked up in its host's list by a hash table, not one by one.

Cases: null text stays null and counts as a page without lines; null host is a
host of its own; an empty line is a line like others; repeated rows count as
pages; a text all of whose lines go becomes empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, read, unused

RATIO, MIN_PAGES = 0.03, 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_id(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    distinct_pages: bool = False,
) -> DataFrame:
    """``(host, is_null, lines)``: the ids of each host's boilerplate lines.

    With ``distinct_pages`` equal pages of a host count once, so that copies of
    a page, which document dedup removes, do not turn its lines into boilerplate.
    """
    pages = docs.select(
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.col(host).isNull().alias("is_null"),
        F.array_distinct(F.transform(_lines(F.col(text)), _line_id)).alias("lines"),
        *([_line_id(F.col(text)).alias("page")] if distinct_pages else []),
    )
    if distinct_pages:
        pages = pages.dropDuplicates(["host", "is_null", "page"]).drop("page")
    site = ["host", "is_null"]
    total = pages.groupBy(*site).agg(F.count("*").alias("pages"))
    seen = pages.select(*site, F.explode("lines").alias("line")).groupBy(*site, "line").agg(F.count("*").alias("n"))
    return (
        seen.where(F.col("n") >= min_pages)
        .join(total, site)
        .where(F.col("n") > F.col("pages") * F.lit(ratio))
        .groupBy(*site)
        .agg(F.collect_list("line").alias("lines"))
    )


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", **options) -> DataFrame:
    """``docs`` with boilerplate lines dropped from ``text``; other columns stay.

    Adds ``lines_dropped`` (long); a column of that name is replaced.
    """
    spark = docs.sparkSession
    lists = fresh_path(spark, "boilerplate")
    boilerplate(docs, host, text, **options).write.parquet(lists)  # its size is then known to the planner
    h, z, drop, kept = (unused(docs, x) for x in ("host_", "null_", "drop_", "kept_"))
    found = spark.read.parquet(lists).select(
        F.col("host").alias(h), F.col("is_null").alias(z), F.col("lines").alias(drop)
    )
    rows = docs.withColumns(
        {h: F.coalesce(F.col(host).cast("string"), F.lit("")), z: F.col(host).isNull()}
    ).join(found, [h, z], "left")
    lines = _lines(F.col(text))
    # the page's own hits, by a hash table over one half of the ids; most pages have few or none
    hits = F.array_intersect(F.transform(lines, lambda x: F.xxhash64(x)), F.transform(F.col(drop), lambda x: x["a"]))
    hit = unused(docs, "hit_")
    rows = rows.withColumn(hit, hits).withColumn(
        kept,
        F.when(F.coalesce(F.size(hit), F.lit(0)) <= 0, lines).otherwise(
            F.filter(lines, lambda x: ~(F.array_contains(F.col(hit), F.xxhash64(x)) & F.array_contains(F.col(drop), _line_id(x))))
        ),
    )
    keep_columns = [c for c in docs.columns if c.lower() != "lines_dropped"]
    out = {text: F.when(F.size(lines) == F.size(kept), F.col(text)).otherwise(F.array_join(kept, "\n"))}
    return rows.select(
        *[out.get(c, F.col(f"`{c}`")).alias(c) for c in keep_columns],
        F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("long").alias("lines_dropped"),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = drop_boilerplate(docs.select("doc_id", "source", "text"))
    return out.select(
        "doc_id", "source", "lines_dropped", F.length("text").cast("long").alias("chars_kept"), F.md5("text").alias("text_md5")
    )


ORACLE = f"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents),
d AS (SELECT DISTINCT doc_id, source, line FROM l),
n AS (SELECT source, line, count(*) AS n FROM d GROUP BY ALL),
h AS (SELECT source, count(*) AS pages FROM documents GROUP BY ALL),
b AS (SELECT n.source, n.line FROM n JOIN h ON n.source IS NOT DISTINCT FROM h.source
      WHERE n.n >= {MIN_PAGES} AND n.n > h.pages * {RATIO}::DOUBLE),
x AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines,
             coalesce((SELECT list(b.line) FROM b WHERE b.source IS NOT DISTINCT FROM documents.source), []) AS bad FROM documents),
y AS (SELECT doc_id, source, len(lines) AS n, list_filter(lines, lambda z: NOT list_contains(bad, z)) AS kept FROM x)
SELECT doc_id, source, coalesce(n - len(kept), 0)::BIGINT AS lines_dropped,
       length(array_to_string(kept, chr(10)))::BIGINT AS chars_kept, md5(array_to_string(kept, chr(10))) AS text_md5 FROM y
"""
