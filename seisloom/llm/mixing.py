"""Mixing sources to target weights (operator 3, DataFrame functions only).

Sources in code-point order, null last, weigh ``weights`` in turn and share
``share`` of all words. A target stops at ``limit`` times its source's words;
what is over goes to the others by weight until none is above. Each document
gets a hash-random key; along the keys of its source a target takes whole
passes and then the first words up to its exact budget, so the document at the
cut gives part of its words.

Scale: the high bits of the uniform keys range-partition each source into
buckets of like size, a hot source into as many as there are partitions. Word
sums of buckets, combined before the shuffle, give each bucket its offset; the
running sum inside a bucket finishes the prefix sum. No task holds a source.
Only the table of sources (one row each, from the aggregate) is ordered as a whole.

Cases: null text has size 0; null doc_id has the key of the empty text; rows
with equal ids are told apart by size only, equal rows are interchangeable;
sources without words get target 0 and give nothing; columns of any other name
stay as they are; empty input, empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, partitions, read, unused

WEIGHTS, SHARE, LIMIT, SEED = (5, 2, 1), 1.5, 2, "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """``sources(src, src_null, words)`` with ``target`` (double).

    The targets are the level at which ``min(level * weight, limit * words)``
    adds up to the share: in order of ``words / weight`` the sources up to some
    place stop at their limit, and the rest divide what is left by weight.
    """
    rank = Window.orderBy("src_null", F.col("src").cast("binary"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.row_number().over(rank) - 1) % len(weights) + 1)
    rows = sources.withColumn("w", w).withColumn("cap", F.lit(limit) * F.col("words"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "src_null", F.col("src").cast("binary"))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("words").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(after)
    rows = rows.withColumn("level", level)
    # the first place whose source stays within its limit sets the level of all from there on
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    rows = rows.withColumn("level", F.first(fits, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.coalesce(F.least(F.col("level") * F.col("w"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return rows.select("src", "src_null", "words", target.alias("target"))


def mix_sources(
    docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id",
    weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, seed: str = SEED, carry: list[str] | None = None,
) -> DataFrame:
    """Columns ``carry`` (all by default) of every document with ``size``, ``source_size``,
    ``target`` and ``taken`` (words the mix takes, repeats counted); columns of
    those names are replaced."""
    spark = docs.sparkSession
    bits = max(4, (partitions(spark) - 1).bit_length())
    number = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(seed))), 1, 15), 16, 10)
    new = ("size", "source_size", "target", "taken")
    carry = [c for c in (carry or docs.columns) if c.lower() not in new]
    rows = docs.select(  # the caller's columns in a struct, so that none clashes
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]).alias("held"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
        F.col(source).isNull().alias("src_null"),
        number.cast("long").alias("key"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col(doc_id).alias("tie"),
    ).withColumn("bucket", F.shiftright("key", 60 - bits))
    site, place = ["src", "src_null"], ["src", "src_null", "bucket"]
    sums = cut(rows.groupBy(*place).agg(F.sum("size").alias("words")))
    totals = sums.groupBy(*site).agg(F.sum("words").alias("words"))
    targets = source_targets(totals, weights, share, limit).withColumnRenamed("words", "source_size")
    earlier = Window.partitionBy(*site).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words").join(targets, site)
    run = Window.partitionBy(*place).orderBy("key", "tie", "size").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(offsets, place).withColumn("end", F.col("before") + F.sum("size").over(run))
    size, budget = F.col("size"), F.floor("target")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - passes * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(size, rest - (F.col("end") - size)))
    return out.select(
        *[F.col(f"held.c{i}").alias(c) for i, c in enumerate(carry)],
        "size", "source_size", "target", (passes * size + part).cast("long").alias("taken"),
    )


def take_documents(mixed: DataFrame) -> DataFrame:
    """The mix as documents: a row for each pass over a document, the last one of
    the document at the cut whole as well; documents that give nothing go."""
    passes = F.ceil(F.col("taken") / F.col("size")).cast("int")
    n = unused(mixed, "pass_")
    taken = mixed.where("taken > 0").withColumn(n, F.explode(F.sequence(F.lit(1), passes)))
    return taken.drop(n, "size", "source_size", "target", "taken")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mix_sources(docs, carry=["doc_id", "source"]).select("doc_id", "size", "source_size", "target", "taken", "source")


ORACLE = f"""
WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '{SEED}'), 1, 15))::BIGINT AS k FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS words FROM s GROUP BY ALL),
r AS (SELECT source, words, {LIMIT} * words AS cap,
  list_extract([5, 2, 1], ((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::INT) AS w FROM t),
v AS (SELECT *, ({SHARE}::DOUBLE * (sum(words) OVER ())::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level, row_number() OVER o AS place FROM r
  WINDOW o AS (ORDER BY cap::DOUBLE / w::DOUBLE, source COLLATE "C" NULLS LAST)),
f AS (SELECT arg_min(level, place) AS level FROM v WHERE level * w <= cap),
g AS (SELECT v.source, v.words, least(coalesce(f.level, 1e300) * v.w, v.cap::DOUBLE) AS target FROM v, f),
c AS (SELECT s.doc_id, s.source, s.size, g.words AS source_size, g.target,
  sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS e
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size)::BIGINT ELSE 0 END AS n FROM c)
SELECT doc_id, size, source_size, target,
  (n * size + greatest(0, least(size, floor(target)::BIGINT - n * source_size - (e - size))))::BIGINT AS taken, source FROM p
"""
