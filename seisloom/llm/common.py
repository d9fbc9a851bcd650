"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in
    ``spark.checkpoint.dir``. Only where that is unset and all runs on one machine
    (tests) a folder of our own is made and set; on a cluster it is an error."""
    set_here = spark.conf.get("spark.checkpoint.dir", None)
    if set_here:
        return set_here.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    made = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, no bytes for null."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def connected_components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """Smallest node reachable from each node of an undirected graph.

    ``edges(a, b)`` of one orderable type; loops, repeats and rows with a null
    are ignored. Returns ``(node, root)`` for each node with an edge to
    another one, the roots included. Alternates the large-star and small-star
    steps (Kiveris et al., 2014) until the edges are stars; each round is two
    aggregations with a join back and ends in a checkpoint, so no node's
    neighbours meet in one place. With ``rows`` a task writes that many edges or so, as the many shuffles
    of a small graph otherwise leave a file for each pair of tasks, which are larger than the edges.
    """
    now = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen, few = None, lambda df: df
    while (state := _checksum(now)) != seen:
        seen = state
        if rows:
            few = lambda df, n=1 + state[0] // rows: df.coalesce(n)  # noqa: E731  no more than there are
        both = few(now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = few(few(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(few(few(small.unionAll(low.select("u", F.col("m").alias("v")))).distinct()))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


def _checksum(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.bitwiseAND(0xFFFFFFFF))).first()
    return tuple(row)
