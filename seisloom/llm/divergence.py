"""Source divergence audit by chunk factorization (operator 12).

How far the word use of a source departs from that of the other sources of its
language, and by which terms. Chunks are what ASCII white space separates
(``[^\\x20\\x09-\\x0D]+``); the terms of a chunk are its matches of ``TERM``, A-Z
lower-cased. White space parts terms, so a text's terms are those of its chunks.

Method: a task counts the chunks of its documents and sends, for each block of
documents, language and chunk, one row: how often each source has it and in which
documents of the block (two bytes each). Each globally distinct chunk is tokenized once and
its terms are joined back. Occurrences are then sums; the distinct documents of a term
are the union of its chunks' documents within a block, summed over blocks. Only terms that the
sums by chunk leave open, in fewer documents than asked for by any chunk alone but not by all together, need the union.

Scale: rows are chunks of a block, not of a document. Joins on the chunk are plain
joins, so that Spark splits those of frequent chunks; sums are combined before each
shuffle; the union of a term is bounded by ``BLOCK`` documents. Pairs of sources are
compared in numpy, a row of two blocks of ``SIDE`` sources for each term, added up in
the task; a term in neither block counts through its number. All arithmetic is in
integers and decimals.

Cases: null text has no terms, null language and source are ''; each row is a
document, repeated ones too; a language with no kept term has pairs of value 0; a source alone in its
language has no pairs; empty input gives empty output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_bytes, cut, fresh_path, read

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS, TOP, SMOOTH, SCALE = 30, 50, 5, 1_000_000_000
BLOCK, BLOCK_BYTES = 1 << 14, 1 << 25  # documents of a block and about their bytes
SIDE = 256  # sources of a block
SALTS = 64
AT_ONCE = 1 << 20  # entries of a dense matrix


class _Numbers(dict):
    """Numbers its keys as they are asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(sizes):
        stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at : at + BLOCK]), BLOCK_BYTES, side="right")))
        yield at, stop
        at = stop


def _postings(block: int, lang: str, texts: list[bytes], source: list[str]) -> pa.RecordBatch:
    """A row for each chunk of the documents of one language."""
    number, names = _Numbers(), _Numbers()
    each = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in map(bytes.split, texts)]
    from_source = np.array([names[s] for s in source], np.int64)
    keys = np.concatenate([ids * len(each) + doc for doc, ids in enumerate(each)])
    keys, n = np.unique(keys, return_counts=True)
    chunk, doc = np.divmod(keys, len(each))
    docs_at = np.searchsorted(chunk, np.arange(len(number) + 1))
    pair, back = np.unique(chunk * len(names) + from_source[doc], return_inverse=True)
    total = np.zeros(len(pair), np.int64)
    np.add.at(total, back, n)
    pair_chunk, pair_source = np.divmod(pair, max(1, len(names)))
    by_source = pa.StructArray.from_arrays([pa.array(list(names), pa.string()).take(pa.array(pair_source)), pa.array(total)], ["source", "n"])
    pairs_at = np.searchsorted(pair_chunk, np.arange(len(number) + 1)).astype(np.int32)
    packed = pa.BinaryArray.from_buffers(pa.binary(), len(number), [None, pa.py_buffer((docs_at * 2).astype(np.int32)), pa.py_buffer(doc.astype("<u2"))])
    size = len(number)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, block)), pa.array([lang] * size, pa.string()), pa.array(list(number), pa.binary()).cast(pa.string()), packed, pa.ListArray.from_arrays(pairs_at, by_source)],
        ["block", "lang", "chunk", "docs", "by_source"],
    )


def chunk_postings(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(block, lang, chunk, docs, by_source)``: ``docs`` the numbers in the block, two bytes each, of
    the documents with the chunk, ``by_source`` its occurrences in each source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, langs, sources = batch.columns
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4))
            for a, b in _blocks(sizes):
                of: dict[str, tuple[list, list]] = {}
                for t, k, s in zip(texts[a:b], langs[a:b].to_pylist(), sources[a:b].to_pylist(), strict=True):
                    rows = of.setdefault(k, ([], []))
                    rows[0].append(t.as_py())
                    rows[1].append(s)
                for k, rows in of.items():
                    yield _postings(block, k, *rows)
                block += 1

    rows = docs.select(as_bytes(F.col(text)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang, source)))
    return rows.mapInArrow(run, "block long, lang string, chunk string, docs binary, by_source array<struct<source: string, n: long>>")


def tokenized(postings: DataFrame) -> DataFrame:
    """``(lang, chunk, documents, term, times)`` of the chunks of ``postings``, each distinct one tokenized once.

    A chunk has a row for each block and language at most, so its rows go to one task uncombined."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rows = postings.select("chunk", "lang", (F.octet_length("docs") / 2).cast("long").alias("n")).repartition("chunk")
    in_lang = rows.groupBy("chunk", "lang").agg(F.sum("n").alias("documents"))
    once = in_lang.groupBy("chunk").agg(F.collect_list(F.struct("lang", "documents")).alias("langs"))
    terms = F.regexp_extract_all(F.translate("chunk", upper, upper.lower()), F.lit(TERM), F.lit(0))
    times = once.select("chunk", "langs", F.explode(terms).alias("term")).groupBy("chunk", "term").agg(F.first("langs").alias("langs"), F.count("*").alias("times"))
    return times.select("chunk", "term", "times", F.explode("langs").alias("x")).select("x.lang", "chunk", "x.documents", "term", "times")


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of distinct documents in each row's packed lists."""
    for batch in batches:
        lists = batch.column(2)
        n = np.fromiter((len(x[0]) // 2 if len(x) == 1 else len(np.unique(np.frombuffer(b"".join(x), "<u2"))) for x in lists.to_pylist()), np.int64, len(lists))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n)], ["lang", "term", "documents"])


def term_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS, **columns) -> tuple[DataFrame, DataFrame]:
    """``(lang, term)`` of the terms in ``least`` documents of the language, and their occurrences ``(lang, source, term, n)``."""
    spark = docs.sparkSession
    at = fresh_path(spark, "chunks")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{at}/{name}")
        return spark.read.parquet(f"{at}/{name}")

    postings = stored(chunk_postings(docs, **columns), "postings")
    terms = stored(tokenized(postings), "terms")
    # a term is in as many documents as the most frequent of its chunks at least, and in the sum of all at most
    bounds = terms.groupBy("lang", "term").agg(F.max("documents").alias("lower"), F.sum("documents").alias("upper")).where(F.col("upper") >= least)
    bounds = stored(bounds, "bounds")
    asked = terms.join(bounds, ["lang", "term"]).select("lang", "chunk", "term", "times", (F.col("lower") < least).alias("open"))
    found = postings.join(asked, ["lang", "chunk"]).select("block", "lang", "term", "times", "by_source", F.when(F.col("open"), F.col("docs")).alias("docs"))
    found = stored(found, "found")
    in_block = found.where(F.col("docs").isNotNull()).groupBy("block", "lang", "term").agg(F.collect_list("docs").alias("docs"))
    united = in_block.select("lang", "term", "docs").mapInArrow(_united, "lang string, term string, documents long")
    settled = united.groupBy("lang", "term").agg(F.sum("documents").alias("documents")).where(F.col("documents") >= least)
    kept = stored(bounds.where(F.col("lower") >= least).select("lang", "term").unionAll(settled.select("lang", "term")), "kept")
    each = found.select("lang", "term", "times", F.explode("by_source").alias("x"))
    counts = each.groupBy("lang", F.col("x.source").alias("source"), "term").agg(F.sum(F.col("x.n") * F.col("times")).alias("n"))
    return kept, counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n")


def _p(n: Column | str, total: str, size: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * size)), in decimals of 38 digits."""
    whole = lambda c: c.cast("decimal(20,0)")
    over, under = whole(F.col(n) if isinstance(n, str) else n) + SMOOTH, whole(F.col(total)) + F.col(size) * SMOOTH
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * over, under.cast("decimal(38,0)")) + 1


def _differences(side: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over terms of the absolute differences of every two sources of a pair of blocks.

    A row has a term's entries (place of the source, p); the others have their block's p of no occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, lo, hi), (matrix, n) in sums.items():
                a, b = (x.ravel() for x in np.indices(matrix.shape))
                m = len(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * m, pa.string()), *(pa.array(np.full(m, x), pa.int32()) for x in (lo, hi)), pa.array(a + lo * side, pa.int32()), pa.array(b + hi * side, pa.int32()),
                     pa.array(matrix.ravel()), pa.array(np.full(m, n))],
                    ["lang", "lo", "hi", "a", "b", "value", "n"],
                )

        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            offsets = column["found"].offsets.to_numpy()
            idx, p = (column["found"].values.field(x).to_numpy() for x in ("idx", "p"))
            at: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(column[x].to_pylist() for x in ("lang", "lo", "hi")), strict=True)):
                at.setdefault(key, []).append(i)
            for key, members in at.items():
                _, lo, hi = key
                zero_lo, zero_hi = (column[x][members[0]].as_py() for x in ("zero_lo", "zero_hi"))
                left, zeros = len(zero_lo), np.array(zero_lo + (zero_hi if hi != lo else []), np.int64)
                total = sums.setdefault(key, [np.zeros((left, len(zeros) - left if hi != lo else left), np.int64), 0])
                step = max(1, AT_ONCE // max(1, len(zeros)))
                for k in range(0, len(members), step):
                    part = np.array(members[k : k + step])
                    size = offsets[part + 1] - offsets[part]
                    flat = np.repeat(offsets[part], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    dense = np.tile(zeros, (len(part), 1))
                    where = np.where(idx[flat] // side == lo, idx[flat] - lo * side, idx[flat] - hi * side + left)
                    dense[np.repeat(np.arange(len(part)), size), where] = p[flat]
                    right = dense[:, left:] if hi != lo else dense
                    for a in range(left):
                        total[0][a] += np.abs(dense[:, a : a + 1] - right).sum(0)
                    total[1] += len(part)
            if len(sums) > 64:
                yield from out()
                sums.clear()
        yield from out()

    return run


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", side: int = SIDE, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` has each other source of the language
    with the summed difference over all kept terms, part ``term`` the ``top`` terms that the source has more of
    than its language."""
    spark = docs.sparkSession
    kept, counts = term_counts(docs, text=text, lang=lang, source=source)
    counts = cut(counts)
    sizes = kept.groupBy("lang").agg(F.count("*").alias("size"))
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source")))).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int")
    of_group = (
        groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "size"])
        .withColumn("idx", number).withColumn("last", F.floor(F.max("idx").over(Window.partitionBy("lang")) / side).cast("int")).withColumn("zero", F.when(F.col("size") > 0, _p(F.lit(0), "total", "size")).otherwise(0))
    )
    of_group = cut(of_group)
    shares = cut(counts.join(of_group, ["lang", "source"]).select("lang", "source", "idx", "last", "term", "n", _p("n", "total", "size").alias("p")))

    in_all = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(
        of_group.groupBy("lang").agg(F.sum("total").alias("total"), F.max("size").alias("size")), "lang"
    )
    above = shares.join(in_all.select("lang", "term", _p("n", "total", "size").alias("q")), ["lang", "term"]).where("p > q")
    of_source = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(of_source)).where(F.col("rank") <= top)

    block = F.floor(F.col("idx") / side).cast("int")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("idx", "zero"))), lambda x: x["zero"])
    blocks = of_group.groupBy("lang", block.alias("block")).agg(listed.alias("zeros"))
    salt = F.pmod(F.hash("term"), F.lit(SALTS))  # a language's terms are many, its blocks few
    salted = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = shares.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    by_term = (
        dealt.groupBy("lang", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "term").agg(F.collect_list(F.struct("idx", "p")).alias("found"))
        .withColumn("salt", salt)
        .join(salted.select("lang", "salt", F.col("block").alias("lo"), F.col("zeros").alias("zero_lo")), ["lang", "salt", "lo"])
        .join(salted.select("lang", "salt", F.col("block").alias("hi"), F.col("zeros").alias("zero_hi")), ["lang", "salt", "hi"])
    )
    parts = cut(by_term.select("lang", "lo", "hi", "found", "zero_lo", "zero_hi").mapInArrow(_differences(side), "lang string, lo int, hi int, a int, b int, value long, n long"))
    summed = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("n").alias("met"))
    both = summed.unionAll(summed.where(F.floor(F.col("a") / side) != F.floor(F.col("b") / side)).select("lang", F.col("b"), F.col("a"), "value", "met"))
    one, two = (of_group.select("lang", "size", F.col("source").alias(s), F.col("idx").alias(i), F.col("zero").alias(z)) for s, i, z in (("source", "a", "za"), ("item", "b", "zb")))
    missing = (F.col("size") - F.coalesce("met", F.lit(0))) * F.abs(F.col("za") - F.col("zb"))
    pairs = (
        one.join(two.drop("size"), "lang").where("a <> b").join(both, ["lang", "a", "b"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", (F.coalesce("value", F.lit(0)) + missing).alias("value"))
        .withColumn("rank", F.row_number().over(of_source))
    )
    return pairs.unionByName(terms)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM d),
c AS (SELECT i, lang, source, term, count(*) AS n FROM t GROUP BY ALL),
kept AS (SELECT lang, term FROM c GROUP BY ALL HAVING count(*) >= {LEAST_DOCUMENTS}),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM c JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n,
        (1 + {SCALE}::HUGEINT * (coalesce(n.n, 0) + {SMOOTH}) // (coalesce(total, 0) + {SMOOTH} * v))::BIGINT AS p
      FROM g JOIN kept ON g.lang = kept.lang JOIN size ON g.lang = size.lang LEFT JOIN total ON g.lang = total.lang AND g.source = total.source
      LEFT JOIN n ON g.lang = n.lang AND g.source = n.source AND kept.term = n.term),
q AS (SELECT lang, term, (1 + {SCALE}::HUGEINT * (sum(n) + {SMOOTH}) // (any_value(t) + {SMOOTH} * any_value(v)))::BIGINT AS q
      FROM n JOIN (SELECT lang, sum(total) AS t FROM total GROUP BY ALL) USING (lang) JOIN size USING (lang) GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
           coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                     WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (FROM pair UNION ALL FROM term))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
