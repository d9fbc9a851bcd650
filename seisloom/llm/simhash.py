"""SimHash near-dedup by Golay-code fuzzy hashing (operator 7).

Fingerprints: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``width`` words, XXH64 (seed 42) of each; a bit is 1 if set in over half of them.

Links: 64 bits are cut into segments of 23, 23 and 18 bits. With at most 4
differing bits some two segments have at most 2 between them, so each of the two
has at most 2. A segment gets the indices of the Golay codewords nearest to it
and to its one-bit neighbours (1 or 6 of 4096); segments that differ in 2 bits or
fewer share one. A key is a pair of segments with an index of each, so linked
fingerprints share a key, and each pair that shares one is verified.

Near copies by similarity (``by_words``): fingerprints of shingles drift fast, since a changed word changes
``width`` of them: at a Jaccard similarity of 0.8 some 10 bits, beyond what the keys find. The keys
are then of the fingerprint of a text's distinct words, which drifts slowly, and a link needs
``WORDS_DISTANCE`` differing bits of those at most and ``distance`` of the shingles'. As chance moves such a fingerprint
by a few bits, there are ``TABLES`` of them, of differently scrambled hashes, and one that is near suffices. The exact bits
of each segment are keys, too: 6 differing bits leave some pair with 2 or fewer in each, or three in two segments and
none in the third.

Scale: only distinct fingerprints are hashed, so exact copies weigh as one. The
keys are shuffled once (about 84 small rows a fingerprint, whose buckets hold few of
2^24); a bucket is searched in numpy from one member outwards over those not
yet reached, which needs few passes over a group of near copies and gives a
spanning forest of its links, never all pairs. What a task holds of a bucket is 8
bytes a distinct fingerprint, and those that agree on a key within a group of
near copies are bounded by the ball around it, not by the copies. Components are
found by joins (``common.connected_components``).

Cases: null, empty and word-free texts have the fingerprint zero and link like any
other; fewer words than a shingle: the whole sequence is one shingle; rows with a
null id get a component from the others, null if there is none; repeated rows
repeat; empty input gives empty output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import golay
from .common import as_bytes, connected_components, cut, read, unused

WIDTH, DISTANCE, SEED = 4, 4, 42
WORDS_DISTANCE, TABLES = 6, 3
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit and length
PAIRS = ((0, 1), (0, 2), (1, 2))
SLICE = 1 << 16  # shingles counted at a time
ROWS = 1 << 18  # rows of whole buckets searched at a time: a row has up to SMALL links
EDGES = 50_000  # edges a task of the components
SMALL = 32  # members of a bucket whose pairs are compared directly


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """Of UTF-8 bytes: ``bytes.lower`` and ``bytes.split`` know only ASCII letters
    and the six ASCII white-space bytes, as wanted."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - width + 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[-n:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        h = np.array([xxh64_intdigest(flat[a:b], SEED) for a, b in zip(starts[at : at + SLICE], stops[at : at + SLICE], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def word_fingerprints(text: bytes) -> list[int]:
    """As ``fingerprint``, of the distinct words, by each of ``TABLES`` scrambles of their hashes."""
    from xxhash import xxh64_intdigest

    words = list(set(text.lower().split()))
    ones = np.zeros((TABLES, 64), np.int64)
    for at in range(0, len(words), SLICE):
        h = np.array([xxh64_intdigest(w, SEED) for w in words[at : at + SLICE]], np.uint64)
        for k in range(TABLES):
            if k:  # the finaliser of SplitMix64
                x = h + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                h_ = x ^ (x >> np.uint64(31))
            else:
                h_ = h
            ones[k] += np.unpackbits(h_.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > len(words), axis=1, bitorder="little").view("<u8")[:, 0].tolist()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, by_words: bool = False) -> DataFrame:
    """``(doc_id, fp)`` of every document, fp as a signed long; with ``by_words`` also ``words0``, ``words1``..., those of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            found = [np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))]
            if by_words:
                found += list(np.array([word_fingerprints(t) for t in texts], np.uint64).reshape(-1, TABLES).T.copy())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x.view(np.int64)) for x in found)], names)

    names = ["doc_id", "fp", *(f"words{k}" for k in range(TABLES if by_words else 0))]
    rows = docs.select(F.col(doc_id).alias("doc_id"), as_bytes(F.col(text)).alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in names[1:]))


def fuzzy_keys(fps: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of every fingerprint, with ``exact`` also the bits of each segment."""
    near, (rows, keys) = [], ([x] for x in segment_keys(fps)) if exact else ([], [])
    for first, bits in SEGMENTS:
        part = (fps >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        near.append(golay.near_indices(part.astype(np.int64), bits))
    for number, (a, b) in enumerate(PAIRS):
        key = (number << 24) | (near[a][0][:, :, None] << 12) | near[b][0][:, None, :]
        on = near[a][1][:, :, None] & near[b][1][:, None, :]
        rows.append(np.nonzero(on)[0])
        keys.append(key[on])
    return np.concatenate(rows), np.concatenate(keys).astype(np.int32)


def segment_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the bits of each segment, of other keys than ``fuzzy_keys`` has."""
    keys = [(fps >> np.uint64(first)) & np.uint64((1 << bits) - 1) | np.uint64((len(PAIRS) + k) << 24) for k, (first, bits) in enumerate(SEGMENTS)]
    return np.tile(np.arange(len(fps)), len(keys)), np.concatenate(keys).astype(np.int32)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Of edges, those that join what the earlier ones do not."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := top.setdefault(x, x)) != x:
            top[x] = top[y]
            x = top[x]
        return x

    out: tuple[list[int], list[int]] = [], []
    for x, y in np.unique(np.stack([a, b], 1), axis=0).tolist() if len(a) else ():
        p, q = find(x), find(y)
        if p != q:
            top[max(p, q)] = min(p, q)
            out[0].append(x)
            out[1].append(y)
    return out


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of edges, each node of a component with the least one of it."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    top, p, q = np.arange(len(nodes)), at[: len(a)], at[len(a) :]
    while len(p):
        np.minimum.at(top, np.maximum(top[p], top[q]), np.minimum(top[p], top[q]))
        while (top[top] != top).any():
            top = top[top]
        apart = top[p] != top[q]
        p, q = p[apart], q[apart]
    leaf = top != np.arange(len(nodes))
    return nodes[leaf], nodes[top[leaf]]


def bucket_links(
    key: np.ndarray, fp: np.ndarray, distance: int = DISTANCE, words: np.ndarray | None = None, root: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, within each bucket of sorted ``key``, what is connected
    by pairs of ``distance`` bits or fewer, and of ``WORDS_DISTANCE`` in ``words`` if given.
    With ``root``, those between different roots, named by them."""

    def near(a, b):
        hit = np.bitwise_count(fp[a] ^ fp[b]) <= distance
        return hit if words is None else hit & (np.bitwise_count(words[a] ^ words[b]) <= WORDS_DISTANCE)

    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([first, [len(key)]]))
    left = np.repeat(np.where(size <= SMALL, first + size, first), size) - np.arange(len(key)) - 1  # members after it
    at, found = np.flatnonzero(left > 0), []
    for k in range(1, SMALL):
        at = at[left[at] >= k]
        if not len(at):
            break
        hit = at[near(at, at + k)]
        found.append((hit, hit + k))
    for a, n in zip(first[size > SMALL], size[size > SMALL], strict=True):
        rest, queue = np.arange(a, a + n), []
        while len(rest):
            if not queue:
                queue, rest = [rest[0]], rest[1:]
            x = queue.pop()
            hit = near(rest, x)
            if hit.any():
                found.append((np.full(hit.sum(), x), rest[hit]))
                queue.extend(rest[hit])
                rest = rest[~hit]
    ends = fp if root is None else root
    if not found:
        return np.zeros(0, ends.dtype), np.zeros(0, ends.dtype)
    a, b = ends[np.concatenate([x[0] for x in found])], ends[np.concatenate([x[1] for x in found])]
    return (a, b) if root is None else (a[a != b], b[a != b])


def links(fps: DataFrame, distance: int = DISTANCE, stars: bool = False, coders: tuple | None = None) -> DataFrame:
    """``(a, b)`` links of fingerprints, distinct rows ``fps(fp)`` or ``fps(fp, words...)``: a spanning forest, and
    maybe more, of the graph that joins those at ``distance``. Without ``words`` every link is found, up to a
    distance of 4; with them every link of ``WORDS_DISTANCE`` differing bits or fewer of some column of the words' fingerprints.
    With ``stars`` edges of the same components instead, to the least of what a task joins: see ``thinned``.
    With a last column ``root`` only links between different roots, as ``(a, b)`` of roots. ``coders`` give the keys; all by default."""
    names = fps.columns
    tables = [k for k, c in enumerate(names) if c.startswith("words")]
    coders = coders or ((segment_keys, fuzzy_keys) if tables else (fuzzy_keys,))
    if not tables and distance > 4:
        raise ValueError("the keys find pairs at 4 differing bits or fewer")
    carry = ["fp", *(["words"] if tables else []), *(["root"] if "root" in names else [])]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [c.to_numpy().view(np.uint64) for c in batch.columns]
            for at in range(0, batch.num_rows, 2048):
                part = [c[at : at + 2048] for c in every]
                for number, k in enumerate(tables or [0]):
                    carried = [part[0], *([part[k]] if tables else []), *([part[-1]] if "root" in names else [])]
                    for coder in coders:
                        row, key = coder(part[k])
                        yield pa.RecordBatch.from_arrays([pa.array(key | np.int32(number << 27)), *(pa.array(c[row].view(np.int64)) for c in carried)], ["key", *carry])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(key, fp, words=None, root=None):
            a, b = bucket_links(key, fp.view(np.uint64), distance, None if words is None else words.view(np.uint64), root)
            a, b = (_stars if stars else _forest)(a.view(np.int64), b.view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        held, n = [], 0
        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            n += batch.num_rows
            if n >= ROWS:
                every = [np.concatenate(x) for x in zip(*held, strict=True)]
                whole = int(np.searchsorted(every[0], every[0][-1]))  # the last bucket may go on
                if whole:
                    yield linked(*(c[:whole] for c in every))
                held, n = [[c[whole:] for c in every]], 0
        if held:
            yield linked(*(np.concatenate(x) for x in zip(*held, strict=True)))

    keyed = fps.mapInArrow(keys, "key int, " + ", ".join(f"{c} long" for c in carry))
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(search, "a long, b long")


def thinned(edges: DataFrame) -> DataFrame:
    """``(a, b)`` of the same components: of each node's edges to lesser ones that to the least stays, and the others lead there.

    Every task that sees a group of near copies has a tree of it, so there are edges as many as tasks times members. When
    these are stars, they go to few centres, and what is left is about an edge a member. A node has an edge a task at most here."""
    up = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    up = up.withColumn("b", F.min("v").over(Window.partitionBy("u")))
    return up.select(F.when(F.col("v") == F.col("b"), F.col("u")).otherwise(F.col("v")).alias("a"), "b").distinct()


def _joined(fps: DataFrame, distance: int) -> DataFrame:
    """``(node, root)`` of the links of ``fps(fp, words0, words1...)``.

    Near copies meet in nearly all of their keys, and each task that sees them would give an edge a member. So equal segments come first, a few
    keys each, which join most of a large group; the search by all other keys gives only links between what they left apart."""
    rows = cut(fps.distinct())
    known = cut(connected_components(thinned(links(rows, distance, True, (segment_keys,))), EDGES))
    rows = cut(rows.join(known.withColumnRenamed("node", "fp"), "fp", "left").select(*rows.columns, F.coalesce("root", "fp").alias("root")))
    between = None
    for k in range(TABLES):  # one after the other: the keys of one table at a time are on disk
        table = rows.select("fp", F.col(f"words{k}").alias("words"), "root").distinct()
        edges = cut(thinned(links(table, distance, True, (fuzzy_keys,))))
        between = edges if between is None else between.unionAll(edges)
    found = cut(connected_components(between, EDGES))
    top = found.select(F.col("node").alias("root"), F.col("root").alias("top"))
    new = found.join(known.select(F.col("root").alias("node")), "node", "left_anti")  # in no link before
    return known.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")).unionAll(new.select("node", "root"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, distance: int = DISTANCE, by_words: bool = False
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every document."""
    rows = cut(fingerprints(docs, doc_id, text, width, by_words))
    classes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    if by_words:
        linked = _joined(rows.drop("doc_id"), distance)
    else:
        linked = connected_components(links(classes.select("fp"), distance))
    linked = linked.withColumnRenamed("node", "fp")
    linked = linked.join(classes, "fp")
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = cut(  # a plain side, so that Spark can split the join of a hot fingerprint
        classes.join(linked.select("fp", "root").join(lowest, "root"), "fp", "left")
        .select("fp", F.coalesce("component_id", "first").alias("component_id"))
    )
    return rows.join(of_class, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without near duplicates: of each component of fingerprints the one of the
    smallest id, then of the smallest hash of its text, once; null ids come last, and
    all columns stay. Ids need not be unique: documents are told apart by id and text."""
    h, key, n = (unused(docs, x) for x in ("hash_", "kept_", "row_"))
    hashed = F.xxhash64(as_bytes(F.col(text)))
    named = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), hashed.alias("hash"))
    found = near_duplicates(docs.select(named.alias("doc_id"), F.col(text).alias("text")), **options)
    kept = found.select(F.col("component_id.id").alias(key), F.col("component_id.hash").alias(h)).distinct()
    rows = docs.join(kept, (hashed == F.col(h)) & F.col(doc_id).eqNullSafe(F.col(key)), "left_semi")
    rest = [c for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()]
    once = Window.partitionBy(doc_id, hashed).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in rest]))  # equal documents only
    return rows.withColumn(n, F.row_number().over(once)).where(F.col(n) == 1).drop(n)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
