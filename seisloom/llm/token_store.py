"""Token ids in a content-addressed store (operator 5).

``write_store`` encodes texts, cuts each id stream into chunks where a rolling
hash over ``WINDOW`` ids says so, and writes

* ``objects/kind=chunk``: every distinct chunk once, under the SHA-256 of its bytes,
* ``recipes``: documents in ascending ``doc_id`` order (``part`` numbers the
  ranges) with ``n_tokens``, the addresses of their chunks and their Merkle root,
* ``manifest``: for each range its documents, tokens, width of an id in bytes and the
  root of a Merkle tree over its recipes, ``FAN`` to a node.

``read_ids`` rebuilds the id streams; ``read_digests`` reads every chunk once,
checks its address and gives each document's place and CRC, combined from the
chunks' CRCs as the CRC of a concatenation. Both compare what they read with the
documents' Merkle roots and these with the manifest, and fail on a difference.

Scale: encoding, cutting and hashing are one pass; each task sends a chunk once,
so a passage in a third of all documents arrives at its address once a task.
Chunk bytes are shuffled once and never again: digests move 50 bytes a chunk.
Places in the stream come from sums of the ranges. A task holds an Arrow batch, an
id cache of ``CACHE`` strings and the addresses it has sent (``SENT`` at most; a
forgotten one is sent again and dropped by the writer). A node of a Merkle tree is built
from ``FAN`` nodes below it, level by level, so no range of recipes meets in a row.

Words are encoded once each only for the normalizer and pattern that this was made for
(``WORD_BY_WORD``); texts go whole to the library for any other vocabulary.

Cases: null and empty texts are the end id alone; repeated documents repeat in
recipes, not in chunks; null ids come first; the empty table gives empty tables.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_bytes, cut, fresh_path, partitions, read

END = 1
WINDOW, BITS, LEAST, MOST = 8, 8, 64, 1024  # ids: of the rolling hash, 2^BITS between cuts, of a chunk
CACHE, SENT, FAN = 800_000, 500_000, 512
#: A fixed value: the parts of a tokenizer file by which ids of a text are those of its words, in lower case.
WORD_BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
MARK = "\x01"  # stands between strings encoded together
PLAIN_ENDS = ",.;:!?*#$%&"  # after letters these are one more word of the tokenizer's pattern


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Encodes texts with the tokenizers library, each distinct string between
    spaces once as long as the cache has room.

    Only for tokenizers that drop white space before merging (``WORD_BY_WORD``):
    what they give for a text is then what they give for its parts, joined. Each
    string's ids are kept as little-endian bytes. Others encode whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        self.by_words = all(parts.get(k) == v for k, v in WORD_BY_WORD.items())
        size = self.library.get_vocab_size()
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.known = _Known({"": b""})
        mark = self.library.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(size, bool)
        if suffix:
            for token, i in self.library.get_vocab().items():
                self.ends_word[i] = token.endswith(suffix)
        self.known_ends = bool(self.ends_word.any())
        self.parts: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.kind == '<u2' else 'I'}", *ids)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_plain(self, words: list[str], ends: list[int], out: dict[str, bytes]) -> None:
        """Words of which the number of word ends is known, encoded together."""
        for at in range(0, len(words), 200):
            group = words[at : at + 200]
            (ids,) = self._encode([" ".join(group)])
            last = np.flatnonzero(self.ends_word[ids])[np.cumsum(ends[at : at + 200]) - 1] + 1
            data, size = ids.tobytes(), ids.itemsize
            stops = (last * size).tolist()
            out.update((w, data[a:b]) for w, a, b in zip(group, [0, *stops], stops, strict=False))

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        plain, ends, others = [], [], []
        tokenize, pack, parts = self.library.model.tokenize, self.pack, self.parts
        for w in words:
            core = w.rstrip(PLAIN_ENDS)
            if core.isalpha() and core.isascii():
                # ASCII letters are one word of the pattern, and stand for themselves in the byte alphabet
                core, tail = core.lower(), w[len(core) :]
                ids = parts.get(core)
                if ids is None:
                    ids = pack([t.id for t in tokenize(core)])
                    if len(parts) < CACHE:
                        parts[core] = ids
                if tail:
                    if tail not in parts:
                        parts[tail] = self._encode([tail])[0].tobytes()
                    ids += parts[tail]
                out[w] = ids
            elif self.known_ends and core.isalpha() and core.lower().isalpha():
                plain.append(w)
                ends.append(1 + (len(core) < len(w)))
            else:
                others.append(w)
        self._encode_plain(plain, ends, out)
        alone = [w for w in others if self.mark is None or MARK in w]
        for w, ids in zip(alone, self._encode(alone), strict=True):
            out[w] = ids.tobytes()
        others = [w for w in others if w not in out] if alone else others
        groups = [others[i : i + 200] for i in range(0, len(others), 200)]
        for group, ids in zip(groups, self._encode([f" {MARK} ".join(g) for g in groups]), strict=True):
            data, size = ids.tobytes(), ids.itemsize
            stops = (np.flatnonzero(ids == self.mark) * size).tolist()
            for w, a, b in zip(group, [0, *(x + size for x in stops)], [*stops, len(data)], strict=True):
                out[w] = data[a:b]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return [ids.tobytes() for ids in self._encode(texts)]
        split = [t.replace("\n", " ").split(" ") for t in texts]
        look = self.known.__getitem__
        got = [list(map(look, words)) for words in split]
        new, self.known.asked = self.known.asked, set()
        if new:
            found = self.encode_words(list(new))
            for words, ids in zip(split, got, strict=True):
                for i in range(ids.count(None)):
                    at = ids.index(None, at + 1 if i else 0)
                    ids[at] = found[words[at]]
            if len(self.known) < CACHE:
                self.known.update(found)
        return [b"".join(ids) for ids in got]


class _Known(dict):
    """Ids by string; notes the strings that were asked for in vain."""

    def __init__(self, *items):
        super().__init__(*items)
        self.asked: set[str] = set()

    def __missing__(self, word: str) -> None:
        self.asked.add(word)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _gear(ids: np.ndarray) -> np.ndarray:
    """A fixed 64-bit scramble of each id (the finaliser of SplitMix64)."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of an id stream. They depend on the ids nearby only, so
    a passage is cut alike wherever it stands."""
    n = len(ids)
    if n <= LEAST:
        return [n] if n else []
    g, h = _gear(ids), np.zeros(n, np.uint64)
    for back in range(WINDOW):
        h[back:] += g[: n - back] << np.uint64(back * 7)
    h *= np.uint64(0x9E3779B97F4A7C15)
    out, last = [], 0
    for end in (np.flatnonzero(h >> np.uint64(64 - BITS) == 0) + 1).tolist() + [n]:
        while end - last > MOST:
            last += MOST
            out.append(last)
        if end - last >= LEAST or end == n:
            last = end
            out.append(last)
    return out if out[-1] == n else [*out, n]


def merkle_root(leaves: list[bytes]) -> bytes:
    """Of a tree with ``FAN`` nodes to a node; one leaf is its own root."""
    level = leaves or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"".join(level[i : i + FAN])).digest() for i in range(0, len(level), FAN)]
    return level[0]


def merkle_root_of(leaves: Column) -> Column:
    """``merkle_root`` of an array of ``FAN`` to the third leaves at most (some 30 billion ids)."""
    for _ in range(3):
        joined = lambda i, x=leaves: F.aggregate(F.slice(x, i + 1, FAN), F.lit(b""), lambda a, b: F.concat(a, b))
        above = F.transform(F.sequence(F.lit(0), F.size(leaves) - 1, F.lit(FAN)), lambda i: F.unhex(F.sha2(joined(i), 256)))
        leaves = F.when(F.size(leaves) > 1, above).otherwise(leaves)
    return leaves[0]


def write_store(docs: DataFrame, path: str, vocabulary: str | None = None, text: str = "text", doc_id: str = "doc_id") -> str:
    """Writes the store under ``path``, a folder that does not exist yet."""
    vocabulary = vocabulary or default_vocabulary()
    spark, kind = docs.sparkSession, docs.schema[doc_id].dataType
    schema = f"kind string, key binary, doc_id {kind.simpleString()}, n_tokens long, parts array<binary>, root binary, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sent = encoder(vocabulary), set()
        end = np.array([END], words.kind).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                ids_of = batch.column(0).slice(at, 128)
                rows: dict[str, list] = {x: [] for x in ("kind", "key", "doc", "n_tokens", "parts", "root", "data")}

                def add(*row, rows=rows):
                    for column, x in zip(rows.values(), row, strict=True):
                        column.append(x)

                texts = [t.as_py().decode() for t in batch.column(1).slice(at, 128)]
                for i, data in enumerate(words.encode(texts)):
                    data += end
                    ids, parts, last = np.frombuffer(data, words.kind), [], 0
                    for stop in cuts(ids):
                        chunk = data[last * ids.itemsize : stop * ids.itemsize]
                        address, last = hashlib.sha256(chunk).digest(), stop
                        parts.append(address)
                        if address not in sent:
                            if len(sent) >= SENT:
                                sent.clear()
                            sent.add(address)
                            add("chunk", address, None, None, None, None, chunk)
                    root = merkle_root(parts)
                    add("recipe", root, i, len(ids), parts, root, None)
                doc = pa.array(rows.pop("doc"), pa.int64())
                columns = {k: pa.array(v, t) for (k, v), t in zip(rows.items(), (pa.string(), pa.binary(), pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.binary()), strict=True)}
                order = ["kind", "key", "n_tokens", "parts", "root", "data"]
                arrays = [columns[c] for c in order]
                arrays.insert(2, ids_of.take(doc))
                order.insert(2, "doc_id")
                yield pa.RecordBatch.from_arrays(arrays, order)

    source = docs.select(F.col(doc_id).alias("doc_id"), as_bytes(F.col(text)).alias("text"))
    # recipes are dealt by document, chunks by address
    rows = source.mapInArrow(run, schema).withColumn("deal", F.when(F.col("kind") == "chunk", F.xxhash64("key")).otherwise(F.xxhash64("doc_id", "root")))
    repeated = F.lag("key").over(Window.partitionBy("deal").orderBy("kind", "key")) == F.col("key")
    once = rows.withColumn("again", F.coalesce(repeated, F.lit(False))).where((F.col("kind") == "recipe") | ~F.col("again"))
    once.drop("deal", "again").write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/objects")
    objects = f"{path}/objects"
    recipes = spark.read.schema(schema).parquet(objects).where("kind = 'recipe'").select("doc_id", "n_tokens", "parts", "root")
    ranges = recipes.repartitionByRange(partitions(spark), "doc_id", "root").sortWithinPartitions("doc_id", "root")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the number of the row in its range
    ranges.withColumns({"part": F.spark_partition_id(), "at": place}).write.parquet(f"{path}/recipes")
    totals = read_recipes(spark, path).groupBy("part").agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("n_tokens"))
    width = F.lit(np.dtype(encoder(vocabulary).kind).itemsize).alias("width")
    totals.join(range_roots(read_recipes(spark, path)), "part").select("part", "documents", "n_tokens", width, "root").write.parquet(f"{path}/manifest")
    return path


def range_roots(recipes: DataFrame) -> DataFrame:
    """``(part, root)``: the root of the Merkle tree over the recipes of each range, in the order of ``at``."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("="), F.hex("root"))
    level = recipes.select("part", "at", named.alias("node"))
    while True:  # once for the recipes, then as often as FAN goes into the largest range
        nodes = F.transform(F.array_sort(F.collect_list(F.struct("at", "node"))), lambda x: x["node"])
        joined = F.sha2(F.array_join(nodes, ","), 256)
        level = cut(level.groupBy("part", F.floor(F.col("at") / FAN).alias("at")).agg(joined.alias("node")))
        if level.where("at > 0").isEmpty():
            return level.select("part", F.col("node").alias("root"))


def read_recipes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/recipes")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key binary, data binary, kind string").parquet(f"{path}/objects").where("kind = 'chunk'").select("key", "data")


def verify_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Ranges whose recipes do not give the manifest's root (none if all is well)."""
    now = range_roots(read_recipes(spark, path)).withColumnRenamed("root", "found")
    return spark.read.parquet(f"{path}/manifest").join(now, "part", "full").where(~F.col("root").eqNullSafe(F.col("found")))


def id_kind(spark: SparkSession, path: str) -> str:
    row = spark.read.parquet(f"{path}/manifest").select(F.max("width").alias("width")).first()
    return f"<u{row['width'] or 2}"


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Recipes, checked against their roots and the manifest, with ``start``: the sum of
    the ranges before and of the documents before in the range."""
    if not (wrong := verify_manifest(spark, path)).isEmpty():
        raise ValueError(f"the recipes of {wrong.count()} ranges are not what the manifest says")

    wrong_root = F.raise_error(F.concat(F.lit("a recipe does not have the root "), F.hex("root")))
    checked = F.when(merkle_root_of(F.col("parts")) == F.col("root"), F.col("root")).otherwise(wrong_root.cast("binary"))
    rows = read_recipes(spark, path).withColumn("root", checked)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    parts = spark.read.parquet(f"{path}/manifest").select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(parts, "part").withColumn("start", F.col("offset") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).where("root is not null")


def _check(key: bytes, data: bytes) -> bytes:
    if hashlib.sha256(data).digest() != key:
        raise ValueError(f"chunk {key.hex()} does not hold what its address says")
    return data


# --- CRC-32 of a concatenation: polynomials over GF(2), bit 31 the constant term ---
_POLY = 0xEDB88320


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the CRC polynomial."""
    out, b = np.zeros_like(b), b.copy()
    for bit in range(31, -1, -1):
        out ^= np.where(a >> np.uint32(bit) & np.uint32(1), b, np.uint32(0))
        b = np.where(b & np.uint32(1), (b >> np.uint32(1)) ^ np.uint32(_POLY), b >> np.uint32(1))
    return out


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """What a CRC is multiplied by when n ids (of 4 bytes) follow, for n up to MOST."""
    out, step = np.empty(MOST + 1, np.uint32), np.array([1 << 31], np.uint32)
    by = np.array([1 << 30], np.uint32)  # x
    for _ in range(5):
        by = _times(by, by)  # x^32
    for n in range(MOST + 1):
        out[n] = step[0]
        step = _times(step, by)
    return out


def join_crcs(n: list[np.ndarray], crc: list[np.ndarray]) -> np.ndarray:
    """CRC of each document from its chunks' lengths (in ids) and CRCs."""
    out = np.zeros(len(n), np.uint32)
    sizes = np.array([len(x) for x in n])
    order = np.argsort(-sizes, kind="stable")
    for k in range(sizes.max(initial=0)):
        at = order[: np.searchsorted(-sizes[order], -k, side="left")]  # documents with more than k chunks
        lengths = np.array([n[i][k] for i in at])
        out[at] = _times(_shifts()[lengths], out[at]) ^ np.array([crc[i][k] for i in at], np.uint32)
    return out


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, n_chunks)`` from the files of a store."""
    kind = id_kind(spark, path)

    def chunk_digests(batches):
        for batch in batches:
            n, crc = [], []
            for key, data in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(_check(key.as_py(), data.as_py()), kind)
                n.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), pa.array(crc, pa.int64())], ["key", "n", "crc"])

    def document_digests(batches):
        for batch in batches:
            parts = batch.column(3)
            flat, edges = parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
            n, crc = (flat.field(x).to_numpy() for x in ("n", "crc"))
            each = list(zip(edges[:-1], edges[1:], strict=True))
            joined = join_crcs([n[a:b] for a, b in each], [crc[a:b].astype(np.uint32) for a, b in each])
            total = [int(n[a:b].sum()) for a, b in each]
            if total != batch.column(2).to_pylist():
                raise ValueError("chunks are missing from the store")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(joined.astype(np.int64)), pa.array([int(b - a) for a, b in each], pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32", "n_chunks"],
            )

    found = read_chunks(spark, path).mapInArrow(chunk_digests, "key binary, n int, crc long")
    placed = _placed(spark, path)
    parts = placed.select("doc_id", "start", "n_tokens", F.posexplode("parts").alias("pos", "key")).join(found, "key")
    whole = parts.groupBy("doc_id", "start", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("pos", "n", "crc"))).alias("parts"))
    doc = placed.schema["doc_id"].dataType.simpleString()
    return whole.mapInArrow(document_digests, f"doc_id {doc}, start long, n_tokens long, ids_crc32 long, n_chunks long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids array<int>)``, rebuilt and checked."""
    kind = id_kind(spark, path)

    def rebuild(batches):
        for batch in batches:
            ids = []
            for parts in batch.column(2):
                data = b"".join(_check(x["key"], x["data"]) for x in parts.as_py())
                ids.append(np.frombuffer(data, kind).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "start", "ids"])

    placed = _placed(spark, path)
    parts = placed.select("doc_id", "start", F.posexplode("parts").alias("pos", "key")).join(read_chunks(spark, path), "key")
    whole = parts.groupBy("doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("pos", "key", "data"))).alias("parts"))
    doc = placed.schema["doc_id"].dataType.simpleString()
    return whole.mapInArrow(rebuild, f"doc_id {doc}, start long, ids array<int>")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_store(read(spark, sf_dir, "documents"), fresh_path(spark, "token-store"))
    return read_digests(spark, path)
