"""Suffix-array dedup with hash-compared suffixes (operator 11).

Every byte that a string of ``LENGTH`` bytes covers goes, if this string also starts
anywhere else in the corpus. Texts are UTF-8 bytes; strings do not cross documents.

A suffix array of all bytes has equal strings as neighbours with a common extension of
``LENGTH`` or more. Here it is a sparse one. Each window of ``LENGTH`` bytes has an anchor, its
gram of ``grams[0]`` bytes with the least polynomial hash; equal windows have equal anchors at
the same place. Windows that follow each other and share an anchor make a segment, some 60 bytes
further than the last, and the corpus is sorted by the grams of its anchors:

* a gram that stands once repeats nowhere, nor do its windows;
* equal segments (same gram, and same digest of all their bytes) repeat with all their windows;
* for grams with different segments, each distinct segment's text is fetched once, and the suffixes
  that start at the anchors are sorted, and the prefixes that end there likewise (reversed): a mergesort
  whose comparisons find the common extension by binary search over prefix polynomial hashes and
  then compare one byte. A window repeats if another suffix shares its right part and the same
  one's prefix its left part: both are runs of neighbours whose common extensions are long enough.
  The bytes of neighbours are compared, so that a collision is found; the group is then sorted by its bytes.

Scale: one small row for a segment is counted by its gram, combined before the shuffle, and joined
back as a plain join that Spark splits for hot grams. Texts are shuffled twice, for the
contexts and for the removal; equal texts of a task are cut up once. Grams with more than
``most`` distinct segments, which one task should not sort, are cut again by longer grams,
at last by whole windows, where equal windows are equal segments and counted like those. A
task holds a batch of texts, pieces of ``PIECE`` bytes with their hashes, or ``most`` segments.

Cases: null text is empty; repeated rows are documents, so their bytes go (of texts of ``LENGTH`` bytes or
more); texts are told apart by 128 bits of hash, ids may be null or repeat; what is left of a text may not be
UTF-8, so it is returned as bytes; empty input gives empty output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, fresh_path, partitions, read, unused

LENGTH, GRAMS, MOST = 200, (48, 120, 200), 1 << 13
PIECE = 1 << 20  # bytes hashed at a time
SEEN = 1 << 20  # texts that a task remembers
SORTED = 1 << 14  # segments sorted at a time, but for a larger group
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
PLACE = np.uint64((1 << 22) - 1)
SECOND = 11  # hashed before a text for its second hash


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    out = []
    for base in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segments(text: np.ndarray, stops: np.ndarray, gram: int, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of texts that stand one after another, each ending at one of ``stops``: start, number of windows and
    place of the anchor of each segment, hash of its gram and number of its text."""
    n, wide = len(text), length - gram + 1
    windows = n - length + 1
    if windows <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    power, inverse = (x[: n + 1] for x in _powers(max(n + 1, PIECE + 2 * length)))
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power[:n], out=prefix[1:])
    hashes = _mixed((prefix[gram:] - prefix[: n - gram + 1]) * inverse[: n - gram + 1])
    # least of the grams of each window, the first of equal ones: of the rest of a block and of the beginning of the next
    keys = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    rows = np.append(keys, np.full(-len(keys) % wide + wide, np.uint64(2**64 - 1))).reshape(-1, wide)
    begun = np.minimum.accumulate(rows, axis=1).ravel()
    rest = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(rest[:windows], begun[wide - 1 : wide - 1 + windows]) & PLACE).astype(np.int64)
    owner = np.repeat(np.arange(len(stops)), np.diff(stops, prepend=0))[:windows]
    inside = stops[owner] - np.arange(windows) >= length
    change = np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1]))
    first = np.flatnonzero(change)
    run = np.diff(np.append(first, windows))
    first, run = first[inside[first]], run[inside[first]]
    at = anchor[first]
    return first, run, at, hashes[at].view(np.int64), owner[first]


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts, long ones in pieces that overlap, about ``PIECE`` bytes at a time: their numbers, starts and bytes."""
    held, size = ([], [], []), 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - length + 1), PIECE):
            part = t[a : a + PIECE + length - 1]
            if size + len(part) > PIECE and size:
                yield held
                held, size = ([], [], []), 0
            for column, x in zip(held, (i, a, part), strict=True):
                column.append(x)
            size += len(part)
    if size:
        yield held


def cut_up(texts: list[bytes], gram: int, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """Text number, start, windows, offset of the anchor, gram and digest of the segments of texts."""
    from xxhash import xxh3_64_intdigest

    for number, start, parts in _pieces(texts, length):
        joined = b"".join(parts)
        first, run, anchor, hashes, owner = segments(np.frombuffer(joined, np.uint8), np.cumsum([len(p) for p in parts]), gram, length)
        offset = np.cumsum([0, *map(len, parts)])[owner]
        stops = (first + run + length - 1).tolist()
        digest = np.fromiter((xxh3_64_intdigest(joined[a:b]) for a, b in zip(first.tolist(), stops, strict=True)), np.uint64, len(first))
        digest ^= _mixed((anchor - first).astype(np.uint64))  # equal segments have equal anchors
        yield np.array(number, np.int64)[owner], first - offset + np.array(start, np.int64)[owner], run, anchor - first, hashes, digest.view(np.int64)


class Suffixes:
    """Suffixes of short texts that stand one after another, compared by prefix hashes."""

    def __init__(self, text: np.ndarray, start: np.ndarray, at: np.ndarray, left: np.ndarray):
        """Suffix i starts at ``at[i]``, ``left[i]`` bytes from its end, in the text from ``start[i]``."""
        self.text, self.at, self.left, self.rel = text, at, left, at - start
        size = np.diff(np.append(start, len(text)))
        rel = np.arange(len(text)) - np.repeat(start, size)
        power, inverse = _powers(int(size.max(initial=0)) + 2)
        self.prefix = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power[rel], out=self.prefix[1:])
        self.inverse = inverse[self.rel]

    def _hash(self, i: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.prefix[self.at[i] + n] - self.prefix[self.at[i]]) * self.inverse[i]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes i and j."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.left[i], self.left[j])
        while (low < high).any():
            mid = (low + high + 1) >> 1
            equal = self._hash(i, mid) == self._hash(j, mid)
            low, high = np.where(equal, mid, low), np.where(equal, high, np.minimum(high, mid - 1))
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n = self.common(i, j)
        on_i, on_j = n < self.left[i], n < self.left[j]
        last = len(self.text) - 1
        return np.where(on_i & on_j, self.text[np.minimum(self.at[i] + n, last)] < self.text[np.minimum(self.at[j] + n, last)], on_j & ~on_i)

    def sorted(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes within groups of equal, neighbouring ``group``, and each one's
        common extension with the one before it (-1 for the first of a group)."""
        n = len(group)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.zeros(0, np.int64)
        size = np.diff(np.append(first, n))
        begin, end = np.repeat(first, size), np.repeat(first + size, size)
        order, width = np.arange(n), 1
        while width < size.max(initial=0):
            slot = np.flatnonzero(end - begin > width)
            run = (slot - begin[slot]) // width
            a = begin[slot] + (run ^ 1) * width  # the run that it is merged with
            b = np.minimum(a + width, end[slot])
            on = a < end[slot]
            slot, run, a, b = slot[on], run[on], a[on], b[on]
            low, high, second = a.copy(), b.copy(), (run & 1).astype(bool)
            while (open_ := np.flatnonzero(low < high)).size:
                mid = (low[open_] + high[open_]) >> 1
                mine, other = order[slot[open_]], order[mid]
                flip = second[open_]  # of equals those of the first run come first
                less = self.less(np.where(flip, mine, other), np.where(flip, other, mine))
                before = less ^ flip
                low[open_], high[open_] = np.where(before, mid + 1, low[open_]), np.where(before, high[open_], mid)
            place = begin[slot] + (run & ~1) * width + (slot - begin[slot]) % width + (low - a)
            moved = order.copy()
            moved[place] = order[slot]
            order, width = moved, 2 * width
        extension = np.full(n, -1)
        inner = np.setdiff1d(np.arange(n), first, assume_unique=True)
        extension[inner] = self.common(order[inner - 1], order[inner])
        if not self._verified(order, inner, extension[inner]):
            return self._by_bytes(group)
        return order, extension

    def _verified(self, order: np.ndarray, inner: np.ndarray, n: np.ndarray) -> bool:
        a, b = self.at[order[inner - 1]], self.at[order[inner]]
        for k in range(int(n.max(initial=0))):
            on = n > k
            if not (self.text[a[on] + k] == self.text[b[on] + k]).all():
                return False
        return True

    def _by_bytes(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        suffix = [self.text[a : a + n].tobytes() for a, n in zip(self.at, self.left, strict=True)]
        number = np.cumsum(np.append(0, group[1:] != group[:-1])).tolist()
        order = sorted(range(len(suffix)), key=lambda i: (number[i], suffix[i]))
        extension = [-1]
        for i, j in zip(order, order[1:], strict=False):
            x, y = suffix[i], suffix[j]
            n = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            extension.append(n if number[i] == number[j] else -1)
        return np.array(order), np.array(extension[: len(order)])


def repeated_windows(texts: list[bytes], group: np.ndarray, offset: np.ndarray, run: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For segments in neighbouring groups of one gram: (segment, window) of each window that is in another segment of its group, too."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    stop = np.cumsum(size)
    joined = b"".join(texts)
    text = np.frombuffer(joined, np.uint8)
    anchor = stop - size + offset
    orders = []
    for t, start, at, left in (
        (text, stop - size, anchor, size - offset),
        (text[::-1], len(text) - stop[::-1], (len(text) - anchor)[::-1], offset[::-1]),
    ):
        at_last = np.minimum(at, len(text))
        flipped = t is not text
        order, extension = Suffixes(t, start, at_last, left).sorted(group[::-1] if flipped else group)
        order = len(texts) - 1 - order if flipped else order
        best = np.maximum(extension, np.append(extension[1:], -1))
        most = np.empty(len(order), np.int64)
        most[order] = best
        orders.append((order, extension, most))
    (right, right_on, right_most), (left, left_on, left_most) = orders
    hope = right_most + left_most >= length
    marks = []
    low, high = np.maximum(offset - run + 1, length - right_most)[hope], np.minimum(offset, left_most)[hope]
    for o in range(int(low.min(initial=length)), int(high.max(initial=-1)) + 1):
        part = np.flatnonzero(hope)[(low <= o) & (o <= high)]
        if len(part) < 2:
            continue
        of_right, of_left = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
        of_right[right], of_left[left] = np.cumsum(right_on < length - o), np.cumsum(left_on < o)
        key = of_right[part] * (len(texts) + 1) + of_left[part]
        by = np.argsort(key, kind="stable")
        equal = key[by][1:] == key[by][:-1]
        twice = part[by[np.append(equal, False) | np.append(False, equal)]]
        marks.append(np.stack([twice, offset[twice] - o], 1))
    return np.concatenate(marks) if marks else np.zeros((0, 2), np.int64)


def _runs(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first window, windows) of neighbouring windows."""
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    new = np.flatnonzero(np.append(True, (np.diff(pairs[:, 0]) != 0) | (np.diff(pairs[:, 1]) != 1))) if len(pairs) else np.zeros(0, np.int64)
    return pairs[new, 0], pairs[new, 1], np.diff(np.append(new, len(pairs)))


CUT = "number long, base long, a long, b long, at long, run int, off int, gram long, seg long, n long"


def _cut_task(gram: int, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (a, b, text) and maybe (number, base, n): segments, and for new texts a row without a gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        count, seen = TaskContext.get().partitionId() << 33, set()
        for batch in batches:
            a, b = (batch.column(k).to_numpy() for k in (0, 1))
            size = np.diff(np.frombuffer(batch.column(2).buffers()[1], np.int32, batch.num_rows + 1, batch.column(2).offset * 4))
            rows = np.flatnonzero(size >= length)
            if batch.num_columns > 3:
                number, base, n = (batch.column(k).to_numpy() for k in (3, 4, 5))
            else:
                fresh = []
                for i, key in zip(rows.tolist(), zip(a[rows].tolist(), b[rows].tolist(), strict=True), strict=True):
                    if key not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(key)
                        fresh.append(i)
                rows = np.array(fresh, np.int64)
                number, base, n = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), np.ones(batch.num_rows, np.int64)
                number[rows] = count + np.arange(len(rows))
                count += len(rows)
                none = pa.nulls(len(rows), pa.int64())
                small = pa.nulls(len(rows), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(number[rows]), pa.array(base[rows]), pa.array(a[rows]), pa.array(b[rows]), none, small, small, none, none, none], names)
            texts = batch.column(2)
            for i, at, windows, off, grams, seg in cut_up([texts[k].as_py() for k in rows.tolist()], gram, length):
                i = rows[i]
                columns = [number[i], base[i], None, None, at + base[i], windows.astype(np.int32), off.astype(np.int32), grams, seg, n[i]]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(i), pa.int64()) if c is None else pa.array(c) for c in columns], names)

    names = [c.split()[0] for c in CUT.split(", ")]
    return run


def _sort_task(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From segments (gram, number, at, run, off, n, text) in the order of their grams: repeated runs of windows (number, at, run)."""

    def settled(rows: list[np.ndarray], texts: list[bytes]) -> pa.RecordBatch:
        gram, number, at, run, off, n = rows
        which, first, windows = _runs(repeated_windows(texts, gram, off, run, length))
        new = n[which] == 1  # others are known to repeat
        which, first, windows = which[new], first[new], windows[new]
        return pa.RecordBatch.from_arrays([pa.array(number[which]), pa.array(at[which] + first), pa.array(windows.astype(np.int32))], ["number", "at", "run"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = [np.zeros(0, np.int64)] * 6, []
        for batch in batches:
            held = [np.concatenate([x, batch.column(k).to_numpy().astype(np.int64)]) for k, x in enumerate(held)]
            texts += batch.column(6).to_pylist()
            while len(texts) >= SORTED:
                whole = int(np.searchsorted(held[0], held[0][SORTED - 1]))  # its group may go on
                whole = whole or int(np.searchsorted(held[0], held[0][0], side="right"))
                if whole == len(texts):
                    break
                yield settled([x[:whole] for x in held], texts[:whole])
                held, texts = [x[whole:] for x in held], texts[whole:]
        if texts:
            yield settled(held, texts)

    return task


def repeated_runs(docs: DataFrame, text: str = "text", length: int = LENGTH, grams: tuple[int, ...] = GRAMS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """``(number, at, run)``: that the windows from ``at`` on repeat, ``run`` of them, maybe more than once; and
    ``(number, a, b)``: which texts, by hash, the numbers are. ``grams`` ends with ``length``."""
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "suffixes")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    texts = hashed_texts(docs, text)
    cut_rows = stored(texts.mapInArrow(_cut_task(grams[0], length), CUT), "cut-0")
    numbers = cut_rows.where("gram is null").select("number", "a", "b")
    source = numbers.select("number", F.lit(0).cast("long").alias("base"), "a", "b").join(texts.dropDuplicates(["a", "b"]), ["a", "b"])
    found = []
    for level, gram in enumerate(grams):
        rows = cut_rows.where("gram is not null").select("number", "base", "at", "run", "off", "gram", "seg", "n")
        twice = rows.groupBy("gram").agg(F.sum("n").alias("all"), F.min("seg").alias("least"), F.max("seg").alias("largest")).where(F.col("all") >= 2)
        # stored, so that the join has plain sides and Spark can split a hot gram
        twice = stored(twice.select("gram", (F.col("least") == F.col("largest")).cast("int").alias("same")), f"twice-{level}")
        hits = rows.join(twice, "gram")
        hits.write.partitionBy("same").option("compression", "zstd").parquet(f"{path}/hits-{level}")
        hits = spark.read.schema(hits.schema).parquet(f"{path}/hits-{level}")
        found.append(hits.where("same = 1").select("number", "at", "run"))
        mixed = hits.where("same = 0")
        segs = stored(
            mixed.groupBy("gram", "seg").agg(F.sum("n").alias("n"), F.min(F.struct("number", "base", "at", "run", "off")).alias("rep")), f"segments-{level}"
        )
        found.append(mixed.join(segs.where("n >= 2").select("gram", "seg"), ["gram", "seg"], "left_semi").select("number", "at", "run"))
        open_ = segs.groupBy("gram").agg(F.count("*").alias("size"), F.min("n").alias("least")).where((F.col("least") == 1) & (F.col("size") > 1))
        if gram == length:
            break
        open_ = stored(open_.select("gram", (F.col("size") > most).alias("hot")), f"open-{level}")
        wanted = segs.join(open_, "gram").select("gram", "n", "hot", "rep.*")
        part = F.substring("text", (F.col("at") - F.col("base") + 1).cast("int"), F.col("run") + length - 1)
        contexts = stored(wanted.join(source, ["number", "base"]).select("gram", "number", "at", "run", "off", "n", "hot", part.alias("text")), f"contexts-{level}")
        cold = contexts.where(~F.col("hot")).select("gram", "number", "at", "run", "off", "n", "text").repartition("gram").sortWithinPartitions("gram")
        found.append(stored(cold.mapInArrow(_sort_task(length), "number long, at long, run int"), f"sorted-{level}"))
        hot = contexts.where("hot")
        if hot.isEmpty():
            break
        none = F.lit(0).cast("long")
        pieces = hot.select(none.alias("a"), none.alias("b"), "text", "number", F.col("at").alias("base"), "n")
        cut_rows = stored(pieces.repartition(partitions(spark)).mapInArrow(_cut_task(grams[level + 1], length), CUT), f"cut-{level + 1}")
        source = hot.select("number", F.col("at").alias("base"), "text")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out, numbers


def hashed_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(a, b, text binary)``: the bytes of each row's text and 128 bits of hash."""
    rows = docs.select(as_bytes(F.col(text)).alias("text"))
    return rows.select(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(SECOND), "text").alias("b"), "text")


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, grams: tuple[int, ...] = GRAMS, most: int = MOST) -> DataFrame:
    """``docs`` with two more columns, which replace any of these names: ``kept``, the bytes of ``text`` that stay, and ``spans``
    (array of structs ``start``, ``stop``), the maximal runs of bytes that go."""
    runs, numbers = repeated_runs(docs, text, length, grams, most)
    spans = runs.groupBy("number").agg(F.collect_list(F.struct("at", "run")).alias("runs")).join(numbers, "number").groupBy("a", "b").agg(F.first("runs").alias("runs"))
    copies = hashed_texts(docs, text).groupBy("a", "b").agg((F.count("*") > 1).alias("again")).where("again")
    a, b, t, again, found = (unused(docs, x) for x in ("a_", "b_", "bytes_", "again_", "runs_"))
    marks = spans.join(copies, ["a", "b"], "full").select(F.col("a").alias(a), F.col("b").alias(b), F.coalesce("again", F.lit(False)).alias(again), F.col("runs").alias(found))
    rest = [c for c in docs.columns if c.lower() not in ("kept", "spans")]
    rows = docs.select(*(F.col(f"`{c}`") for c in rest), as_bytes(F.col(text)).alias(t))
    rows = rows.withColumns({a: F.xxhash64(t), b: F.xxhash64(F.lit(SECOND), t)}).join(marks, [a, b], "left")
    merged = F.when(F.coalesce(F.col(again), F.lit(False)) & (F.octet_length(t) >= length), F.array(F.struct(F.lit(0).cast("long").alias("at"), (F.octet_length(t) - length + 1).alias("run")))).otherwise(F.col(found))
    rows = rows.withColumn(found, merged)
    kept, cut_out = unused(rows, "kept_"), unused(rows, "spans_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, gone = [], []
            for data, marked in zip(batch.column(len(rest)), batch.column(len(rest) + 1), strict=True):
                data, out, at, of = data.as_py(), [], 0, []
                for x in sorted((x["at"], x["at"] + x["run"] + length - 1) for x in marked.as_py() or ()):
                    if of and x[0] <= of[-1][1]:
                        of[-1][1] = max(of[-1][1], x[1])
                    else:
                        of.append(list(x))
                for start, stop in of:
                    out.append(data[at:start])
                    at = stop
                left.append(b"".join([*out, data[at:]]))
                gone.append([{"start": x, "stop": y} for x, y in of])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(left, pa.binary()), pa.array(gone, kind)], [*rest, kept, cut_out])

    shape = rows.select(*(F.col(f"`{c}`") for c in rest), t, found)
    schema = docs.select(*(F.col(f"`{c}`") for c in rest)).schema.add(kept, T.BinaryType()).add(cut_out, T.ArrayType(T.StructType().add("start", "long").add("stop", "long")))
    return shape.mapInArrow(run, schema).withColumnsRenamed({kept: "kept", cut_out: "spans"})


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select(
        "doc_id", n.alias("n_bytes"), (n - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
