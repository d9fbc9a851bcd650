import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisloom.llm import suffixes
from seisloom.llm.common import read


def _by_hand(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    texts = [(t or "").encode() if not isinstance(t, bytes) else t for t in texts]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return out


def _texts(seed, count, length):
    rnd = random.Random(seed)
    words = ["the", "a", "river", "Über", "naïve", "stone", "of", "light", "and", "runs", "到", "x"]
    prose = lambda n: " ".join(rnd.choice(words) + str(rnd.randrange(50)) for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    line = prose(10)[: length - 5]
    out = [None, "", "short", "ab" * length, "=" * (3 * length), "=" * length, shared[0], shared[0]]
    for _ in range(count):
        t = prose(rnd.randrange(1, 120))
        for _ in range(rnd.randrange(4)):
            part = rnd.choice(shared)
            a = rnd.randrange(len(part) // 2)
            part = part[a : a + rnd.randrange(20, 400)]
            if rnd.random() < 0.4:
                k = rnd.randrange(len(part))
                part = part[:k] + "#" + part[k + 1 :]
            at = rnd.randrange(len(t) + 1)
            t = t[:at] + part + t[at:]
        out.append(t + "\n" + line if rnd.random() < 0.5 else t)
    return out + out[20:24]


@pytest.mark.parametrize(("length", "grams", "most"), [(200, (48, 120, 200), 1 << 13), (60, (16, 40, 60), 5), (24, (6, 24), 2)])
def test_against_all_windows(spark, length, grams, most):
    texts = _texts(length, 150, length)
    rows = [(i if i % 7 else None, t, "x", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, number long").repartition(3)
    out = suffixes.remove_repeats(docs, length=length, grams=grams, most=most)
    got = {r["number"]: (r["n"], r["n"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in out.withColumn("n", F.coalesce(F.octet_length("text"), F.lit(0))).collect()}
    assert got == dict(enumerate(_by_hand(texts, length)))


def test_long_texts_in_pieces(spark, monkeypatch):
    rnd = random.Random(3)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(700))
    long = "".join(rnd.choice("ijklmnop ") for _ in range(suffixes.PIECE - 300)) + passage + "".join(rnd.choice("qrstuvw ") for _ in range(9000))
    docs = spark.createDataFrame([(1, long), (2, "x" + passage[:650] + "y")], "doc_id long, text string")
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in suffixes.remove_repeats(docs).collect()}
    at = suffixes.PIECE - 300
    assert spans == {1: [(at, at + 650)], 2: [(1, 651)]}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(docs).count() == 0


def test_query_on_a_table(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents").collect()
    out = {r["doc_id"]: r for r in suffixes.op11_suffix_dedup(spark, "/root/testdata/sf0.001").collect()}
    want = _by_hand([r["text"] for r in docs], 200)
    assert {k: tuple(r)[1:] for k, r in out.items()} == {r["doc_id"]: w for r, w in zip(docs, want, strict=True)}


def test_sorted_suffixes_and_collisions(monkeypatch):
    rnd = random.Random(5)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(1, 30))) for _ in range(200)]
    group = np.sort(np.array([rnd.randrange(9) for _ in texts]))
    size = np.array([len(t) for t in texts])
    start = np.cumsum(size) - size
    offset = np.array([rnd.randrange(n) for n in size])
    text = np.frombuffer(b"".join(texts), np.uint8)
    of = lambda: suffixes.Suffixes(text, start, start + offset, size - offset)
    keys = [(g, t[o:]) for g, t, o in zip(group, texts, offset, strict=True)]
    order, extension = of().sorted(group)
    assert [keys[i] for i in order] == sorted(keys)
    again = of()._by_bytes(group)
    assert np.array_equal(again[1], extension) and [keys[i] for i in again[0]] == sorted(keys)
    # hashes that tell nothing: the bytes settle it
    monkeypatch.setattr(suffixes.Suffixes, "_hash", lambda self, i, n: np.zeros(len(i)))
    order, extension_ = of().sorted(group)
    assert [keys[i] for i in order] == sorted(keys) and np.array_equal(extension_, extension)
