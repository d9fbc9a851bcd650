import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seisloom.llm import bpe, token_store
from seisloom.llm.common import fresh_path

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")


def test_store_round_trip(spark, docs):
    library = tokenizers.Tokenizer.from_file(token_store.default_vocabulary())
    path = token_store.write_store(docs, fresh_path(spark, "store"))
    got = {(r.doc_id, r.start): r for r in token_store.read_digests(spark, path).collect()}
    ids = {(r.doc_id, r.start): r.ids for r in token_store.read_ids(spark, path).collect()}
    assert token_store.verify_manifest(spark, path).count() == 0
    rows = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in docs.collect())
    start = 0
    for doc_id, text in rows:
        want = [*library.encode(text, add_special_tokens=False).ids, token_store.END]
        row = got[doc_id if doc_id >= 0 else None, start]
        assert (row.n_tokens, row.ids_crc32) == (len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        assert ids[row.doc_id, start] == want
        start += len(want)
    assert len(got) == len(rows)
    keys = [r.key for r in token_store.read_chunks(spark, path).collect()]
    assert len(keys) == len(set(keys))


def test_damaged_chunk_is_found(spark):
    with pytest.raises(ValueError):
        token_store._check(hashlib.sha256(b"a").digest(), b"b")


def test_permuted_and_exchanged_recipes_are_found(spark, docs):
    def changed(how):
        path = token_store.write_store(docs, fresh_path(spark, "store"))
        rows = spark.createDataFrame(token_store.read_recipes(spark, path).collect(), token_store.read_recipes(spark, path).schema)
        how(rows).write.mode("overwrite").parquet(f"{path}/recipes")
        return path

    with pytest.raises(Exception, match="does not have the root"):  # the chunks of each document backwards
        token_store.read_digests(spark, changed(lambda r: r.withColumn("parts", F.reverse("parts")))).collect()
    with pytest.raises(ValueError, match="not what the manifest says"):  # a document gone, another's ids in its place
        token_store.read_digests(spark, changed(lambda r: r.where("doc_id <> 1").unionByName(r.where("doc_id = 7").withColumn("doc_id", F.lit(1).cast("long"))))).collect()


def test_roots_of_documents(spark, monkeypatch):
    monkeypatch.setattr(token_store, "FAN", 3)
    rows = [(n, [bytes([i]) * 4 for i in range(n)]) for n in (1, 2, 3, 4, 9, 10, 27)]
    df = spark.createDataFrame(rows, "n int, parts array<binary>")
    got = {r.n: bytes(r.root) for r in df.select("n", token_store.merkle_root_of(F.col("parts")).alias("root")).collect()}
    assert got == {n: token_store.merkle_root(parts) for n, parts in rows} and len(set(got.values())) == len(rows)


def test_tree_of_many_recipes(spark, monkeypatch):
    monkeypatch.setattr(token_store, "FAN", 3)
    rows = spark.range(100).selectExpr("id AS doc_id", "cast(cast(id AS string) AS binary) AS root", "cast(id >= 90 AS int) AS part", "if(id >= 90, id - 90, id) AS at")
    got = {r.part: r.root for r in token_store.range_roots(rows).collect()}
    for part, ids in ((0, sorted(range(90))), (1, range(90, 100))):
        level = [f"{i}={str(i).encode().hex().upper()}" for i in ids]
        for _ in range(5):  # as deep as the larger range
            level = [hashlib.sha256(",".join(level[i : i + 3]).encode()).hexdigest() for i in range(0, len(level), 3)]
        assert got[part] == level[0]


@pytest.mark.parametrize("words,cased", [(300, True), (70_000, True), (300, False)])
def test_other_vocabularies(spark, docs, tmp_path, words, cased):
    """A cased one is not lower-cased, and more than 65,536 ids take four bytes."""
    named = [f"W{i}" if cased else f"w{i}" for i in range(words)]
    text = " ".join(named[:: max(1, words // 500)]) + " Other " + named[-1]
    model = tokenizers.models.WordLevel({w: i + 2 for i, w in enumerate(["[UNK]", *named])}, unk_token="[UNK]")
    made = tokenizers.Tokenizer(model)
    made.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
    if not cased:
        made.normalizer = tokenizers.normalizers.Lowercase()
    file = str(tmp_path / "vocabulary.json")
    made.save(file)
    path = token_store.write_store(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), fresh_path(spark, "store"), file)
    got = {r.doc_id: r.ids for r in token_store.read_ids(spark, path).collect()}
    assert got == {1: [*made.encode(text).ids, token_store.END], 2: [token_store.END]}
    digest = {r.doc_id: r.ids_crc32 for r in token_store.read_digests(spark, path).collect()}
    assert digest[1] == zlib.crc32(np.array(got[1], "<u4").tobytes())


def test_empty_store(spark, empty):
    path = token_store.write_store(empty, fresh_path(spark, "store"))
    assert token_store.read_digests(spark, path).count() == 0


def test_cuts_follow_content():
    draw = np.random.default_rng(1)
    passage = draw.integers(0, 49_000, 6000).astype(np.uint16)
    chunks = []
    for n in (0, 700):
        ids = np.concatenate([draw.integers(0, 49_000, n).astype(np.uint16), passage])
        ends = token_store.cuts(ids)
        assert ends[-1] == len(ids) and all(b > a for a, b in zip(ends, ends[1:], strict=False))
        assert max(np.diff([0, *ends])) <= token_store.MOST
        chunks.append({ids[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)})
    assert len(chunks[0] & chunks[1]) > 0.7 * len(chunks[0])
    assert token_store.cuts(np.zeros(0, np.uint16)) == []


def test_words_encoder_is_the_library():
    library = tokenizers.Tokenizer.from_file(token_store.default_vocabulary())
    words = token_store.WordEncoder(token_store.default_vocabulary())
    draw = random.Random(3)
    parts = ["the", "The,", "don't", "\x01", "a\x01b", "<|endoftext|>", "x<|startoftext|>y", "é", "e\u0301", "\u0301", "ΣΑΣ", "İ", "12", "\t", "\n", "\r", "\u00a0", "\u2003", "\x1c", "\x85", "日本", "🙂", "'s", "\x0b", "  "]
    texts = ["".join(draw.choice([*parts, " "]) for _ in range(draw.randrange(40))) for _ in range(400)]
    for text, data in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(data, words.kind).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_bpe_is_the_library(spark, docs, empty):
    e = bpe.encoding(bpe.default_ranks())
    out = {(r.doc_id, r.ids_sha256): r for r in bpe.digests(docs).collect()}
    for r in docs.collect():
        text = r.text or ""
        want = e.encode_ordinary(text)
        row = out[r.doc_id, hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()]
        assert row.n_tokens == len(want) and row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = bpe.decode_documents(bpe.encode_documents(docs)).collect()
    assert sorted(bytes(r.bytes) for r in back) == sorted((r.text or "").encode() for r in docs.collect())
    assert bpe.digests(empty).count() == 0


def test_bpe_matches_of_the_pattern_apart():
    import regex

    text = "Don't  stop\n\n 12ab  é\u2003x's "
    e = bpe.encoding(bpe.default_ranks())
    apart = [i for m in regex.findall(bpe.PATTERN, text) for i in e.encode_ordinary(m)]
    assert apart == bpe.encode(text, bpe.default_ranks())


def test_pieces_are_safe():
    draw = random.Random(5)
    for _ in range(300):
        text = "".join(draw.choice([" ", "  ", "\n", "\t", "a", "bc", "'s", "1", "!", "é", "\u2003"]) for _ in range(200))
        cut = list(bpe.pieces(text, draw.randrange(1, 40)))
        assert "".join(cut) == text
        assert [i for p in cut for i in bpe.encoding(bpe.default_ranks()).encode_ordinary(p)] == bpe.encoding(bpe.default_ranks()).encode_ordinary(text)
    assert list(bpe.pieces("")) == [""] and re.sub(r"\S", "", "".join(bpe.pieces("a" * 200_000))) == ""


def test_long_runs_of_white_space():
    ranks = bpe.default_ranks()
    e, draw = bpe.encoding(ranks), random.Random(7)
    for _ in range(100):  # as the library has it where it can
        text = "".join(draw.choice(["a", "bc'll", "9", ".", " ", "\n", "\t", "\x85", "\x1c", "\x0b"]) * draw.choice([1, 1, 2, 900, 1100, 1500]) for _ in range(8))
        assert bpe.encode(text, ranks) == e.encode_ordinary(text)
    space, line = e.encode_ordinary(" "), e.encode_ordinary("\n")
    assert bpe.encode(" " * 1500, ranks) == e.encode_ordinary(" " * 1500)
    n = 5_000_000  # what the library gives for short runs goes on: merges of equal characters repeat
    for unit, one in ((" ", space), ("\n", line)):
        period = 1 << 10
        short = e.encode_ordinary(unit * period)
        whole = bpe.encode(unit * (period * (n // period)), ranks)
        assert whole == short * (n // period), unit
        assert bpe.encode("x" + unit * n + "y", ranks)[:1] == e.encode_ordinary("x") and one
    for text in ("\t \n" * 1_000_000 + "x", "\u3000" * 1_000_000, "a" * n):
        assert e.decode_bytes(bpe.encode(text, ranks)) == text.encode()


def test_digests_carry_columns(docs):
    out = bpe.digests(docs, carry=("source", "words"))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "source", "words"]
    assert sorted(map(str, (r.source for r in out.collect()))) == sorted(map(str, (r.source for r in docs.collect())))
