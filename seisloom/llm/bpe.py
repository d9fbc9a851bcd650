"""Byte-level BPE encoding and decoding with tiktoken (operator 6).

The rank file is a local file of every machine (its path is a parameter). Texts
are encoded whole: a text over ``PIECE`` characters is cut before a white-space
character that follows another character, where no match of the pattern can
reach across, so the pieces' ids joined are those of the whole text. A run of
``RUN`` white-space characters and more, for which the pattern's engine would need
memory as its length, is found here: one match of the pattern is the run without its last
character, or all of it at the end of the text, and goes to the merges as it is. Ids decode
to raw bytes, which need not be whole characters.

Scale: one pass without a shuffle; a task holds an Arrow batch and the ids of one text.

Cases: null text is the empty text and gives no ids; a text without white space
is one piece however long, and a run of white space one match; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, read

PIECE, RUN = 1 << 16, 1 << 10
#: A fixed value: the pre-splitting pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_EDGE = re.compile(r"(?<=\S)[ \n]")
#: A fixed value: the characters of Unicode's property White_Space, as ``\s`` of the pattern has them.
_SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_RUN = re.compile(f"(?<![{_SPACE}])[{_SPACE}]{{{RUN},}}")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str = PATTERN):
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    start = 0
    while len(text) - start > size and (cut := _EDGE.search(text, start + size)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode(text: str, ranks: str, size: int = PIECE) -> list[int]:
    e, ids, start = encoding(ranks), [], 0
    for run in _LONG_RUN.finditer(text) if len(text) >= RUN else ():
        stop = run.end() if run.end() == len(text) else run.end() - 1
        for p in pieces(text[start : run.start()], size):
            ids += e.encode_ordinary(p)
        ids += e._encode_single_piece(text[run.start() : stop])
        start = stop
    for p in pieces(text[start:] if start else text, size):
        ids += e.encode_ordinary(p)
    return ids


def encode_documents(docs: DataFrame, ranks: str | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, ids array<int>)`` of every document."""
    ranks = ranks or default_ranks()

    def run(batches):
        for batch in batches:
            ids = [encode(t.as_py().decode(), ranks) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), as_bytes(F.col(text)).alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(ids: DataFrame, ranks: str | None = None) -> DataFrame:
    """``(doc_id, bytes binary)`` of ``ids(doc_id, ids)``; null ids give no bytes."""
    ranks = ranks or default_ranks()

    def run(batches):
        e = encoding(ranks)
        for batch in batches:
            out = [e.decode_bytes(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    kind = ids.schema["doc_id"].dataType.simpleString()
    return ids.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")


def digests(docs: DataFrame, ranks: str | None = None, text: str = "text", doc_id: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Encode and decode in one pass, and keep digests of both, and the columns ``carry`` after them."""
    ranks = ranks or default_ranks()

    def run(batches):
        e = encoding(ranks)
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for t in batch.column(1):
                ids = encode(t.as_py().decode(), ranks)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(e.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string()), *batch.columns[2:]],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *carry],
            )

    kinds = [docs.schema[c].dataType.simpleString() for c in (doc_id, *carry)]
    rows = docs.select(F.col(doc_id).alias("doc_id"), as_bytes(F.col(text)).alias("text"), *[F.col(f"`{c}`") for c in carry])
    more = "".join(f", `{c}` {kind}" for c, kind in zip(carry, kinds[1:], strict=True))
    return rows.mapInArrow(run, f"doc_id {kinds[0]}, n_tokens long, ids_sha256 string, decoded_sha256 string" + more)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))
