"""Media columns: a Spark data source over archives of images (operator 9).

A payload (the UTF-8 bytes of a text, padded with zeros to a multiple of 64) is
stored losslessly as an 8-bit grey PNG of 64 samples a row. Images are members of
ZIP archives in one directory; data source ``media_archive`` writes and reads it:

* write: a task streams its rows into an archive of its own name; the driver
  commits a manifest of the archives of the tasks that counted, so what a lost or
  repeated task leaves behind is never read. Each write adds a manifest of its own;
  with mode ``overwrite`` those before go, and their archives. A write that fails removes its archives;
* read: the driver plans byte ranges over the archives of all manifests by their sizes alone. A task
  takes the members whose headers start in its range, from the archive's own index,
  streams them through one handle in Arrow batches of bounded bytes, and retries a member that cannot
  be read from its offset on a new handle, independently of the others.

Files are opened with ``pyarrow.fs`` by URI (local, HDFS or object stores); inputs are read by Spark.

Scale: two passes without a shuffle; a task holds a batch of ``BATCH`` bytes, or one member if that is larger.

Cases: null text is the empty text, stored as 64 zeros; equal texts give equal
bytes, digests and features; null ids are kept, and ids are of their column's type if that is an
integer, else strings; ids of writes to one directory are of one type; an empty table gives
an archive directory without archives.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import IntegralType, StringType

from .common import as_bytes, fresh_path, read

ROW, LEVEL = 64, 1
RANGE, BATCH, TRIES = 16 << 20, 4 << 20, 3
SIGNATURE = b"\x89PNG\r\n\x1a\n"
COLUMNS, MANIFEST = "member string, media binary", "manifest-"


def pad(data: bytes) -> bytes:
    return data + bytes(-len(data) % ROW or (ROW if not data else 0))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes, length: int) -> bytes:
    """``length``, of the bytes before padding, is kept in a text chunk."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    filtered = np.zeros((len(rows), ROW + 1), np.uint8)  # filter type 0 before each row
    filtered[:, 1:] = rows
    header = struct.pack(">IIBBBBB", ROW, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"tEXt", b"Length\0%d" % length) + _chunk(b"IDAT", zlib.compress(filtered, LEVEL)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> tuple[bytes, int]:
    """The samples and length of an image that ``to_png`` made; ValueError if it is damaged."""
    if media[:8] != SIGNATURE:
        raise ValueError("no PNG")
    at, width, height, length, body = 8, 0, 0, 0, b""
    while at < len(media):
        (n,), kind = struct.unpack(">I", media[at : at + 4]), media[at + 4 : at + 8]
        data = media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + data) != struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged PNG")
        if kind == b"IHDR":
            width, height = struct.unpack(">II", data[:8])
        elif kind == b"tEXt":
            length = int(data.partition(b"\0")[2])
        elif kind == b"IDAT":
            body += data
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("filtered rows are not written here")
    return rows[:, 1:].tobytes(), length


def feature(payload: bytes) -> str:
    """A 64-bit average hash of the image: mean of each column against the mean of all."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    columns = rows.sum(0, dtype=np.int64)
    return np.packbits(columns * ROW > columns.sum()).tobytes().hex()


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


@dataclass
class Archive(WriterCommitMessage):
    name: str | None
    members: int


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int


def manifests(path: str) -> dict[str, dict]:
    """Content of each manifest of a directory by its file name."""
    fs, root = file_system(path)
    out = {}
    for x in sorted(fs.get_file_info(_selector(root)), key=lambda x: x.path):
        if x.base_name.startswith(MANIFEST):
            with fs.open_input_stream(x.path) as f:
                out[x.base_name] = json.loads(f.read())
    return out


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, path: str, ids: str, overwrite: bool):
        self.path, self.ids, self.overwrite = path, ids, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Archive:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        name, archive, n, out = f"{uuid.uuid4().hex}.zip", None, 0, None
        for batch in iterator:
            for doc_id, member, media in zip(*batch.columns[:3], strict=True):
                if archive is None:
                    out = fs.open_output_stream(f"{root}/{name}")
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                info = zipfile.ZipInfo(f"{n}/{member.as_py()}")
                info.comment = json.dumps(doc_id.as_py()).encode()
                archive.writestr(info, media.as_py())
                n += 1
        if archive is None:
            return Archive(None, 0)
        archive.close()
        out.close()
        return Archive(name, n)

    def commit(self, messages: list[Archive | None]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        before = manifests(self.path)
        if not self.overwrite and any(m["ids"] != self.ids for m in before.values()):
            self.abort(messages)
            raise ValueError(f"the archives of {self.path} have ids of another type than {self.ids}")
        kept = [m.name for m in messages if m and m.name]
        with fs.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({"ids": self.ids, "archives": kept}).encode())
        for name, manifest in before.items() if self.overwrite else ():
            fs.delete_file(f"{root}/{name}")
            for archive in manifest["archives"]:
                fs.delete_file(f"{root}/{archive}")

    def abort(self, messages: list[Archive | None]) -> None:
        fs, root = file_system(self.path)
        for m in messages:
            if m and m.name:
                fs.delete_file(f"{root}/{m.name}")


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, ids: str, range_bytes: int):
        self.path, self.ids, self.range_bytes = path, ids, range_bytes

    def partitions(self) -> list[ByteRange]:
        fs, root = file_system(self.path)
        names = [name for m in manifests(self.path).values() for name in m["archives"]]
        sizes = {x.base_name: x.size for x in fs.get_file_info(_selector(root))}
        return [
            ByteRange(f"{root}/{name}", at, at + self.range_bytes)
            for name in names for at in range(0, sizes[name], self.range_bytes)
        ] or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = file_system(self.path)
        with Handle(lambda: fs.open_input_file(partition.path)) as handle:
            with zipfile.ZipFile(handle.file()) as archive:
                wanted = [i for i in archive.infolist() if partition.start <= i.header_offset < partition.end]
            rows, held = [], 0
            for info in sorted(wanted, key=lambda i: i.header_offset):
                media = read_member(handle, info)
                rows.append((json.loads(info.comment or b"null"), info.filename, media))
                held += len(media)
                if held >= BATCH:
                    yield _batch(rows, self.ids)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, self.ids)


class Handle:
    """A file that is opened when needed, and anew after ``close``."""

    def __init__(self, open_file):
        self.open_file, self.opened = open_file, None

    def file(self):
        self.opened = self.opened or self.open_file()
        return self.opened

    def close(self) -> None:
        given_up, self.opened = self.opened, None
        if given_up is not None:
            try:
                given_up.close()
            except OSError:
                pass  # it was lost already

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def _selector(root: str):
    from pyarrow import fs

    return fs.FileSelector(root, allow_not_found=True)


def _batch(rows: list[tuple], ids: str) -> pa.RecordBatch:
    kinds = (pa.string() if ids == "string" else pa.int64(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "member", "media"])


def read_member(handle: Handle, info: zipfile.ZipInfo, tries: int = TRIES) -> bytes:
    """A stored member from its offset; on failure again, on a new handle."""
    for left in range(tries - 1, -1, -1):
        try:
            f = handle.file()
            f.seek(info.header_offset)
            header = f.read(30)
            if header[:4] != b"PK\x03\x04":
                raise ValueError(f"no member at {info.header_offset}")
            name, extra = struct.unpack("<HH", header[26:30])
            f.seek(info.header_offset + 30 + name + extra)
            media = f.read(info.compress_size)
            if zlib.crc32(media) != info.CRC:
                raise ValueError(f"member {info.filename} is damaged")
            return media
        except (OSError, ValueError):
            if not left:
                raise
            handle.close()
    raise AssertionError


class MediaArchive(DataSource):
    """``spark.read.format("media_archive").load(directory)``; option ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def _ids(self) -> str:
        found = [m["ids"] for m in manifests(self.options["path"]).values()]
        return found[0] if found else "long"

    def schema(self) -> str:
        return f"doc_id {self._ids()}, {COLUMNS}"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"], self._ids(), int(self.options.get("range_bytes", RANGE)))

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"], "string" if isinstance(schema["doc_id"].dataType, StringType) else "long", overwrite)


def write_archive(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", mode: str = "append") -> str:
    """Stores every text as an image in archives under ``path``, beside those there or in their place (``overwrite``)."""

    def run(batches):
        for batch in batches:
            media = [to_png(pad(b := t.as_py()), len(b)) for t in batch.column(1)]
            member = pa.array([f"{i}.png" for i in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), member, pa.array(media, pa.binary())], ["doc_id", "member", "media"])

    spark = docs.sparkSession
    spark.dataSource.register(MediaArchive)
    ids = "long" if isinstance(docs.schema[doc_id].dataType, IntegralType) else "string"
    rows = docs.select(F.col(doc_id).cast(ids).alias("doc_id"), as_bytes(F.col(text)).alias("text")).mapInArrow(run, f"doc_id {ids}, {COLUMNS}")
    rows.write.format("media_archive").mode(mode).save(path)
    return path


def read_archive(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").option("range_bytes", range_bytes).load(path)


def media_features(media: DataFrame) -> DataFrame:
    """Digests and features of ``media(doc_id, media)``, from the stored bytes."""

    def run(batches):
        for batch in batches:
            rows = []
            for m in batch.column(1):
                m = m.as_py()
                p, length = from_png(m)
                rows.append((length, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-ROW:]), len(m), hashlib.sha256(m).hexdigest(), feature(p)))
            names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", *names])

    ids = media.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {ids}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return media.select("doc_id", "media").mapInArrow(run, schema)


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_archive(read(spark, sf_dir, "documents"), fresh_path(spark, "media"))
    return media_features(read_archive(spark, path))
