import hashlib
import io
import zipfile
import zlib

import pyarrow as pa
import pytest

from seisloom.llm import media
from seisloom.llm.common import fresh_path


def test_png_round_trip():
    for data in (b"", b"a", b"x" * 64, bytes(range(256)) * 50, b"end\0\0"):
        p = media.pad(data)
        assert len(p) % 64 == 0 and len(p) > 0 and p.startswith(data)
        assert media.from_png(media.to_png(p, len(data))) == (p, len(data))
    broken = bytearray(media.to_png(bytes(64), 0))
    broken[60] ^= 1
    with pytest.raises(ValueError):
        media.from_png(bytes(broken))


def test_archive_round_trip(spark, docs, empty):
    path = media.write_archive(docs.repartition(3), fresh_path(spark, "media"))
    for size in (media.RANGE, 200):  # one range, and ranges smaller than members
        stored = media.read_archive(spark, path, size)
        out = sorted((tuple(r) for r in media.media_features(stored).collect()), key=str)
        want = []
        for r in docs.collect():
            data = (r.text or "").encode()
            p = media.pad(data)
            m = media.to_png(p, len(data))
            want.append((r.doc_id, len(data), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest(), media.feature(p)))
        assert out == sorted(want, key=str)
    path = media.write_archive(empty, fresh_path(spark, "media"))
    assert media.media_features(media.read_archive(spark, path)).count() == 0


def test_member_is_retried_from_its_offset():
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("a", b"first")
        z.writestr("b", b"second")
    info = zipfile.ZipFile(held).infolist()[1]
    tried = []

    def flaky():
        tried.append(1)
        if len(tried) < 3:
            raise OSError("lost")
        return io.BytesIO(held.getvalue())

    assert media.read_member(media.Handle(flaky), info) == b"second" and len(tried) == 3
    with pytest.raises(ValueError):
        media.read_member(media.Handle(lambda: io.BytesIO(held.getvalue().replace(b"second", b"sxcond"))), info)


def test_a_range_is_read_through_one_handle(spark, docs, monkeypatch):
    path = media.write_archive(docs.coalesce(1), fresh_path(spark, "media"))
    reader, opened = media.ArchiveReader(path, "long", media.RANGE), []
    (part,) = reader.partitions()
    real = media.Handle

    class Counting(real):
        def __init__(self, open_file):
            super().__init__(lambda: opened.append(1) or open_file())

    monkeypatch.setattr(media, "Handle", Counting)
    assert sum(b.num_rows for b in reader.read(part)) == docs.count() and len(opened) == 1


def test_second_write_appends_or_overwrites(spark):
    first = spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, text string")
    second = spark.createDataFrame([(3, "three"), (1, "one")], "doc_id long, text string")
    path = media.write_archive(first, fresh_path(spark, "media"))
    media.write_archive(second, path)
    rows = lambda: sorted(r.doc_id for r in media.media_features(media.read_archive(spark, path)).collect())
    assert rows() == [1, 1, 2, 3]
    media.write_archive(second, path, mode="overwrite")
    assert rows() == [1, 3]
    fs, root = media.file_system(path)
    left = [x.base_name for x in fs.get_file_info(media._selector(root))]
    assert sum(x.endswith(".json") for x in left) == 1 and sum(x.endswith(".zip") for x in left) <= 2
    with pytest.raises(Exception, match="another type"):
        media.write_archive(first.selectExpr("cast(doc_id AS string) AS doc_id", "text"), path)
    assert rows() == [1, 3]


def test_other_ids(spark):
    for kind, want in (("string", ["a/1", None]), ("int", [7, None])):
        df = spark.createDataFrame([(want[0], "x"), (None, "y")], f"doc_id {kind}, text string")
        path = media.write_archive(df, fresh_path(spark, "media"))
        out = media.media_features(media.read_archive(spark, path)).collect()
        assert sorted((r.doc_id for r in out), key=str) == sorted(want, key=str)


def test_what_a_failed_write_leaves_goes(tmp_path):
    writer = media.ArchiveWriter(str(tmp_path), "long", False)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["1.png"]), pa.array([b"x"])], ["doc_id", "member", "media"])
    writer.abort([writer.write(iter([batch])), None])
    assert list(tmp_path.iterdir()) == []


def test_another_decoder_reads_the_images(spark, tmp_path):
    """Spark's own image source, which decodes with the JVM's codecs."""
    texts = ["", "a", "seismic " * 40, "".join(map(chr, range(1, 600)))]
    for i, t in enumerate(texts):
        (tmp_path / f"{i}.png").write_bytes(media.to_png(media.pad(t.encode()), len(t.encode())))
    got = {r.image.origin.rsplit("/", 1)[-1]: r.image for r in spark.read.format("image").load(str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        image = got[f"{i}.png"]
        assert (image.width, image.nChannels) == (64, 1)
        assert bytes(image.data) == t.encode() + bytes(image.height * 64 - len(t.encode()))
