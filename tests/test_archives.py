"""Tar files on disk and in columns: formats, damage, splitting."""

import gzip
import io
import os
import tarfile

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from patentflow.plans import corpus
from patentflow.schemas import ARCHIVE_BLOBS
from patentflow.sources import tar
from patentflow.sources.archives import (
    archive_blocks,
    documents,
    failures,
    list_archives,
    read_archives,
    unpack_blobs,
)

FILES = [
    ("EP/a.xml", "<doc>a</doc>"),
    ("EP/b é.xml", "<doc>é 中</doc>"),
    ("EP/" + "long" * 40 + ".xml", "<doc>long name</doc>"),
    ("EP/empty.xml", ""),
]


def write_tar(path, files, mode="w", **options):
    with tarfile.open(path, mode, **options) as archive:
        folder = tarfile.TarInfo("EP")
        folder.type = tarfile.DIRTYPE
        archive.addfile(folder)
        for name, content in files:
            data = content if isinstance(content, bytes) else content.encode()
            member = tarfile.TarInfo(name)
            member.size = len(data)
            archive.addfile(member, io.BytesIO(data))
    return path


@pytest.mark.parametrize("mode", ["w", "w:gz", "w:bz2", "w:xz"])
@pytest.mark.parametrize("layout", [tarfile.PAX_FORMAT, tarfile.GNU_FORMAT])
def test_formats(spark, tmp_path, mode, layout):
    write_tar(tmp_path / "one archive.tar", FILES, mode, format=layout)
    found = documents(read_archives(spark, str(tmp_path)))
    assert rows(found) == sorted(FILES, key=repr)


def test_listing_reads_no_content(spark, tmp_path):
    write_tar(tmp_path / "a.tar", FILES)
    (tmp_path / "sub").mkdir()
    write_tar(tmp_path / "sub" / "b.tar", FILES)
    (tmp_path / "note.txt").write_text("x")
    listed = list_archives(spark, str(tmp_path), "*.tar")
    sizes = sorted(row.length for row in listed.collect())
    assert sizes == [os.path.getsize(tmp_path / "a.tar")] * 2
    assert "ReadSchema: struct<path:string,length:bigint>" in plan(listed)


def test_many_archives_are_not_listed_on_the_driver(spark, tmp_path):
    """Spark's listing holds every file of a folder on the driver."""
    for i in range(1100):
        (tmp_path / f"{i}.tar").touch()
    listed = list_archives(spark, str(tmp_path), "*7.tar")
    assert "FileScan" not in plan(listed) and "ReadSchema" not in plan(listed)
    assert sorted(map(tuple, listed.collect())) == sorted((f"file://{tmp_path}/{i}.tar", 0) for i in range(7, 1100, 10))


ODD_NAMES = ["a b.tar", "c%41.tar", "é.tar", "br{a}.tar", "x,y.tar", "new\nline.tar", "_k=v/i.tar", "li st/deep/i.tar"]
HIDDEN_NAMES = ["_h.tar", ".d.tar", "m._COPYING_", "_f/i.tar", ".git/i.tar"]


@pytest.mark.parametrize("glob", ["*", "*.tar", "{a,c}*", "?*[br].tar", "[!a]*.tar", "a b.tar", "*.tgz"])
def test_tasks_list_what_spark_lists(spark, tmp_path, glob):
    for name in [*ODD_NAMES, *HIDDEN_NAMES, "note.txt"]:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    (tmp_path / "none").mkdir()
    (tmp_path / "empty.tar").touch()
    (tmp_path / "_metadata").touch()
    (tmp_path / "link").symlink_to(tmp_path / "li st")
    (tmp_path / "broken.tar").symlink_to(tmp_path / "nothing")
    for folder in (tmp_path, f"file:{tmp_path}/", tmp_path / "li st"):
        by_tasks, by_spark = (list_archives(spark, str(folder), glob, files) for files in (0, 1000))
        assert "MapInArrow" in plan(by_tasks) and "MapInArrow" not in plan(by_spark)
        assert rows(by_tasks) == rows(by_spark)
    assert rows(list_archives(spark, str(tmp_path / "none"), glob, 0)) == []


def test_entries_of_other_storages(tmp_path, monkeypatch):
    for name in ["a.tar", "sub/b.tar", "sub/_h.tar"]:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
    store = tar.fs.SubTreeFileSystem(str(tmp_path), tar.fs.LocalFileSystem())
    monkeypatch.setattr(tar, "locate", lambda path: (store, path.removeprefix("s3://")))
    assert sorted(tar.files_below("s3:///")) == [("s3:////a.tar", 5), ("s3:////sub/b.tar", 9)]


def many_files(count=600):
    return [(f"EP/{i:04d}{'x' * (i % 130)}.xml", f"<doc>{i}</doc>" * (i % 40)) for i in range(count)]


@pytest.mark.parametrize("layout", [tarfile.PAX_FORMAT, tarfile.GNU_FORMAT])
def test_large_plain_archive_is_read_in_blocks(spark, tmp_path, layout):
    """Long names have header chains of several entries, which a block must not tear apart."""
    files = many_files()
    path = write_tar(tmp_path / "big.tar", files, format=layout)
    found = read_archives(spark, str(tmp_path), block_bytes=20_000, tasks=10)
    assert len(blocks(spark, tmp_path, 20_000)) > 10
    assert rows(documents(found)) == sorted(files, key=repr)
    assert found.select(F.spark_partition_id()).distinct().count() > 5


def blocks(spark, folder, block_bytes):
    cut = archive_blocks(list_archives(spark, str(folder)), block_bytes, 4)
    return sorted((r.start, r.stop) for r in cut.collect())


def test_members_longer_than_a_range(spark, tmp_path):
    files = [("EP/a.xml", "x" * 200_000), ("EP/b.xml", "y"), ("EP/c.xml", "z" * 300_000), ("EP/d.xml", "w")]
    write_tar(tmp_path / "big.tar", files)
    cut = blocks(spark, tmp_path, 10_000)
    assert len(cut) > 2 and [stop for _, stop in cut[:-1]] == [start for start, _ in cut[1:]]
    assert rows(documents(read_archives(spark, str(tmp_path), block_bytes=10_000))) == sorted(files, key=repr)


def test_archive_inside_an_archive(spark, tmp_path):
    """Headers inside a member are no members, though a walk that starts there takes them for some."""
    inner = write_tar(tmp_path / "inner", many_files(200)).read_bytes()
    (tmp_path / "outer").mkdir()
    files = [("EP/a.xml", "a"), ("EP/inner.tar", inner), ("EP/b.xml", "b" * 90_000), ("EP/c.xml", "c")]
    write_tar(tmp_path / "outer" / "o.tar", files)
    found = read_archives(spark, f"{tmp_path}/outer", block_bytes=20_000)
    names = [name for name, _ in rows(documents(found))]
    assert names == ["EP/a.xml", "EP/b.xml", "EP/c.xml", "EP/inner.tar"] and not failures(found).collect()


def test_planning_reads_little(tmp_path, monkeypatch):
    files = [(f"EP/{i}.xml", "x" * 30_000) for i in range(300)]
    path = write_tar(tmp_path / "big.tar", files)
    size, read = os.path.getsize(path), []

    class Counted:
        def __init__(self, path):
            self.file = open(path.removeprefix("file:"), "rb", buffering=0)

        def read(self, n):
            data = self.file.read(n)
            read.append(len(data))
            return data

        def __getattr__(self, name):
            return getattr(self.file, name)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

    monkeypatch.setattr(tar, "open_raw", Counted)
    step = 1_500_000
    walked = [tar.walk_range(f"file:{path}", at, at + step) for at in range(0, size, step)]
    assert [end for _, end in walked[:-1]] == [first for first, _ in walked[1:]]
    assert sum(read) < 0.1 * size


def test_reading_does_nothing_before_an_action(spark, tmp_path):
    write_tar(tmp_path / "a.tar", FILES)
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    read_archives(spark, str(tmp_path))
    assert tracker.getJobIdsForGroup(None) == before


def test_compressed_archive_stays_whole(spark, tmp_path):
    write_tar(tmp_path / "big.tgz", many_files(), "w:gz")
    assert blocks(spark, tmp_path, 1000) == [(0, None)]


def test_global_headers_keep_an_archive_whole(spark, tmp_path):
    files = many_files(100)
    options = {"format": tarfile.PAX_FORMAT, "pax_headers": {"comment": "x"}}
    path = write_tar(tmp_path / "global.tar", files, **options)
    assert blocks(spark, tmp_path, 1000) == [(0, None)]
    assert rows(documents(read_archives(spark, str(tmp_path), block_bytes=1000))) == sorted(files, key=repr)
    path.write_bytes(path.read_bytes()[:60_000])
    assert blocks(spark, tmp_path, 1000) == [(0, None)]


DAMAGE = {
    "overwritten header": lambda data, at: data[:at] + b"x" * 512 + data[at + 512 :],
    "zeroed header": lambda data, at: data[:at] + bytes(512) + data[at + 512 :],
    "cut at a border": lambda data, at: data[:at],
    "cut in a header": lambda data, at: data[: at + 100],
    "cut in a member": lambda data, at: data[: at + 800],
}


@pytest.mark.parametrize("kind", DAMAGE)
@pytest.mark.parametrize("block_bytes", [2000, 1 << 20])
@pytest.mark.parametrize("suffix", ["tar", "tgz"])
def test_all_damage_is_reported(spark, tmp_path, kind, block_bytes, suffix):
    """The members before the damage are read and one error is reported, in blocks and whole."""
    files = [(f"EP/{i}.xml", f"{i}" * 1000) for i in range(10)]
    path = write_tar(tmp_path / "whole", files)
    with tarfile.open(path) as archive:
        at = archive.getmembers()[5].offset
    data = DAMAGE[kind](path.read_bytes(), at)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / f"a.{suffix}").write_bytes(gzip.compress(data) if suffix == "tgz" else data)
    found = read_archives(spark, f"{tmp_path}/in", block_bytes=block_bytes)
    assert rows(documents(found)) == files[:4] and failures(found).count() == 1


def test_damaged_archives_are_reported_and_the_rest_is_read(spark, tmp_path):
    write_tar(tmp_path / "good.tar", FILES)
    (tmp_path / "junk.tar").write_bytes(b"junk")
    (tmp_path / "empty.tar").write_bytes(b"")
    whole = gzip.compress(open(tmp_path / "good.tar", "rb").read())
    (tmp_path / "cut.tgz").write_bytes(whole[: len(whole) // 2])
    found = read_archives(spark, str(tmp_path))
    bad = {os.path.basename(row.archive) for row in failures(found).collect()}
    assert bad == {"junk.tar", "cut.tgz", "empty.tar"}
    assert set(FILES) <= {tuple(row) for row in documents(found).collect()}


@pytest.mark.parametrize("mode", ["w:gz", "w:bz2", "w:xz"])
def test_damage_inside_compressed_data(spark, tmp_path, mode):
    noise = [(f"EP/{i}.xml", os.urandom(20_000).hex()) for i in range(40)]
    data = bytearray(write_tar(tmp_path / "x.tar", noise, mode).read_bytes())
    data[len(data) // 2 : len(data) // 2 + 2000] = bytes(2000)
    (tmp_path / "x.tar").write_bytes(data)
    assert failures(read_archives(spark, str(tmp_path))).count() == 1


def test_truncated_plain_archive_in_blocks(spark, tmp_path):
    """What stands before the cut is complete; the cut is reported."""
    files = [(f"EP/{i}.xml", "x" * 3000) for i in range(50)]
    path = write_tar(tmp_path / "t.tar", files)
    path.write_bytes(path.read_bytes()[:100_000])
    found = read_archives(spark, str(tmp_path), block_bytes=10_000).cache()
    assert failures(found).count() == 1
    read = rows(documents(found))
    assert 20 < len(read) < 50 and set(read) < set(files)


def test_missing_file_fails_the_task(tmp_path):
    with pytest.raises(OSError):
        tar.open_path(f"file:{tmp_path}/none.tar")


def test_undecodable_bytes_are_replaced(spark, tmp_path):
    write_tar(tmp_path / "a.tar", [("EP/a.xml", b"caf\xe9")])
    assert rows(documents(read_archives(spark, str(tmp_path)))) == [("EP/a.xml", "caf�")]


def test_links_and_folders_give_no_rows(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar", "w") as archive:
        for kind in (tarfile.DIRTYPE, tarfile.SYMTYPE, tarfile.LNKTYPE):
            member = tarfile.TarInfo(f"EP/{kind.decode()}")
            member.type, member.linkname = kind, "EP/x"
            archive.addfile(member)
    assert rows(read_archives(spark, str(tmp_path))) == []


def test_blobs_of_any_archive_size_round_trip(spark, sf_dir):
    docs = corpus.patents(spark, sf_dir).select("file_name", "raw_txt")
    for archive_bytes in (1, 50_000, 1 << 30):
        blobs = corpus.packed(docs, archive_bytes)
        assert rows(documents(unpack_blobs(blobs))) == rows(docs)


def test_binary_file_source_feeds_blobs(spark, tmp_path):
    write_tar(tmp_path / "a.tar", FILES)
    blobs = spark.read.format("binaryFile").load(str(tmp_path))
    assert rows(documents(unpack_blobs(blobs))) == sorted(FILES, key=repr)


def test_corrupt_blob_yields_one_error_row(spark):
    blobs = spark.createDataFrame([("x", b"junk")], ARCHIVE_BLOBS)
    found = unpack_blobs(blobs).collect()
    assert len(found) == 1 and found[0].error and found[0].file_name is None


def test_batches_for_python_are_bounded(spark):
    """Archives and texts that go to Python come a few at a time, whatever the partition holds."""
    for name in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{name}")
    content = F.lit("x" * (1 << 20)).cast("binary").alias("content")
    blobs = spark.range(0, 40, 1, 1).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("path"), content)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    unpack_blobs(blobs)
    held = [row.n for row in blobs.mapInArrow(sizes, "n bigint").collect()]
    assert sum(held) == 40 and max(held) <= 10

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 12, 1, 1).select(F.col("id").alias("doc_id"), F.lit("x" * (1 << 20)).alias("text"))
    spoilt = corpus.damaged(docs)
    held = [row.n for row in spoilt.mapInArrow(sizes, "n bigint").collect()]
    assert sum(held) == 12 and max(held) <= 10
