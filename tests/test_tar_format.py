"""Tar archives as a format of the reader, against the archives job."""

import io
import tarfile

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from patentflow.plans import corpus, queries
from patentflow.sources import datasource
from patentflow.sources.archives import read_archives
from patentflow.storage import scratch_dir

COLUMNS = ["archive", "file_name", "raw_txt"]


def read(spark, folder, block_bytes=1 << 30, **options):
    datasource.register(spark)
    return spark.read.format("tar").options(blockBytes=block_bytes, **options).load(str(folder))


def same_as_job(spark, folder, block_bytes):
    """Same members and as many damages of each archive; texts of errors may differ."""
    found, expected = read(spark, folder, block_bytes), read_archives(spark, str(folder), tasks=2)
    told = []
    for table in (found, expected):
        members = rows(table.where("error IS NULL").select(*COLUMNS))
        told.append((members, rows(table.where("error IS NOT NULL").groupBy("archive").count())))
    return told[0] == told[1] and told[0]


def write_tar(path, n, mode="w", size=3000):
    with tarfile.open(path, mode) as archive:
        folder = tarfile.TarInfo("EP")
        folder.type = tarfile.DIRTYPE
        archive.addfile(folder)
        for i in range(n):
            member = tarfile.TarInfo(f"EP/{'long' * 40 * (i % 2)}{i}.xml")
            member.size = size + i
            archive.addfile(member, io.BytesIO(b"x" * member.size))
    return path


@pytest.mark.parametrize("block_bytes", [3_000, 40_000, 1 << 30])
def test_ranges_give_the_rows_of_the_job(spark, tmp_path, block_bytes):
    write_tar(tmp_path / "plain.tar", 40)
    write_tar(tmp_path / "zipped.tar", 40, "w:gz")
    write_tar(tmp_path / "none.tar", 0)
    (tmp_path / "sub").mkdir()
    write_tar(tmp_path / "sub" / "é x.tar", 3)
    (tmp_path / "empty.tar").write_bytes(b"")
    (tmp_path / "_hidden.tar").write_bytes(b"junk")
    members, errors = same_as_job(spark, tmp_path, block_bytes)
    assert len(members) == 83 and len(errors) == 1


@pytest.mark.parametrize("block_bytes", [2_000, 5_000, 1 << 30])
def test_damage_is_told_once(spark, sf_dir, block_bytes):
    folder = scratch_dir(spark)
    docs = corpus.documents(spark, sf_dir).where("doc_id < 30")
    corpus.write_archives(corpus.damaged(docs), folder)
    members, errors = same_as_job(spark, folder, block_bytes)
    assert len(errors) == 25 and {n for _, n in errors} == {1} and len(members) == 5 * (1 + 1 + 2 + 2 + 0 + 3)


@pytest.mark.parametrize("block_bytes", [700, 4_000])
@pytest.mark.parametrize("cut", [513, 1024 + 100, 8_000, 20_000, -10_240, -9_000])
def test_cuts_anywhere(spark, tmp_path, cut, block_bytes):
    content = write_tar(tmp_path / "a.tar", 8).read_bytes()
    (tmp_path / "a.tar").write_bytes(content[:cut])
    assert same_as_job(spark, tmp_path, block_bytes)


def test_data_behind_the_end(spark, tmp_path):
    path = write_tar(tmp_path / "a.tar", 3)
    path.write_bytes(path.read_bytes() + b"more")
    assert same_as_job(spark, tmp_path, 2000)


def test_an_archive_inside_an_archive(spark, tmp_path):
    inner = write_tar(tmp_path / "inner", 5).read_bytes()
    (tmp_path / "inner").unlink()
    with tarfile.open(tmp_path / "outer.tar", "w") as archive:
        for name in ("one", "two"):
            member = tarfile.TarInfo(f"EP/{name}.tar")
            member.size = len(inner)
            archive.addfile(member, io.BytesIO(inner))
    members, errors = same_as_job(spark, tmp_path, 3000)
    assert len(members) == 2 and not errors


def test_filters_choose_archives_before_any_is_opened(spark, tmp_path):
    for name in ("a", "b", "c"):
        write_tar(tmp_path / f"{name}.tar", 4)
    (tmp_path / "d.tar").write_bytes(b"junk")
    table = read(spark, tmp_path, 2000)
    pieces = table.rdd.getNumPartitions()
    archive = F.col("archive")
    path = f"file://{tmp_path}/b.tar"
    for condition in (archive == path, archive.isin(path, "x"), archive.endswith("/b.tar"), archive.contains("/b."), archive.startswith(path)):
        chosen = table.where(condition)
        assert chosen.rdd.getNumPartitions() < pieces / 2
        assert {r.archive for r in chosen.collect()} == {path} and chosen.count() == 4
    both = table.where(archive.endswith("b.tar") & F.col("file_name").endswith("1.xml"))
    assert both.count() == 1 and table.where(archive == "nothing").collect() == []
    assert table.where("error IS NOT NULL").count() == 1


def test_names_by_a_pattern(spark, tmp_path):
    write_tar(tmp_path / "a.tar", 2)
    write_tar(tmp_path / "b.tgz", 3, "w:gz")
    assert read(spark, tmp_path, glob="*.tgz").count() == 3
    assert "Exchange" not in plan(read(spark, tmp_path))


def test_readings_under_several_filters(spark, tmp_path):
    for name in ("a", "b", "c"):
        write_tar(tmp_path / f"{name}.tar", 4)
    is_first = F.col("archive").endswith("/a.tar")
    for chosen in ((is_first, ~is_first), (~is_first, is_first)):
        one, other = (datasource.load(spark, str(tmp_path), blockBytes=2000).where(condition) for condition in chosen)
        assert one.unionByName(other).groupBy("archive").count().select("count").collect() == [(4,)] * 3


def test_query_of_many_archives_matches_sql(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(corpus.packed, "__defaults__", (100_000,))
    found = queries.src_archive_format(spark, sf_dir)
    assert rows(found) == rows(corpus.patents(spark, sf_dir).select("file_name", "raw_txt"))
