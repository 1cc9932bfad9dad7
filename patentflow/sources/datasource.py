"""Tar archives as a format of Spark's reader: `spark.read.format("tar").load(folder)`.

The classes travel to the processes that plan and read by value, so the package need not be installed there.
"""

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    ColumnPath,
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from patentflow.schemas import UNPACKED
from patentflow.sources.archives import BLOCK_BYTES
from patentflow.sources.tar import files, files_between, is_cuttable, open_path, open_raw, to_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARCHIVE: ColumnPath = ("archive",)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let filters on `archive` reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(TarSource)


def load(spark: SparkSession, folder: str, **options) -> DataFrame:
    """The archives below a folder, for one reading of a plan.

    Spark keeps the partitions of one reading for each `load`. Where a plan reads the same loaded table under several
    filters, the filter that was planned last chooses the archives of all of them, so each takes a table of its own.
    """
    register(spark)
    return spark.read.format("tar").options(**options).load(folder)


class TarSource(DataSource):
    """(archive, file_name, raw_txt, error) of the archives below a folder, as `read_archives` gives them.

    Options: `path`, `glob` for the names of archives, `blockBytes` for the length of the ranges that large plain archives
    are read in. Filters that compare `archive` with values, or with a beginning, an end or a part, choose the
    archives before any is opened.
    """

    @classmethod
    def name(cls) -> str:
        return "tar"

    def schema(self):
        return UNPACKED

    def reader(self, schema) -> "TarReader":
        given = self.options
        return TarReader(given["path"], given.get("glob", "*"), int(given.get("blockBytes", BLOCK_BYTES)))


@dataclass
class Piece(InputPartition):
    """A range of an archive; a range without an end goes to the end of the archive."""

    path: str
    start: int
    stop: int | None


class TarReader(DataSourceReader):
    def __init__(self, path: str, glob: str, block_bytes: int):
        self.path, self.glob, self.block_bytes = path, glob, block_bytes
        self.chosen: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            known = (EqualTo, In, StringStartsWith, StringEndsWith, StringContains)
            if isinstance(one, known) and one.attribute == ARCHIVE:
                self.chosen.append(one)
            else:
                yield one

    def partitions(self) -> list[Piece]:
        """Ranges of the archives that the filters leave; only listings and first headers are read here."""
        return [piece for path, size in sorted(self._archives()) for piece in self._pieces(path, size)]

    def _archives(self) -> Iterator[tuple[str, int]]:
        scheme, _, _ = self.path.partition("://")
        is_local = self.path.startswith(("/", "file:"))
        root = "/" + self.path.removeprefix("file:").lstrip("/") if is_local else self.path
        store, name = (fs.LocalFileSystem(), root) if is_local else fs.FileSystem.from_uri(root)
        for entry in store.get_file_info(fs.FileSelector(name, recursive=True)):
            path = f"file://{entry.path}" if is_local else f"{scheme}://{entry.path}"
            hidden = any(part.startswith((".", "_")) for part in entry.path[len(name) :].split("/"))
            if entry.is_file and not hidden and fnmatch(entry.base_name, self.glob) and self._is_chosen(path):
                yield path, entry.size

    def _is_chosen(self, path: str) -> bool:
        tests = {
            EqualTo: lambda value: path == value,
            In: lambda value: path in value,
            StringStartsWith: path.startswith,
            StringEndsWith: path.endswith,
            StringContains: path.__contains__,
        }
        return all(tests[type(one)](one.value) for one in self.chosen)

    def _pieces(self, path: str, size: int) -> Iterator[Piece]:
        starts = [0]
        if size > self.block_bytes:
            with open_raw(path) as stream:
                if is_cuttable(stream):
                    starts = list(range(0, size, self.block_bytes))
        yield from (Piece(path, start, stop) for start, stop in zip(starts, [*starts[1:], None]))

    def read(self, piece: Piece | None) -> Iterator[pa.RecordBatch]:
        """The rows of a range. Where no archive is chosen, Spark asks for the rows of none."""
        return to_batches(self._rows(piece) if piece else ())

    def _rows(self, piece: Piece) -> Iterator[tuple]:
        if piece.start == 0 and piece.stop is None:
            with open_path(piece.path) as stream:
                yield from files(piece.path, stream)
        else:
            with open_raw(piece.path) as stream:
                yield from files_between(piece.path, stream, piece.start, piece.stop)
