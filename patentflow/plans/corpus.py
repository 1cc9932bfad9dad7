"""Patent documents derived from the `documents` table, for the registered queries and tests.

The SQL runs unchanged in Spark and DuckDB.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentflow.schemas import ARCHIVE_BLOBS
from patentflow.sources.tables import read_table
from patentflow.storage import bounded_batches

BASE_NAME = "'EP' || lpad(cast(doc_id AS string), 8, '0') || '.xml'"


def _tag(name: str, value: str) -> str:
    return f"'<{name}>' || {value} || '</{name}>'"


def _ipc_entry(j: int) -> str:
    """The j-th IPC entry of a document; documents have one to five."""
    parts = (
        _tag("classification-level", f"CASE WHEN (doc_id + {j}) % 2 = 0 THEN 'A' ELSE 'C' END"),
        _tag("section", f"substr('ABCDEFGH', cast(1 + (doc_id * 3 + {j}) % 8 AS int), 1)"),
        _tag("class", f"lpad(cast((doc_id * 7 + {j * 13}) % 99 + 1 AS string), 2, '0')"),
        _tag("subclass", f"substr('BCDFGHJKLM', cast(1 + (doc_id + {j * 3}) % 10 AS int), 1)"),
        _tag("main-group", f"cast((doc_id + {j * 5}) % 60 + 1 AS string)"),
        _tag("subgroup", f"lpad(cast((doc_id * 3 + {j * 11}) % 100 AS string), 2, '0')"),
    )
    entry = _tag("classification-ipcr", " || ".join(parts))
    return f"CASE WHEN doc_id % 5 >= {j} THEN {entry} ELSE '' END"


_IPC = _tag("classifications-ipcr", " || ".join(_ipc_entry(j) for j in range(5)))

# Some documents lack the IPC block, the title or the abstract; the title is the first line and the
# abstract the whole text.
PATENTS_SQL = f"""
SELECT source || '/' || {BASE_NAME} AS file_name, doc_id, source,
  '<doc><document-id><country>EP</country><date>' || cast(2000 + doc_id % 20 AS string)
  || '0101</date></document-id>'
  || CASE WHEN doc_id % 17 = 0 THEN '' ELSE {_IPC} END
  || CASE WHEN doc_id % 13 = 0 THEN '' ELSE '<invention-title lang="en" id="title_en">'
     || split_part(text, chr(10), 1) || '</invention-title>' END
  || CASE WHEN doc_id % 11 = 0 THEN '' ELSE '<abstract lang="en"><p id="pa01">'
     || text || '</p></abstract>' END
  || '</doc>' AS raw_txt
FROM documents
"""

# The list of known positives: documents labelled as good.
KNOWN_SQL = f"SELECT {BASE_NAME} AS base_name FROM labels WHERE quality = 1"

ARCHIVE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet")


def patents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PATENTS_SQL.replace("FROM documents", "FROM {documents}"),
                     documents=documents(spark, sf_dir))


def known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(KNOWN_SQL.replace("FROM labels", "FROM {labels}"),
                     labels=spark.read.parquet(f"{sf_dir}/labels.parquet"))


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("url").alias("value"))


def packed(docs: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Documents as tar archives, `(path, content)`: each task packs its own rows, starts a new
    archive when one is full, adds a directory member, and compresses every second archive."""

    def pack(batches):
        import io
        import tarfile

        import pyarrow as pa
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0

        def close(rows):
            buffer = io.BytesIO()
            with tarfile.open(fileobj=buffer, mode="w:gz" if number % 2 else "w") as tar:
                folder = tarfile.TarInfo(rows[0][0].split("/")[0])
                folder.type = tarfile.DIRTYPE
                tar.addfile(folder)
                for name, content in rows:
                    member = tarfile.TarInfo(name)
                    member.size = len(content)
                    tar.addfile(member, io.BytesIO(content))
            columns = [[f"archive-{task}-{number}.tar"], [buffer.getvalue()]]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary())],
                names=["path", "content"],
            )

        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                content = row["raw_txt"].encode()
                held.append((row["file_name"], content))
                size += len(content)
                if size >= archive_bytes:
                    yield close(held)
                    held, size, number = [], 0, number + 1
        if held:
            yield close(held)

    bounded_batches(docs.sparkSession)
    return docs.select("file_name", "raw_txt").mapInArrow(pack, ARCHIVE_BLOBS)


def write_archives(blobs: DataFrame, folder: str) -> None:
    """Write `(path, content)` rows as files below a folder, by tasks."""

    def write(batches):
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                target = f"{folder}/{path}"
                if target.startswith(("/", "file:")):
                    store, name = fs.LocalFileSystem(), "/" + target.removeprefix("file:").lstrip("/")
                else:
                    store, name = fs.FileSystem.from_uri(quote(target, safe=":/@"))
                store.create_dir(name.rpartition("/")[0])
                with store.open_output_stream(name) as stream:
                    stream.write(content.as_buffer())
            yield pa.RecordBatch.from_arrays([batch.column("path")], names=["path"])

    bounded_batches(blobs.sparkSession)
    blobs.mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()


def damaged(docs: DataFrame) -> DataFrame:
    """An archive of three members for each document, `(path, content)`, spoilt in a way its id decides.

    By the id's remainder by six: 0, the second header is overwritten; 1, it is zeroed; 2, cut before the
    third header; 3, cut inside it; 4, nothing is left; 5, sound.
    """

    def spoil(batches):
        import io
        import tarfile

        import pyarrow as pa

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                buffer, starts, number = io.BytesIO(), [], doc_id.as_py()
                content = (text.as_py() or "").encode()
                with tarfile.open(fileobj=buffer, mode="w") as tar:
                    for nth in range(3):
                        starts.append(tar.offset)
                        member = tarfile.TarInfo(f"d{number}/{nth}.xml")
                        member.size = len(content)
                        tar.addfile(member, io.BytesIO(content))
                data, kind = bytearray(buffer.getvalue()), number % 6
                if kind < 2:
                    data[starts[1] : starts[1] + 512] = (b"x", b"\0")[kind] * 512
                elif kind < 5:
                    del data[(starts[2], starts[2] + 100, 0)[kind - 2] :]
                columns = [pa.array([f"{number}.tar"], pa.string()), pa.array([bytes(data)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "content"])

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(spoil, ARCHIVE_BLOBS)


PART_KINDS = ("page", "cut", "other", "sound")
PART_ROWS = 5000


def write_damaged_parts(docs: DataFrame, staged: str, folder: str) -> None:
    """Documents as parquet parts below a folder, three of four spoilt, as the id's remainder by four says: 0, bytes
    of the first page are overwritten; 1, cut in the middle; 2, the part is no parquet; 3, sound."""
    kind = F.element_at(F.array(*map(F.lit, PART_KINDS)), (F.col("doc_id") % 4 + 1).cast("int"))
    writer = docs.withColumn("kind", F.coalesce(kind, F.lit("sound"))).write.option("maxRecordsPerFile", PART_ROWS)
    writer.partitionBy("kind").parquet(staged)
    files = docs.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(staged)
    content, size = F.col("content"), F.length("content")
    page = F.concat(F.substring(content, 1, 40), F.lit(b"\xff" * 16), F.substring(content, F.lit(57), size))
    spoilt = (
        F.when(F.col("kind") == "page", page)
        .when(F.col("kind") == "cut", F.substring(content, F.lit(1), F.floor(size / 2).cast("int")))
        .when(F.col("kind") == "other", F.lit(b"no parquet"))
        .otherwise(content)
    )
    name = F.concat("kind", F.lit("-"), F.substring_index("path", "/", -1))
    write_archives(files.select(name.alias("path"), spoilt.alias("content")), folder)
