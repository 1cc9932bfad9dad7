"""Archives as they arrive: each new one is read once, and each batch leaves its rows once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentflow.operators import wordcount
from patentflow.operators.patents import extract_reported
from patentflow.sources import archives
from patentflow.storage import remove, stage
from patentflow.streaming.events import finished

BATCH = "batch"
LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def read_new_archives(spark: SparkSession, path: str, glob: str = "*", per_batch: int | None = None) -> DataFrame:
    """path and length of the archives of a folder as a stream; contents are not read.

    An archive is known by its path: one that is written anew under an old name is not read again. Empty
    files do not show.
    """
    reader = spark.readStream.format("binaryFile").schema(LISTED).option("pathGlobFilter", glob)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(path).select("path", "length")


def ingest_archives(
    spark: SparkSession, archive_dir: str, out: str, glob: str = "*", per_batch: int | None = None
) -> None:
    """Add what is new in a folder of archives to `patents`, `word_counts` and `archive_errors` below `out`.

    The log below `out` tells which archives were read. Each table has one folder a batch, which the batch replaces as
    a whole, so a batch that failed and is run again leaves no row twice; as long as it has not ended,
    its folders do not count, see `read_ingested`. Calls on the same `out` must not overlap.
    """

    def write(batch: DataFrame, number: int) -> None:
        # The archives of a batch are a plain table for the readers, which list blocks before they read.
        write_batch(stage(batch, f"{out}/listed/{number}"), out, number)

    new = read_new_archives(spark, archive_dir, glob, per_batch)
    writer = new.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/log")
    finished(writer.trigger(availableNow=True).start())


def write_batch(listed: DataFrame, out: str, number: int) -> None:
    """The rows of a batch of archives, replacing what an earlier attempt at it has left; counts come last."""
    spark, staged = listed.sparkSession, f"{out}/staged/{number}"
    found = stage(extract_reported(archives.read_listed(listed)), staged)
    patents = found.where(F.col("error").isNull()).drop("archive", "error")
    tables = {
        "patents": patents,
        "archive_errors": archives.failures(found),
        "word_counts": wordcount.count_words(patents),
    }
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{out}/{name}/{BATCH}={number}")
    done = spark.createDataFrame([(number,)], "number int")
    done.write.mode("overwrite").parquet(f"{out}/done/{number}")
    for folder in (staged, f"{out}/listed/{number}"):
        remove(spark, folder)


def read_ingested(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table of `ingest_archives` with the number of the `batch` of each row; of batches that have ended."""
    ended = spark.read.option("recursiveFileLookup", True).schema("number int").parquet(f"{out}/done")
    return spark.read.parquet(f"{out}/{name}").join(ended, F.col(BATCH) == F.col("number")).drop("number")


def merged_counts(spark: SparkSession, out: str) -> DataFrame:
    """Word counts of all batches."""
    return wordcount.merge_counts(read_ingested(spark, out, "word_counts"))
