"""Tar archives as document rows."""

from itertools import islice
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patentflow.schemas import LISTED, UNPACKED, WALKED
from patentflow.sources import tar
from patentflow.storage import bounded_batches

BLOCK_BYTES = 128 << 20
TASKS_PER_CORE = 8
# Files of a folder that Spark lists; its listing stays on the driver, about 2 KB a file.
DRIVER_FILES = 1000


def list_archives(spark: SparkSession, path: str, glob: str = "*", driver_files: int = DRIVER_FILES) -> DataFrame:
    """path and length of the archives below a folder; no content is read.

    A folder with more than `driver_files` files below it is listed by tasks, whenever the result is computed; the
    driver sees none of its names. Whatever else a path may be, patterns included, Spark lists at once. Spark's listing
    knows empty files, but gives no rows for them; they are added.
    """
    folder = _large_folder(spark, path, driver_files)
    if folder is not None:
        return _listed_by_tasks(spark, folder, glob)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    listing = reader.option("recursiveFileLookup", True).load(path)
    names = [(unquote(name),) for name in listing.inputFiles()]
    named = spark.createDataFrame(names, "path string").select(_plain("path").alias("name"), "path")
    sized = listing.select(_plain("path").alias("name"), "length")
    return named.join(sized, "name", "left").select("path", F.coalesce("length", F.lit(0)).alias("length"))


def _large_folder(spark: SparkSession, path: str, files: int) -> str | None:
    """The whole path of a folder with more files below it than that; None for any other path."""
    if set(path) & set("{}[]*?\\"):
        return None
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place) or not store.getFileStatus(place).isDirectory():
        return None
    folder = store.makeQualified(place).toString()
    if folder.startswith("file:"):
        # Hadoop would read the names of a whole folder at once.
        folder = f"file:///{folder[5:].strip('/')}"
        found = sum(1 for _ in islice(tar.files_below(folder), files + 1))
    else:
        names, found = store.listFiles(place, True), 0
        while found <= files and names.hasNext():
            names.next()
            found += 1
    return folder if found > files else None


def _listed_by_tasks(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """One task reads the names in a folder, many those in the folders below it."""
    start = spark.range(0, 1, 1, 1).select(F.lit(folder).alias("path"))
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    dealt = start.mapInArrow(tar.folder_lister, LISTED).repartition(tasks, "path")
    found = dealt.mapInArrow(tar.subfolder_lister, LISTED)
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    return found.where(F.substring_index("path", "/", -1).rlike(rf"(?s)\A(?:{pattern})\z"))


def _plain(path: str):
    """Local paths are written with one or three slashes."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def archive_blocks(archives: DataFrame, block_bytes: int, tasks: int) -> DataFrame:
    """(path, start, stop) of pieces that can be read on their own, about a block long; no stop is the end.

    Archives are cut into ranges of bytes, and every range is walked by its headers alone. If each walk
    ends where the next range's first member starts, all cuts are true member borders, since the first
    range starts at one. A range without a member of its own joins the one before. Any other archive
    stays whole: compressed ones, those with global headers, and those that are damaged or hold another
    archive that a walk mistook for its own.
    """
    last = F.greatest(F.ceil(F.col("length") / block_bytes).cast("bigint") - 1, F.lit(0))
    numbered = archives.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("n"))
    start = F.col("n") * block_bytes
    ranges = numbered.select("path", start.alias("start"), (start + block_bytes).alias("stop"))
    walked = ranges.repartition(tasks).mapInArrow(tar.range_walker, WALKED)

    begun = walked.where(F.col("first").isNotNull())
    in_order = Window.partitionBy("path").orderBy("first")
    following = begun.withColumn("next", F.lead("first").over(in_order))
    meets = F.col("end").eqNullSafe(F.col("next"))
    by_archive = Window.partitionBy("path")
    checked = following.withColumn("is_sound", F.min(meets.cast("int")).over(by_archive) == 1)
    is_first = F.col("start") == 0
    kept = checked.where(F.col("is_sound") | is_first)
    return kept.select(
        "path",
        F.when(F.col("is_sound"), F.col("first")).otherwise(0).alias("start"),
        F.when(F.col("is_sound"), F.col("next")).alias("stop"),
    )


def read_archives(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    block_bytes: int = BLOCK_BYTES,
    tasks: int | None = None,
) -> DataFrame:
    """(archive, file_name, raw_txt, error): a row per regular file, a row per damage.

    Tasks open the archives themselves and stream them, so an archive may exceed the 2 GB of a
    binary column. Large plain archives are read by many tasks. Only block positions are shuffled;
    `tasks`, eight per core unless given, bounds the number of partitions, each of which takes several
    blocks. Nothing is read before an action. What lies behind damage in an archive is lost, as in a
    sequential reading.
    """
    return read_listed(list_archives(spark, path, glob), block_bytes, tasks)


def read_listed(archives: DataFrame, block_bytes: int = BLOCK_BYTES, tasks: int | None = None) -> DataFrame:
    """The rows of `read_archives` for the archives of a table (path, length)."""
    tasks = tasks or TASKS_PER_CORE * archives.sparkSession.sparkContext.defaultParallelism
    blocks = archive_blocks(archives, block_bytes, tasks)
    return blocks.repartition(tasks).mapInArrow(tar.block_reader, UNPACKED)


def unpack_blobs(archives: DataFrame) -> DataFrame:
    """The same rows from archives in a binary column, `(path, content)`; few at a time are held in Python."""
    bounded_batches(archives.sparkSession)
    return archives.select("path", "content").mapInArrow(tar.read_blobs, UNPACKED)


def documents(unpacked: DataFrame) -> DataFrame:
    return unpacked.where(F.col("error").isNull()).select("file_name", "raw_txt")


def failures(unpacked: DataFrame) -> DataFrame:
    return unpacked.where(F.col("error").isNotNull()).select("archive", "error")
