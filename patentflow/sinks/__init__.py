"""Parquet and JSON outputs."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentflow.functions import props, text
from patentflow.storage import remove, swap_in, without_checksum_files

# Fixed value: bound on rows per part where one is wanted.
MAX_ROWS = 3000


def write_table(df: DataFrame, path: str, max_rows: int | None = None, checksum_files: bool = True) -> None:
    """Replace a snappy parquet table, optionally with a bound on the rows per file.

    On a local disk Hadoop puts a file of checksums beside each one, which for files of a few rows takes longer than
    writing them. Without those, the checksums that parquet has in its pages remain. Other storages are written as ever.
    """
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    if not checksum_files:
        writer = writer.options(**without_checksum_files(df.sparkSession, path))
    writer.parquet(path)


def write_dated(df: DataFrame, path: str, day: str) -> None:
    """Write under the run date. Exactly that date is replaced: a rerun repeats no rows, and one without
    rows leaves none of the earlier ones.

    The rows are written under a hidden name and take the place of the earlier ones when all are there; a run that
    fails changes nothing.
    """
    spark, root, date = df.sparkSession, path.rstrip("/"), text.compact_date(day)
    written = f"{root}/.ex_date-{date}-{uuid.uuid4().hex}"
    try:
        df.write.option("compression", "snappy").parquet(written)
        swap_in(spark, written, f"{root}/ex_date={date}")
    finally:
        remove(spark, written)


def read_dated(spark: SparkSession, path: str) -> DataFrame:
    """A dated table with the date as text."""
    return spark.read.option("basePath", path).parquet(path).withColumn("ex_date", F.col("ex_date").cast("string"))


def write_by_target(df: DataFrame, path: str) -> None:
    """Replace a table with one folder per class."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    writer.partitionBy("target").parquet(path)


def write_if_any(df: DataFrame, path: str) -> bool:
    """Write a table unless it would be empty; stops at the first row to find out."""
    if df.isEmpty():
        return False
    write_table(df, path)
    return True


def write_counts(counts: DataFrame, path: str) -> None:
    """Word counts as parquet."""
    write_table(counts, path)


def write_counts_json(counts: DataFrame, path: str) -> None:
    """Word counts as JSON lines."""
    counts.write.mode("overwrite").json(path)


def write_counts_map(top: DataFrame, path: str) -> None:
    """A bounded table of word counts as one JSON object."""
    top.agg(props.map_of(F.col("word"), F.col("n")).alias("value")).coalesce(1).write.mode("overwrite").text(path)
