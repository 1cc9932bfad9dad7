"""Shared scratch space for tables that cut a long lineage."""

import uuid

from pyspark.sql import DataFrame, SparkSession


# Bounds on what Spark hands to Python at once; a single row may be longer.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches of texts and archives that go to Python. Spark reads the settings when a result is computed, so
    they stay for the session; tighter ones are kept."""
    bounds = {"maxRecordsPerBatch": BATCH_ROWS, "maxBytesPerBatch": BATCH_BYTES}
    for name, bound in bounds.items():
        key = f"spark.sql.execution.arrow.{name}"
        given = spark.conf.get(key)
        if not (given.isdigit() and 0 < int(given) <= bound):
            spark.conf.set(key, bound)


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application below the shared one the session names in spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/patentflow/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name below that of the application."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete all that this application has staged below its folder; results that read it are lost."""
    if spark.conf.get("spark.checkpoint.dir", None) is not None:
        remove(spark, scratch_root(spark))


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write the rows to `path`, or else to shared scratch, once and read them back.

    Unlike a cached plan this survives lost executors, and the scan has real size statistics, so
    Catalyst can decide about broadcasts.
    """
    path = path or scratch_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job has staged in, on any storage that Spark reaches."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def without_checksum_files(spark: SparkSession, path: str) -> dict[str, str]:
    """Options of a writer that leave out the files of checksums which Hadoop puts beside others on a local disk; none
    for any other storage, or where the session names a class of its own for local files.

    Without Hadoop's native library they double the starts of `chmod`, which take most of the time of a small file.
    """
    conf = spark._jsc.hadoopConfiguration()
    is_local = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf).getScheme() == "file"
    if not is_local or conf.get("fs.file.impl") is not None:
        return {}
    # Without the second option Spark would go on with the instance it has.
    return {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def swap_in(spark: SparkSession, written: str, folder: str) -> None:
    """Put a wholly written folder in the place of another one, on any storage that Spark reaches.

    The former one is set aside under a hidden name first and deleted last, so its rows exist until the new ones are
    in place.
    """
    paths = spark._jvm.org.apache.hadoop.fs.Path
    new, old = paths(written), paths(folder)
    aside = paths(old.getParent(), f".former-{uuid.uuid4().hex}")
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    had_rows = files.exists(old)
    if had_rows and not files.rename(old, aside):
        raise OSError(f"{folder} cannot be renamed")
    moved = False
    try:
        moved = files.rename(new, old)
    finally:
        if had_rows and not moved:
            files.rename(aside, old)
    if not moved:
        raise OSError(f"{written} cannot be renamed to {folder}")
    files.delete(aside, True)
