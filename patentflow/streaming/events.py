"""Event streams: files as they arrive, windows over event time, deduplication in bounded state."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_events(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A folder of parquet files as a stream; a batch takes all new files unless bounded."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def window_totals(
    events: DataFrame, keys: list[str], sums: list[str], width: str, slide: str | None = None, late: str = "1 hour"
) -> DataFrame:
    """`start` and `end` of tumbling or, with a `slide`, sliding windows over `ts`, the keys, `n_events` and sums.

    On a stream a window comes out once, when `late` has passed behind the latest time seen; rows
    that come when all their windows are closed are left out, and state is kept for open windows alone. On a table
    the same expression gives all windows. Rows with a NULL time are in no window; NULL keys are one key.
    """
    window = F.window("ts", width, slide or width).alias("window")
    totals = [F.sum(name).alias(name) for name in sums]
    counted = events.withWatermark("ts", late).groupBy(window, *keys).agg(F.count("*").alias("n_events"), *totals)
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n_events", *sums)


def session_totals(events: DataFrame, keys: list[str], sums: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    """Sessions of a key: `start`, `end` (the last event and the gap), `n_events` and sums.

    On a stream a session comes out once `late` has passed behind its end; open sessions that a row joins merge in
    the state. Tables are better served by `patentflow.operators.sessions`, where the events of a key need not meet.
    """
    window = F.session_window("ts", gap).alias("window")
    totals = [F.sum(name).alias(name) for name in sums]
    counted = events.withWatermark("ts", late).groupBy(window, *keys).agg(F.count("*").alias("n_events"), *totals)
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n_events", *sums)


def first_events(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The first row that came of each key. A key is forgotten when `late` has passed behind its time, and rows
    that come later than that are left out, so the state stays as large as what `late` holds."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process all files that are there and append what is final to a parquet table, each row once.

    The next call goes on from the checkpoint. A call that fails leaves the table as a reader of it saw it before;
    what it had begun is done again.
    """
    finished(
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finished(query: StreamingQuery) -> None:
    """Wait for a query that ends on its own; stop it if the caller is interrupted."""
    try:
        query.awaitTermination()
    finally:
        query.stop()
