"""Registered queries over events: streams, sessions, as-of and interval joins, frames, totals, JSON; archives as they
arrive."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patentflow.functions import props
from patentflow.operators import frames, totals
from patentflow.operators.asof import DAY, asof_join, position
from patentflow.operators.intervals import interval_join
from patentflow.operators.sessions import sessions
from patentflow.plans import corpus
from patentflow.schemas import CODE_LISTS
from patentflow.storage import scratch_dir, stage
from patentflow.streaming import archives as arriving
from patentflow.streaming import events as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LATE, GAP_HOURS, HOUR = "2 days", 6, 3_600_000_000
# Deliveries of a month of events, ten days each; of 50 events one comes with the delivery after its own.
DELIVERIES, DELAYED_PARTS, DELAYED_PART = 3, 50, 7
# Of 20 events one is delivered twice, and again with the delivery after its own.
REPEATED_PARTS, REPEATED_PART = 20, 3
FRAME_ROWS = 5
PROPS = T.StructType([T.StructField("k", T.LongType())])


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with their time as an instant and their value in cents, whose sums are exact."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    instant = F.timestamp_micros(position("ts", rows))
    cents = F.round(F.col("value") * 100).cast("bigint")
    return rows.select("event_id", "user_id", "event_type", "props", instant.alias("ts"), cents.alias("cents"))


def _delivery() -> F.Column:
    """The number of the ten days that an event belongs to."""
    day = F.dayofmonth(F.to_utc_timestamp("ts", F.current_timezone()))
    return F.least(F.floor((day - 1) / 10), F.lit(DELIVERIES - 1)).cast("int")


def _streamed(
    spark: SparkSession, delivered: DataFrame, process: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """What a stream query leaves after each delivery came and was taken, the query ending in between."""
    folder = scratch_dir(spark)
    rows = stage(delivered)
    schema = rows.drop("delivery").schema
    for number in range(DELIVERIES):
        part = rows.where(F.col("delivery") == number).drop("delivery")
        part.write.mode("append").parquet(f"{folder}/in")
        stream = process(streams.read_events(spark, f"{folder}/in", schema))
        streams.append_available(stream, f"{folder}/out", f"{folder}/log")
    return spark.read.parquet(f"{folder}/out")


def _with_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    delayed = F.col("event_id") % DELAYED_PARTS == DELAYED_PART
    own = _delivery()
    late = F.when(delayed, F.least(own + 1, F.lit(DELIVERIES - 1))).otherwise(own)
    return events(spark, sf_dir).withColumn("delivery", late)


def _seconds(rows: DataFrame, *keys: str) -> DataFrame:
    ends = [F.unix_seconds(name).alias(name) for name in ("start", "end")]
    return rows.select(*ends, *keys, "n_events", "cents")


@query
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals by type from three deliveries with late rows, some behind the watermark."""

    def hourly(rows: DataFrame) -> DataFrame:
        return streams.window_totals(rows, ["event_type"], ["cents"], "1 hour", late=LATE)

    return _seconds(_streamed(spark, _with_delays(spark, sf_dir), hourly), "event_type")


@query
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of six hours every two hours, from the same deliveries."""

    def sliding(rows: DataFrame) -> DataFrame:
        return streams.window_totals(rows, ["event_type"], ["cents"], "6 hours", "2 hours", late=LATE)

    return _seconds(_streamed(spark, _with_delays(spark, sf_dir), sliding), "event_type")


@query
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users that the watermark has closed; deliveries cut sessions, which go on from the state."""

    def by_user(rows: DataFrame) -> DataFrame:
        return streams.session_totals(rows, ["user_id"], ["cents"], f"{GAP_HOURS} hours", late=LATE)

    delivered = events(spark, sf_dir).withColumn("delivery", _delivery())
    found = _streamed(spark, delivered, by_user)
    ends = [F.unix_micros(name).alias(name) for name in ("start", "end")]
    return found.select(*ends, "user_id", "n_events", "cents")


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once, though some come twice and again with the next delivery."""
    rows = events(spark, sf_dir).withColumn("delivery", _delivery())
    again = rows.where(F.col("event_id") % REPEATED_PARTS == REPEATED_PART)
    later = again.withColumn("delivery", F.least(F.col("delivery") + 1, F.lit(DELIVERIES - 1)))
    delivered = rows.unionByName(again).unionByName(later)
    found = _streamed(spark, delivered, lambda stream: streams.first_events(stream, ["event_id"], LATE))
    return found.select("event_id", "user_id", "event_type", "cents")


@query
def stream_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patents from two deliveries of archives, with the batch that read them."""
    folder, out = scratch_dir(spark), scratch_dir(spark)
    docs = stage(corpus.patents(spark, sf_dir))
    for number in (0, 1):
        blobs = corpus.packed(docs.where(F.col("doc_id") % 2 == number))
        named = blobs.withColumn("path", F.concat(F.lit(f"delivery-{number}-"), "path"))
        corpus.write_archives(named, folder)
        arriving.ingest_archives(spark, folder, out)
    found = arriving.read_ingested(spark, out, "patents")
    lists = [F.array_join(name, ",").alias(name) for name in CODE_LISTS]
    return found.select("file_name", "title", "abstract", "year", "batch", *lists)


@query
def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions of users, from the table."""
    found = sessions(events(spark, sf_dir), ["user_id"], "ts", GAP_HOURS * HOUR, ["cents"])
    ends = [F.unix_micros("first_at").alias("first_at"), F.unix_micros("last_at").alias("last_at")]
    return found.select("user_id", *ends, "n_events", "cents")


@query
def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's latest view before it."""
    rows = events(spark, sf_dir)
    purchases = rows.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "cents")
    views = rows.where("event_type = 'view'").select("event_id", "user_id", "ts")
    found = asof_join(purchases, views, ["user_id"], "ts", ["event_id"], found="view")
    waited = F.unix_micros("ts") - F.unix_micros("view.ts")
    return found.select("event_id", "user_id", "cents", F.col("view.event_id").alias("view_id"), waited.alias("waited"))


@query
def join_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a user's view and error that last into each other: a minute for each 5 and 2 cents of their value."""
    rows = events(spark, sf_dir).withColumn("at", F.unix_micros("ts"))

    def lasting(kind: str, cents: int, prefix: str) -> DataFrame:
        end = F.col("at") + F.floor(F.col("cents") / cents) * 60_000_000
        kept = rows.where(F.col("event_type") == kind)
        return kept.select(
            F.col("event_id").alias(f"{prefix}_id"), "user_id", F.col("at").alias(f"{prefix}_start"), end.alias(f"{prefix}_end")
        )

    views, errors = lasting("view", 5, "view"), lasting("error", 2, "error")
    pairs = interval_join(views, errors, ["user_id"], ("view_start", "view_end"), ("error_start", "error_end"))
    shared = F.least("view_end", "error_end") - F.greatest("view_start", "error_start")
    return pairs.select("user_id", "view_id", "error_id", shared.alias("shared"))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose kind is a genuine NULL for errors, with their day and the hour of the day."""
    rows = events(spark, sf_dir)
    utc = F.to_utc_timestamp("ts", F.current_timezone())
    kind = F.nullif("event_type", F.lit("error")).alias("kind")
    return rows.select(kind, F.dayofmonth(utc).alias("day"), F.hour(utc).alias("hour"), "cents")


@query
def agg_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by kind and day, by hour, and of all; `level` tells a missing kind from one that is summed over."""
    sets = [["kind", "day"], ["hour"], []]
    return totals.grouped_totals(_dated(spark, sf_dir), ["kind", "day", "hour"], sets, ["cents"])


@query
def agg_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["kind", "day", "hour"]
    return totals.grouped_totals(_dated(spark, sf_dir), keys, totals.rollup_sets(keys), ["cents"])


@query
def agg_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["kind", "day", "hour"]
    return totals.grouped_totals(_dated(spark, sf_dir), keys, totals.cube_sets(keys), ["cents"])


@query
def window_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its number among the user's and what the user has spent up to it."""
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts", "cents")
    found = frames.running_totals(rows, ["user_id"], "ts", ["event_id"], ["cents"])
    return found.select("event_id", "user_id", "nth", "running_cents")


@query
def window_trailing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum, largest value and number of each event and the user's four before it."""
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts", "cents")
    numbered = frames.running_totals(rows, ["user_id"], "ts", ["event_id"], [])
    wanted = {"n_last": F.count("*"), "sum_last": F.sum("cents"), "max_last": F.max("cents")}
    found = frames.trailing_rows(numbered, ["user_id"], FRAME_ROWS, wanted)
    return found.select("event_id", "user_id", *wanted)


@query
def window_trailing_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of each event and the user's of the 24 hours before it."""
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts", "cents")
    wanted = {"n_day": F.count("*"), "sum_day": F.sum("cents"), "max_day": F.max("cents")}
    found = frames.trailing_range(rows, ["user_id"], "ts", DAY * 1_000_000, wanted)
    return found.select("event_id", "user_id", *wanted)


@query
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The properties of all events as columns; some are cut, of another type, of no object, or NULL."""
    kind = F.col("event_id") % 10
    spoilt = (
        F.when(kind == 1, F.substring("props", F.lit(1), F.length("props") - 1))
        .when(kind == 2, F.replace("props", F.lit(": "), F.lit(': "x')).cast("string"))
        .when(kind == 3, F.lit('{"k": "word"}'))
        .when(kind == 4, F.lit('{"other": [1, 2]}'))
        .when(kind == 5, F.lit(""))
        .when(kind != 6, F.col("props"))
    )
    read = props.with_parsed(events(spark, sf_dir).withColumn("props", spoilt), "props", PROPS)
    return read.select("event_id", F.col("parsed.k").alias("k"), F.col("parsed").isNotNull().alias("is_read"), props.REJECTED)
