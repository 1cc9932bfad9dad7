"""Sessions: runs of events with short gaps."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patentflow.operators.asof import DAY, position


def sessions(
    events: DataFrame, by: list[str], on: str, gap: int, sums: list[str] | None = None, bucket: int = DAY * 1_000_000
) -> DataFrame:
    """`by`, first and last `on` (`first_at`, `last_at`), `n_events`, and the sums of whole-number columns, of the
    runs of events of the same `by` in which each follows the one before within `gap` microseconds (or units).

    An event exactly `gap` after the one before belongs to its session, as with `session_window`. NULL
    values of `by` are one key; events with a NULL `on` are in no session. Repeated events count repeatedly.

    Rows are dealt by (by, `bucket`), so the events of one key are spread over time. Sessions are first found within
    each bucket. Only the first and the last of a bucket can go on in another, so at most two rows a bucket are
    put together again by key.
    """
    sums = sums or []
    given = events.where(F.col(on).isNotNull())
    at = position(on, given)
    rows = given.select(*by, F.col(on).alias("first_at"), F.col(on).alias("last_at"), at.alias("start"), at.alias("stop"),
                        F.floor(at / bucket).cast("bigint").alias("bucket"), F.lit(1).alias("n_events"), *sums)
    inside = _merged(rows, [*by, "bucket"], gap, sums)
    whole = Window.partitionBy(*by, "bucket")
    is_edge = (F.col("nth") == 1) | (F.col("nth") == F.max("nth").over(whole))
    marked = inside.withColumn("is_edge", is_edge).drop("nth")
    columns = [*by, "first_at", "last_at", "n_events", *sums]
    inner = marked.where(~F.col("is_edge")).select(*columns)
    edges = _merged(marked.where("is_edge").drop("is_edge", "bucket"), by, gap, sums)
    return inner.unionByName(edges.select(*columns))


def _merged(rows: DataFrame, keys: list[str], gap: int, sums: list[str]) -> DataFrame:
    """Neighbouring rows of a key put together while the gap lasts; `nth` numbers what comes out."""
    in_order = Window.partitionBy(*keys).orderBy("start", "stop")
    pause = F.col("start") - F.lag("stop").over(in_order)
    numbered = rows.withColumn("is_first", F.coalesce((pause > gap).cast("int"), F.lit(1)))
    running = in_order.rowsBetween(Window.unboundedPreceding, 0)
    numbered = numbered.withColumn("nth", F.sum("is_first").over(running))

    def total(name: str) -> Column:
        return F.sum(name).alias(name)

    return numbered.groupBy(*keys, "nth").agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
        *map(total, ["n_events", *sums]),
    )
