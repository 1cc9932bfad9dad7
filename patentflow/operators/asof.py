"""As-of join: for each row the latest row of another table that is not later."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = 86_400


def position(name: str, df: DataFrame) -> Column:
    """A time as microseconds, those without a zone as of UTC, or a number as it is."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.from_utc_timestamp(F.col(name).cast("timestamp"), F.current_timezone()))
    return F.unix_micros(name) if isinstance(kind, T.TimestampType) else F.col(name)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    on: str,
    tie: list[str] | None = None,
    found: str = "found",
    bucket: float = DAY * 1_000_000,
) -> DataFrame:
    """All rows of `left` and, as a struct `found`, the row of `right` of the same `by` with the largest `on` that
    is not after theirs; NULL if there is none.

    Of rows of `right` with the same `by` and `on` the one with the largest `tie` columns counts. `on` is a
    time or a number in both tables. A NULL in `by` or `on` meets nothing: such rows of `left` stay without a match.
    Repeated rows of `left` stay repeated, columns may have any names.

    Rows are dealt by (by, `bucket` microseconds or units of `on`), so the rows of one key are spread over time.
    Within a bucket the last row of `right` is carried forward; what a bucket starts with is the last row of the
    buckets before it, carried over one row a bucket. Nothing is joined row by row.
    """
    keys = [f"by_{i}" for i in range(len(by))]
    ties = [f"tie_{i}" for i in range(len(tie or []))]
    given = F.struct(*[F.col(name) for name in left.columns])
    other = F.struct(*[F.col(name) for name in right.columns])

    def placed(rows: DataFrame, side: int) -> DataFrame:
        at = position(on, rows)
        columns = [F.col(name).alias(key) for name, key in zip(by, keys)]
        orders = [F.col(name) if side == 0 else F.lit(None).cast(right.schema[name].dataType) for name in tie or []]
        return rows.select(
            *columns,
            at.alias("at"),
            F.floor(at / bucket).cast("bigint").alias("bucket"),
            F.lit(side).alias("side"),
            *[order.alias(name) for order, name in zip(orders, ties)],
            (given if side else F.lit(None).cast(_struct_of(left))).alias("given"),
            (F.lit(None).cast(_struct_of(right)) if side else other).alias("other"),
        )

    meets = F.lit(True)
    for name in [*keys, "at"]:
        meets = meets & F.col(name).isNotNull()
    both = placed(right, 0).where(meets).unionByName(placed(left, 1))
    order = ["at", "side", *ties]
    inside = Window.partitionBy(*keys, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("inside", F.last("other", ignorenulls=True).over(inside))

    rank = F.when(F.col("side") == 0, F.struct("at", *ties))
    ends = both.groupBy(*keys, "bucket").agg(F.max_by("other", rank).alias("final"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*keys, "bucket", F.last("final", ignorenulls=True).over(earlier).alias("before"))
    asked = carried.where("side = 1").drop("other", "side", *ties)
    matched = asked.join(starts, [*keys, "bucket"], "left")
    best = F.when(meets, F.coalesce("inside", "before"))
    return matched.select("given", best.alias("best")).select("given.*", F.col("best").alias(found))


def _struct_of(df: DataFrame) -> T.StructType:
    """The row type, with every field open to NULL."""
    return T.StructType([T.StructField(field.name, field.dataType, True) for field in df.schema])
