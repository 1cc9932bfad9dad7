"""Running and trailing totals of a key's rows in order, without one task for a key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patentflow.operators.asof import DAY, position

ROWS_A_PART = 4096


def running_totals(
    rows: DataFrame, by: list[str], on: str, tie: list[str], sums: list[str], bucket: int = DAY * 1_000_000
) -> DataFrame:
    """The rows with `nth`, their number among those of the same `by` in the order of (`on`, `tie`), and
    `running_<name>`, the sum of each column up to and with them.

    NULL values of `by` are one key; NULL times come first. Rows that agree in the whole order are numbered in any
    order. NULL summands count as nothing, up to the first other one the sum is NULL.

    Rows are dealt by (by, `bucket` microseconds or units of `on`), so the rows of one key are spread over time. What
    the buckets before hold is a running total of one row a bucket, which goes ahead of the bucket's own rows; they
    are shuffled once and joined with nothing.
    """
    keys = [f"by_{i}" for i in range(len(by))]
    order = [f"order_{i}" for i in range(1 + len(tie))]
    amounts = [f"sum_{i}" for i in range(len(sums))]
    bucketed = rows.select(
        *[F.col(name).alias(key) for name, key in zip(by, keys)],
        F.floor(position(on, rows) / bucket).cast("bigint").alias("bucket"),
        *[F.col(name).alias(place) for name, place in zip([on, *tie], order)],
        F.lit(1).cast("bigint").alias("n"),
        *[F.col(name).alias(amount) for name, amount in zip(sums, amounts)],
        F.struct(*rows.columns).alias("row"),
    )
    counted = ["n", *amounts]
    buckets = bucketed.groupBy(*keys, "bucket").agg(*[F.sum(name).alias(name) for name in counted])
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select(*keys, "bucket", *[F.sum(name).over(earlier).alias(name) for name in counted])
    both = bucketed.unionByName(starts.where("n IS NOT NULL"), allowMissingColumns=True)
    is_start = F.col("row").isNull()
    inside = Window.partitionBy(*keys, "bucket").orderBy(is_start.desc(), *order)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    totals = {"nth": "n"} | {f"running_{name}": amount for name, amount in zip(sums, amounts)}
    found = both.select("row", *[F.sum(column).over(inside).alias(name) for name, column in totals.items()])
    return found.where(F.col("row").isNotNull()).select("row.*", *totals)


def trailing_rows(numbered: DataFrame, by: list[str], n_rows: int, totals: dict[str, Column]) -> DataFrame:
    """Each row with aggregates over itself and the `n_rows - 1` rows before it, by `nth` of `running_totals`.

    `totals` are aggregates by the name of their column. Rows are dealt by (by, thousands of `nth`); the last rows of
    a part go to the next one too, where they count but do not come out.
    """
    size = max(ROWS_A_PART, n_rows)
    part = F.floor((F.col("nth") - 1) / size).cast("bigint")
    is_tail = (F.col("nth") - 1) % size >= size - (n_rows - 1)
    dealt = _with_copies(numbered, part, is_tail)
    frame = Window.partitionBy(*by, "part_").orderBy("nth").rowsBetween(-(n_rows - 1), 0)
    return _own(dealt, numbered, totals, frame)


def trailing_range(
    rows: DataFrame, by: list[str], on: str, width: int, totals: dict[str, Column], bucket: int | None = None
) -> DataFrame:
    """Each row with aggregates over the rows of the same `by` whose `on` is at most `width` microseconds (or units)
    before its own, and not after; rows of the same `on` count for each other.

    Rows with a NULL `on` count for each other alone. Rows are dealt by (by, buckets of `width` or longer); each
    goes to the next bucket too, where it counts but does not come out.
    """
    bucket = max(width, bucket or width, 1)
    placed = rows.withColumn("at_", position(on, rows))
    part = F.floor(F.col("at_") / bucket).cast("bigint")
    near = F.coalesce(F.col("at_") >= (part + 1) * bucket - width, F.lit(False))
    frame = Window.partitionBy(*by, "part_").orderBy("at_").rangeBetween(-width, 0)
    return _own(_with_copies(placed, part, near), rows, totals, frame)


def _with_copies(rows: DataFrame, part: Column, goes_on: Column) -> DataFrame:
    """A row in its own part, and one in the next if it counts there."""
    parts = F.when(goes_on, F.array(part, part + 1)).otherwise(F.array(part))
    return rows.withColumn("own_", part).withColumn("part_", F.explode(parts))


def _own(dealt: DataFrame, given: DataFrame, totals: dict[str, Column], frame) -> DataFrame:
    found = dealt.select("*", *[total.over(frame).alias(name) for name, total in totals.items()])
    return found.where(F.col("own_").eqNullSafe(F.col("part_"))).select(*given.columns, *totals)
