"""Interval join: rows whose ranges of time overlap."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentflow.operators.asof import position

# A level's buckets are this many times as long as those of the level below it.
LEVEL_FACTOR = 16
MINUTE = 60_000_000


def interval_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    base: int = MINUTE,
) -> DataFrame:
    """Pairs of rows with the same `by` whose ranges [start, end) overlap, as the columns of `left` and those of
    `right` but `by`.

    Starts and ends are times or whole numbers. Ranges that are empty or have a NULL end, and rows with a NULL in
    `by`, are in no pair. Repeated rows give repeated pairs. The two tables share no column names but `by`.

    Time is cut into buckets of `base` microseconds (or units), into ones 16 times as long at the next level, and so
    on. A range is dealt to the buckets it touches at the level of its own length, 17 at most however long it is, and
    to the one or two it touches at each higher level that the other side has ranges of. Two ranges meet at the
    higher of their levels, where the rows of a bucket that are both from lower levels are kept apart, and
    the pair counts in the bucket where the later one starts. Everything is an equality join.
    """
    lengths = [base * LEVEL_FACTOR**k for k in range(16) if base * LEVEL_FACTOR**k < 1 << 62]
    lefts, rights = _measured(left, by, left_range, lengths), _measured(right, by, right_range, lengths)
    left_levels, right_levels = _levels(lefts), _levels(rights)
    own, widths = F.col("own"), F.array(*[F.lit(length).cast("bigint") for length in lengths])

    def dealt(rows: DataFrame, others: list[int], owner: str, guest: str) -> DataFrame:
        """A row for each level, role and bucket. Two owners meet as `both`; an owner meets guests as `owner`."""
        roles = [F.when(F.array_contains(_ints(others), own), F.struct(own.alias("level"), F.lit("both").alias("role")))]
        lower = F.exists(_ints(others), lambda level: level < own)
        roles.append(F.when(lower, F.struct(own.alias("level"), F.lit(owner).alias("role"))))
        for level in others:
            roles.append(F.when(own < level, F.struct(F.lit(level).alias("level"), F.lit(guest).alias("role"))))
        meeting = F.filter(F.array(*roles), lambda role: role.isNotNull())
        at = rows.withColumn("meeting", F.explode(meeting)).select("*", "meeting.*").drop("meeting", "own")
        width = F.element_at(widths, F.col("level") + 1)
        touched = F.sequence(_bucket(F.col("start"), width), _bucket(F.col("end") - 1, width))
        return at.withColumn("width", width).withColumn("bucket", F.explode(touched))

    keys = [f"by_{i}" for i in range(len(by))]
    a = dealt(lefts, right_levels, "left", "right").withColumnsRenamed({"row": "l", "start": "l_start", "end": "l_end"})
    b = dealt(rights, left_levels, "right", "left").withColumnsRenamed({"row": "r", "start": "r_start", "end": "r_end"})
    pairs = a.join(b.drop("width"), [*keys, "level", "role", "bucket"])
    overlap = (F.col("l_start") < F.col("r_end")) & (F.col("r_start") < F.col("l_end"))
    owned = _bucket(F.greatest("l_start", "r_start"), F.col("width")) == F.col("bucket")
    columns = [F.col(f"r.{name}") for name in right.columns if name not in by]
    return pairs.where(overlap & owned).select("l.*", *columns)


def _bucket(at: Column, width: Column) -> Column:
    return F.floor(at / width).cast("bigint")


def _ints(levels: list[int]) -> Column:
    return F.array(*[F.lit(level) for level in levels]).cast("array<int>")


def _measured(rows: DataFrame, by: list[str], ends: tuple[str, str], lengths: list[int]) -> DataFrame:
    """by_0, ..., start, end, the level of the length, and the row itself; rows that meet nothing are left out."""
    start, end = (position(name, rows).cast("bigint") for name in ends)
    keys = [F.col(name).alias(f"by_{i}") for i, name in enumerate(by)]
    row = F.struct(*[F.col(name) for name in rows.columns]).alias("row")
    known = rows.select(*keys, start.alias("start"), end.alias("end"), row).where("start < end")
    for i in range(len(by)):
        known = known.where(F.col(f"by_{i}").isNotNull())
    length = F.col("end") - F.col("start")
    level = sum(((length > bound).cast("int") for bound in lengths[:-1]), F.lit(0))
    return known.withColumn("own", level)


def _levels(rows: DataFrame) -> list[int]:
    """The levels that occur, sixteen at most."""
    return sorted(row["own"] for row in rows.select("own").distinct().collect())
