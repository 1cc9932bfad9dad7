"""Bounded samples of labelled rows for fitting classifiers."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def held_out(id_col: str, parts: int, part: int):
    """True for the rows whose crc32 of the id's text leaves `part` when divided by `parts`; never NULL."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(ident.cast("binary")) % parts == part


def sampled(rows: DataFrame, id_col: str, class_col: str, per_class: int) -> DataFrame:
    """At most `per_class` rows of each class, those whose ids have the smallest md5; NULL classes give none.

    Rows are first counted by the 4096 beginnings of a digest, so only those near the cut and below are
    ordered: about `per_class` and a 4096th of a class, however large it is.
    """
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    known = rows.where(F.col(class_col).isNotNull()).withColumn("digest", F.md5(ident))
    known = known.withColumn("beginning", F.substring("digest", 1, 3))
    counts = known.groupBy(class_col, "beginning").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(class_col).orderBy("beginning").rowsBetween(Window.unboundedPreceding, -1)
    near = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    wanted = near.where(F.col("before") < per_class).select(class_col, "beginning")
    few = known.join(wanted, [class_col, "beginning"], "left_semi")
    order = Window.partitionBy(class_col).orderBy("digest", id_col)
    numbered = few.withColumn("nth", F.row_number().over(order))
    return numbered.where(F.col("nth") <= per_class).select(*rows.columns)
