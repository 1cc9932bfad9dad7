"""Labelled training rows from a list of known positives."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patentflow.functions import text

# Class labels and the bound on negatives.
ENERGY, OTHER = 0, 1
MAX_NEGATIVES = 2000


def positives(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose base name is in `known(base_name)`.

    No broadcast hint: Catalyst broadcasts the list while its size is below the threshold and
    shuffles both sides by base name beyond it.     """
    return _named(docs).join(known, "base_name", "left_semi").drop("base_name")


def others(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose base name is not in `known`; a path without a folder is in neither group."""
    return _named(docs).join(known, "base_name", "left_anti").drop("base_name")


def _named(docs: DataFrame) -> DataFrame:
    named = docs.withColumn("base_name", text.base_name(F.col("file_name")))
    return named.where(F.col("base_name").isNotNull())


def first_others(docs: DataFrame, known: DataFrame, limit: int = MAX_NEGATIVES) -> DataFrame:
    """The first `limit` negatives by file name, with their columns. Give it a stored table of narrow rows."""
    return first_rows(others(docs, known), limit)


def first_rows(rows: DataFrame, limit: int) -> DataFrame:
    """The first `limit` rows by file name. Names alone take part in the choice."""
    chosen = first_names(rows.select("file_name"), limit).distinct()
    return rows.join(chosen, "file_name", "left_semi").orderBy("file_name").limit(limit)


def first_names(names: DataFrame, limit: int, groups: int = 256) -> DataFrame:
    """The smallest `limit` values of the only column, repetitions included.

    They are first cut down to `limit` in each of many groups; otherwise every task of a large table
    would hand that many to the last one.
    """
    name = names.columns[0]
    number = F.pmod(F.xxhash64(name), F.lit(groups))
    nth = F.row_number().over(Window.partitionBy("number").orderBy(name))
    few = names.withColumn("number", number).withColumn("nth", nth).where(F.col("nth") <= limit)
    return few.select(name).orderBy(name).limit(limit)


def label(docs: DataFrame, known: DataFrame, max_negatives: int | None = MAX_NEGATIVES) -> DataFrame:
    """All positives as target 0 and the first negatives, or with no bound all of them, as target 1.

    One join tells the two apart; `docs` should be a stored table of narrow rows.
    """
    listed = known.distinct().withColumn("is_known", F.lit(True))
    flagged = _named(docs).join(listed, "base_name", "left").drop("base_name")
    is_known = F.coalesce("is_known", F.lit(False))
    target = F.when(is_known, ENERGY).otherwise(OTHER)
    rows = flagged.withColumn("target", target).drop("is_known")
    if max_negatives is None:
        return rows
    negatives = first_rows(rows.where(F.col("target") == OTHER), max_negatives)
    return rows.where(F.col("target") == ENERGY).unionByName(negatives)


def with_split(df: DataFrame, parts: int = 4) -> DataFrame:
    """`is_test` for one part in `parts`, decided by a hash of the file name alone."""
    digest = F.conv(F.substring(F.md5("file_name"), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("is_test", digest % parts == 0)


def shuffle_rows(df: DataFrame, seed: int = 0) -> DataFrame:
    """Random order. Meant for narrow rows of a stored table, where a retried task repeats its draws."""
    return df.orderBy(F.rand(seed))
