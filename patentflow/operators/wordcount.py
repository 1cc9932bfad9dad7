"""Word counts over the abstracts."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentflow.functions import text


def counted_text() -> Column:
    """Text whose words are counted: the abstract joined to itself without a blank.

    Every word therefore counts twice, and the last and first word of an abstract that does not
    end in punctuation fuse into one.
    """
    return text.word_text(F.col("abstract"), F.col("abstract"))


def count_words(
    patents: DataFrame,
    *keys: str,
    source: Column | None = None,
    stop_words: Iterable[str] = text.STOP_WORDS,
) -> DataFrame:
    """Occurrences per word (and per extra key); the empty word is counted too.

    Stop words go before quote marks do, so a quoted stop word counts. The count is partial in each
    task before the shuffle, so a frequent word costs one row per task.
    """
    pieces = text.split_words(counted_text() if source is None else source)
    words = patents.select(*keys, F.explode(pieces).alias("word"))
    kept = words.where(~F.col("word").isin(list(stop_words)))
    unquoted = kept.withColumn("word", F.replace("word", F.lit('"'), F.lit("")))
    return unquoted.groupBy(*keys, "word").agg(F.count("*").alias("n"))


def merge_counts(*partials: DataFrame) -> DataFrame:
    """Partial counts added up per word."""
    return reduce(DataFrame.unionByName, partials).groupBy("word").agg(F.sum("n").alias("n"))


def top_words(counts: DataFrame, limit: int = 1000) -> DataFrame:
    """Most frequent non-empty words, ties by word."""
    return counts.where(F.col("word") != "").orderBy(F.desc("n"), "word").limit(limit)


def rarest_first(counts: DataFrame) -> DataFrame:
    return counts.orderBy("n", "word")
