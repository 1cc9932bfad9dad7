"""Stored sketches of words: how many distinct ones there are and which are frequent, merged without the words."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Number of registers as a power of two. The standard error of an estimate is about 1.04 / sqrt(2 ** 14), 0.8 %.
LOG_REGISTERS = 14
# Words that a sketch of frequent ones follows; counts are off by at most about a `TRACKED`th part of all words.
TRACKED = 10_000


def word_sketches(words: DataFrame, *keys: str, word_col: str = "word") -> DataFrame:
    """The keys, `n_words`, `distinct_words` and `frequent_words` of tables with a row for each occurrence of a word.

    The last two are sketches of a bounded size, to be stored and merged later. NULL words do not count. Without
    rows and keys, one row of empty sketches comes out.

    Both are built in every task and merged after one shuffle of a sketch a task and key.
    """
    word = F.col(word_col)
    sketched = words.groupBy(*keys).agg(
        F.count(word).alias("n_words"),
        F.hll_sketch_agg(word, F.lit(LOG_REGISTERS)).alias("distinct_words"),
        F.expr(f"approx_top_k_accumulate(`{word_col}`, {TRACKED})").alias("frequent_words"),
    )
    return sketched


def merge_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """One sketch for each value of the keys, or for all, as if made of the words of all."""
    return sketches.groupBy(*keys).agg(
        F.sum("n_words").alias("n_words"),
        F.hll_union_agg("distinct_words").alias("distinct_words"),
        F.expr(f"approx_top_k_combine(frequent_words, {TRACKED})").alias("frequent_words"),
    )


def distinct_estimate(sketches: DataFrame, *keys: str) -> DataFrame:
    """The keys, `n_words` and the estimated number of distinct words."""
    return sketches.select(*keys, "n_words", F.hll_sketch_estimate("distinct_words").alias("n_distinct"))


def frequent_estimate(sketches: DataFrame, limit: int, *keys: str) -> DataFrame:
    """The keys, and `word` and `n` of the `limit` words that a sketch holds for the most frequent ones."""
    found = sketches.select(*keys, F.explode(F.expr(f"approx_top_k_estimate(frequent_words, {limit})")).alias("one"))
    return found.select(*keys, F.col("one.item").alias("word"), F.col("one.count").alias("n"))
