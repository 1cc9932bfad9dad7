"""From raw documents to the token digests of a training mix: each stage a Parquet table of documents.

NULL and empty texts are texts like any other in every stage: scored, equal to each other, with a fingerprint of zero,
of size nothing for the mix, and without tokens. NULL in another column, repeated rows and very long texts go through
as the operators say; columns that are not those of documents stay with their rows, whatever they are called, up to
the last stage, which gives digests alone. Empty tables give empty tables.
"""

from pyspark.sql import DataFrame, SparkSession

from patentflow.llm import exact_dedup, mixing, simhash_dedup, toxicity
from patentflow.llm.queries import bounded_batches, bpe_digests, vocabulary
from patentflow.storage import stage

# Length of the shingles of a fingerprint, and the most bits in which near copies differ.
NEAR_WORDS, NEAR_BITS = 3, 2
# No SQL for fitting a classifier, fingerprints or tokens: tests hold the stages against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels, does not reject. Without labels all stay."""
    bounded_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those that are equal but for white space: the longest, then the one with the smallest id; of
    rows that agree in all this, one."""
    bounded_batches(spark)
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of close fingerprints, of shingles of three words and at most two bits apart: the one
    with the smallest id. Rows without an id stay unless they share a fingerprint."""
    bounded_batches(spark)
    return simhash_dedup.one_of_each(docs, words=NEAR_WORDS, max_bits=NEAR_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them: repeated, once or not at all, the same in every run.
    A NULL source is a source."""
    return mixing.mixed(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the text decoded from them, for each row of the mix."""
    bounded_batches(spark)
    return bpe_digests(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
