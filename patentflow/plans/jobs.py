"""The three jobs: extract patents, train the classifier, score patents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentflow import sinks
from patentflow.operators import labeling, wordcount
from patentflow.operators.dictionary import encode_features, fit_dictionaries
from patentflow.operators.model import Classifier, accuracy, fit_forest
from patentflow.operators.patents import (
    OLDER_NAMES,
    extract_codes,
    extract_reported,
    feature_table,
    from_stringified,
)
from patentflow.sources import archives, tables
from patentflow.storage import remove, stage


def extract_job(
    spark: SparkSession, archive_dir: str, out: str, glob: str = "*", max_rows: int | None = None
) -> int:
    """Write `patents`, `word_counts`, `top_words` (also as JSON lines) and `archive_errors` below `out`.

    The archives are read once: patents and damage leave that pass in one staged table, which is
    deleted in the end. The number of reports of damage is returned.
    """
    staged = f"{out}/staged"
    found = stage(extract_reported(archives.read_archives(spark, archive_dir, glob)), staged)
    errors = write_errors(spark, found, out)
    patents = found.where(F.col("error").isNull()).drop("archive", "error")
    sinks.write_table(patents, f"{out}/patents", max_rows)
    remove(spark, staged)

    written = spark.read.schema(patents.schema).parquet(f"{out}/patents")
    counts = wordcount.count_words(written)
    sinks.write_counts(counts, f"{out}/word_counts")
    write_top_words(spark, out, f"{out}/word_counts")
    return errors


def write_errors(spark: SparkSession, found: DataFrame, out: str) -> int:
    """Replace `archive_errors` below `out`, by an empty table if nothing is damaged; the number of rows."""
    sinks.write_table(archives.failures(found), f"{out}/archive_errors")
    return spark.read.parquet(f"{out}/archive_errors").count()


def write_top_words(spark: SparkSession, out: str, *count_paths: str) -> None:
    """Merge stored counts of one or several runs and write their most frequent words."""
    merged = wordcount.merge_counts(tables.read_counts(spark, *count_paths))
    sinks.write_counts(wordcount.top_words(merged), f"{out}/top_words")
    sinks.write_counts_json(tables.read_counts(spark, f"{out}/top_words"), f"{out}/top_words_json")


def training_job(
    spark: SparkSession,
    archive_dir: str,
    positives: str,
    out: str,
    glob: str = "*",
    max_negatives: int | None = labeling.MAX_NEGATIVES,
    documents_out: str | None = None,
    errors_out: str | None = None,
) -> int:
    """Write the labelled training table from archives and a list of positive files.

    The codes of all documents are staged once as a narrow table, with the damage met on the way; the
    join and the choice of negatives read that table, not the archives. Damage is written to
    `archive_errors` below `errors_out`, or else below `<out>_errors`; the number of reports is returned.
    On request the raw documents behind the training rows are kept as well, which reads the archives a
    second time.
    """
    staged = f"{out}_staged"
    unpacked = archives.read_archives(spark, archive_dir, glob)
    found = stage(extract_codes(unpacked, ("archive", "error", "file_name")), staged)
    errors = write_errors(spark, found, errors_out or f"{out}_errors")
    codes = found.where(F.col("error").isNull()).drop("archive", "error")
    known = tables.parse_file_list(tables.read_file_list(spark, positives))
    sinks.write_table(labeling.label(codes, known, max_negatives), out)
    remove(spark, staged)
    if documents_out:
        labels = spark.read.parquet(out).select("file_name", "target").distinct()
        docs = archives.documents(archives.read_archives(spark, archive_dir, glob))
        sinks.write_by_target(docs.join(labels, "file_name"), documents_out)
    return errors


def fit_classifier(training: DataFrame, **forest) -> tuple[Classifier, DataFrame]:
    """A classifier fitted on three quarters of the rows, and its accuracy on the fourth.

    The dictionaries see all rows, held-out ones included.
    """
    dictionaries = stage(fit_dictionaries(training))
    features = feature_table(training.transform(labeling.with_split), "target", "is_test")
    encoded = stage(encode_features(features, dictionaries))
    model = fit_forest(encoded.where(~F.col("is_test")), **forest)
    score = accuracy(model.transform(encoded.where("is_test")))
    return Classifier(model, dictionaries), score


def read_codes(rows: DataFrame) -> DataFrame:
    """Rows with code lists as arrays; older tables hold them as text under older names."""
    is_older = any(name in rows.columns for name in OLDER_NAMES)
    return from_stringified(rows) if is_older else rows


def fit_job(spark: SparkSession, training: str, model_dir: str, **forest) -> float:
    """Fit on a stored training table, older ones included, save the model, return the accuracy."""
    classifier, score = fit_classifier(read_codes(spark.read.parquet(training)), **forest)
    classifier.save(model_dir)
    return score.first()["accuracy"]


def score_job(
    spark: SparkSession,
    patents: str,
    model_dir: str,
    out: str,
    day: str,
    skip_unreadable: bool = False,
) -> None:
    """Write title, abstract and year of the energy patents under the run date. Older tables are read too.

    Leaving unreadable parts out is a choice of the caller: Spark cannot tell a broken file from
    one that its storage failed to deliver. Their names are then written to `<out>_unreadable`.
    """
    classifier = Classifier.load(spark, model_dir)
    read = tables.read_parts if skip_unreadable else tables.read_table
    found = classifier.energy_patents(read_codes(read(spark, patents)))
    sinks.write_dated(found, out, day)
    if skip_unreadable:
        sinks.write_table(tables.unreadable_parts(spark, patents), f"{out}_unreadable")
