"""File lists and stored tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patentflow.schemas import WORD_COUNTS


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table. The session's reader options decide about the size of its splits."""
    return spark.read.parquet(path)


def read_parts(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All parquet parts of a folder; what cannot be read of a part is left out, see `unreadable_parts`.

    Checksums of pages are compared, so damage that decodes to something is damage too.
    """
    reader = spark.read.option("ignoreCorruptFiles", True).option("parquet.page.verify-checksum.enabled", True)
    return (reader.schema(schema) if schema else reader).parquet(path)


def unreadable_parts(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """`part`, `n_rows` and `n_read` of the files of a folder that give fewer rows than they hold.

    `n_rows` is what the footer of a file promises, NULL if it has none that can be read (or promises no row);
    `n_read` is how many rows come out when every column is decoded, as with `read_parts`. All pages of all
    columns are read once, whatever columns a job goes on to use.
    """
    parts = read_parts(spark, path, schema)
    listed = spark.createDataFrame([(name,) for name in parts.inputFiles()], "part string")
    by_file = parts.withColumn("part", F.input_file_name()).groupBy("part")
    promised = by_file.agg(F.count("*").alias("n_rows"))
    # Counting the values of a column decodes its pages; the sum keeps all columns in the plan.
    n_values = sum((F.count(F.col(f"`{name}`")) for name in parts.columns), F.lit(0))
    decoded = by_file.agg(F.count("*").alias("n_read"), n_values.alias("n_values")).where("n_values >= 0")
    found = listed.join(promised, "part", "left").join(decoded.drop("n_values"), "part", "left")
    n_read = F.coalesce("n_read", F.lit(0))
    return found.select("part", "n_rows", n_read.alias("n_read")).where("n_rows IS NULL OR n_read < n_rows")


def read_file_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file as `value`."""
    return spark.read.text(path)


def _parts(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.split("value", "/").alias("parts"))


def parse_file_list(lines: DataFrame) -> DataFrame:
    """base_name of the lines that have exactly the two parts `folder/file`."""
    return _parts(lines).where(F.size("parts") == 2).select(F.get("parts", F.lit(1)).alias("base_name"))


def rejected_lines(lines: DataFrame) -> DataFrame:
    return _parts(lines).where(F.size("parts") != 2).select("value")


def read_counts(spark: SparkSession, *paths: str) -> DataFrame:
    """Stored word counts of one or several runs."""
    return spark.read.schema(WORD_COUNTS).parquet(*paths)
