"""Raw documents to patent rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentflow.functions import ipc, markup, text
from patentflow.schemas import CODE_SPECS


# Column names of older tables and their names here.
OLDER_NAMES = {"clasess": "classes", "subclasess": "subclasses"}

FIELDS = {
    "title": markup.title,
    "abstract": markup.abstract,
    "year": markup.publication_year,
    "ipc_block": markup.ipc_block,
}


def extract_fields(docs: DataFrame, *names: str, keep: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """The `keep` columns and the named fields (all of them by default), as they stand in the markup.

    The fields leave through a one-element generator. Catalyst pushes filters through projections
    by repeating their expressions, which would search each document again for every predicate on
    an extracted field; it does not push them through a generator.
    """
    wanted = [FIELDS[name](F.col("raw_txt")).alias(name) for name in names or FIELDS]
    found = docs.select(*keep, F.array(F.struct(*wanted)).alias("fields"))
    return found.select(*keep, F.inline_outer("fields"))


def keep_complete(fields: DataFrame) -> DataFrame:
    """Rows that have both an abstract and a title."""
    return fields.where((F.col("abstract") != "") & (F.col("title") != ""))


def keep_english(fields: DataFrame) -> DataFrame:
    """Rows whose abstract and title are plain ASCII.

    Cleaning only removes or replaces ASCII characters, so this may run before it and spare the
    rows it drops the cleaning.
    """
    return fields.where(text.is_ascii(F.col("abstract")) & text.is_ascii(F.col("title")))


def clean_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: text.clean(F.col(name)) for name in names})


def extract_patents(docs: DataFrame) -> DataFrame:
    """Complete English patents: file_name, abstract, title, year and the six code lists."""
    kept = extract_fields(docs).transform(keep_complete).transform(keep_english)
    return _cleaned(kept, "file_name")


def extract_reported(unpacked: DataFrame) -> DataFrame:
    """The same of unpacked archives, together with the damage met: rows with `archive` and `error` alone."""
    keep = ("archive", "error", "file_name")
    fields = extract_fields(unpacked, keep=keep).withColumn("is_damage", F.col("error").isNotNull())
    whole = (F.col("abstract") != "") & (F.col("title") != "")
    english = text.is_ascii(F.col("abstract")) & text.is_ascii(F.col("title"))
    return _cleaned(fields.where(F.col("is_damage") | (whole & english)), *keep)


def _cleaned(fields: DataFrame, *keep: str) -> DataFrame:
    cleaned = fields.transform(clean_columns, "abstract", "title")
    return with_code_lists(cleaned, *keep, "abstract", "title", "year")


def extract_codes(docs: DataFrame, keep: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """The `keep` columns and the six code lists of every document, unfiltered."""
    block = markup.ipc_block(F.col("raw_txt")).alias("ipc_block")
    return with_code_lists(docs.select(*keep, block), *keep)


def with_code_lists(df: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and the code lists of `ipc_block`.

    The entries are a column of their own: lambda functions keep Spark from sharing common
    subexpressions, so each of the six lists would cut the block up again.
    """
    entries = df.select(*keep, ipc.items(F.col("ipc_block")).alias("items"))
    return entries.select(*keep, *ipc.code_lists(F.col("items")))


def feature_table(patents: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and the 18 scalar feature columns."""
    return patents.select(*keep, *ipc.feature_columns())


def with_row_id(df: DataFrame) -> DataFrame:
    """Unique, not consecutive ids; no shuffle, and no id survives a change of the file layout."""
    return df.withColumn("row_id", F.monotonically_increasing_id())


def from_stringified(df: DataFrame) -> DataFrame:
    """Import of older tables that hold the lists as text under two misspelt names."""
    renamed = df.withColumnsRenamed(OLDER_NAMES)
    return renamed.withColumns({s.name: text.parse_list(F.col(s.name)) for s in CODE_SPECS})
