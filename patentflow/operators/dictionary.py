"""Code dictionaries: value -> 0-based id, and their use on feature columns."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patentflow.schemas import CODE_SPECS, DICTIONARIES, TRAIN_COLS, features_of, lists_of

UNSEEN = -1
PADS = sorted({spec.pad for spec in CODE_SPECS})
SALTS = 64


def _values(df: DataFrame) -> DataFrame:
    """Distinct (dictionary, value) of all list columns, from one pass over the table."""
    lists = [
        F.struct(F.lit(name).alias("dictionary"), F.concat(*lists_of(name)).alias("values"))
        for name in DICTIONARIES
    ]
    rows = df.select(F.inline_outer(F.array(*lists))).where(F.col("dictionary").isNotNull())
    return rows.select("dictionary", F.explode("values").alias("value")).distinct()


def fit_dictionaries(df: DataFrame) -> DataFrame:
    """(dictionary, value, id): both dictionaries, each numbered in the order of its values.

    Numbering runs per two-character prefix and adds the size of all smaller prefixes, so no task
    sorts a whole vocabulary. With a left join, and without names that
    may be NULL, both uses of the distinct values keep the same plan and share one exchange.
    """
    keys = ["dictionary", "prefix"]
    values = _values(df).withColumn("prefix", F.substring("value", 1, 2))
    sizes = values.groupBy(*keys).agg(F.count("*").alias("size"))
    in_order = Window.partitionBy("dictionary").orderBy("prefix")
    offsets = sizes.select(*keys, (F.sum("size").over(in_order) - F.col("size")).alias("offset"))
    position = F.row_number().over(Window.partitionBy(*keys).orderBy("value"))
    numbered = values.withColumn("position", position).join(offsets, keys, "left")
    number = (F.col("offset") + F.col("position") - 1).cast("int")
    return numbered.select("dictionary", "value", number.alias("id"))


def dictionary_of(dictionaries: DataFrame, name: str) -> DataFrame:
    """(value, id) of one dictionary."""
    return dictionaries.where(F.col("dictionary") == name).select("value", "id")


def encode_columns(
    df: DataFrame, dictionary: DataFrame, columns: Iterable[str], salts: int = SALTS
) -> DataFrame:
    """Replace the values of scalar columns by their ids, values without an id by -1.

    Most rows may hold a pad. Where the join shuffles, pads would all meet in one task, so they get a
    salt from a hash of their row, and the dictionary has a copy of them for each salt.
    """
    is_pad = F.col("value").isin(PADS)
    copies = F.when(is_pad, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = dictionary.select("value", "id", F.explode(copies).alias("salt"))
    row_hash = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")
    df = df.withColumn("row_salt", row_hash)
    for name in columns:
        ids = salted.select(F.col("value").alias(name), "salt", F.col("id").alias(f"{name}_id"))
        keyed = df.withColumn("salt", F.when(F.col(name).isin(PADS), F.col("row_salt")).otherwise(0))
        found = F.coalesce(F.col(f"{name}_id"), F.lit(UNSEEN))
        df = keyed.join(ids, [name, "salt"], "left").withColumn(name, found).drop(f"{name}_id", "salt")
    return df.drop("row_salt")


def encode_features(features: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """The 18 feature columns as dictionary ids; give it staged dictionaries.

    One lookup join per column. A staged dictionary has a known size, so each join is a broadcast
    hash join against the same reused broadcast while the dictionary is small, and a sort-merge
    join when it is not.
    """
    kept = [name for name in features.columns if name not in TRAIN_COLS]
    for name in DICTIONARIES:
        ids = dictionary_of(dictionaries, name)
        features = encode_columns(features, ids, features_of(name))
    return features.select(*kept, *TRAIN_COLS)
