"""JSON texts as typed columns, and maps as JSON."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECTED = "rejected"


def with_parsed(rows: DataFrame, column: str, fields: T.StructType, parsed: str = "parsed") -> DataFrame:
    """The rows with `parsed`, a struct of the declared fields of a JSON object, and `rejected`, the text where it
    is none or where a field is of another type.

    NULL texts have a NULL struct and are not rejected. Fields that are missing are NULL; fields that are not
    declared do not matter. Of a rejected object, the fields that do fit are kept.
    """
    schema = T.StructType([*fields.fields, T.StructField(REJECTED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    read = rows.withColumn(parsed, F.from_json(column, schema, options))
    own = F.when(F.col(parsed).isNotNull(), F.struct(*[F.col(f"{parsed}.{name}").alias(name) for name in fields.names]))
    # Empty and blank texts are read as nothing at all.
    blank = F.when(F.col(column).isNotNull() & F.col(f"{parsed}.{REJECTED}").isNull() & (F.trim(column) == ""), F.col(column))
    return read.withColumn(REJECTED, F.coalesce(F.col(f"{parsed}.{REJECTED}"), blank)).withColumn(parsed, own)


def map_of(key: Column, value: Column) -> Column:
    """An aggregate: one JSON object of the keys and values of all rows, in the order of the keys. For bounded tables."""
    pairs = F.array_sort(F.collect_list(F.struct(key.alias("k"), value.alias("v"))))
    return F.to_json(F.map_from_entries(pairs))
