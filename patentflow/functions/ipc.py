"""IPC entries, their codes, fixed-length lists and the 18 scalar features."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from patentflow.schemas import CODE_SPECS, CodeSpec, feature_names


def items(block: Column) -> Column:
    """One string per classification entry, the piece behind the last entry included."""
    entries = F.split(block, r"\Q</classification-ipcr>\E")
    return F.when(block == "", F.array().cast("array<string>")).otherwise(entries)


def tag_values(entries: Column, tag: str) -> Column:
    """Distinct non-empty values of one tag, in the order the entries name them."""
    opened, closed = f"<{tag}>", f"</{tag}>"

    def value(entry: Column) -> Column:
        inner = F.split_part(F.split_part(entry, F.lit(opened), F.lit(2)), F.lit(closed), F.lit(1))
        return F.when(F.contains(entry, F.lit(closed)), inner).otherwise("")

    return F.array_distinct(F.array_remove(F.transform(entries, value), ""))


def pad(values: Column, length: int, filler: str) -> Column:
    """Exactly `length` elements: cut when longer, filled up when shorter."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(filler), length)), 1, length)


def code_list(entries: Column, spec: CodeSpec) -> Column:
    return pad(tag_values(entries, spec.tag), spec.length, spec.pad)


def code_lists(entries: Column) -> list[Column]:
    """The six padded code lists of a column of entries."""
    return [code_list(entries, spec).alias(spec.name) for spec in CODE_SPECS]


def feature_columns() -> list[Column]:
    """The six lists fanned out to 18 scalar columns; NULL where a list is too short."""
    return [
        F.get(F.col(spec.name), F.lit(i)).alias(name)
        for spec in CODE_SPECS
        for i, name in enumerate(feature_names(spec))
    ]
