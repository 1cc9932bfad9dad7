"""Declared schemas and the specification of the six IPC code lists."""

from typing import NamedTuple

from pyspark.sql import types as T


class CodeSpec(NamedTuple):
    """One code list: where it is read from, how it is padded and how it is encoded."""

    name: str
    tag: str
    length: int
    pad: str
    prefix: str
    dictionary: str


# Tags, list lengths, pads and feature prefixes that stored models rely on.
CODE_SPECS = (
    CodeSpec("levels", "classification-level", 2, "0A", "l", "categorical"),
    CodeSpec("sections", "section", 2, "0A", "s", "categorical"),
    CodeSpec("classes", "class", 3, "-1", "c", "numeric"),
    CodeSpec("subclasses", "subclass", 3, "0A", "sc", "categorical"),
    CodeSpec("groups", "main-group", 4, "-1", "g", "numeric"),
    CodeSpec("subgroups", "subgroup", 4, "-1", "sg", "numeric"),
)

CODE_LISTS = [spec.name for spec in CODE_SPECS]
DICTIONARIES = ("categorical", "numeric")


def feature_names(spec: CodeSpec) -> list[str]:
    return [f"{spec.prefix}_{i}" for i in range(spec.length)]


# l_0, l_1, s_0, ... sg_3: the order of the 18 features is part of the model.
TRAIN_COLS = [name for spec in CODE_SPECS for name in feature_names(spec)]


def lists_of(dictionary: str) -> list[str]:
    return [spec.name for spec in CODE_SPECS if spec.dictionary == dictionary]


def features_of(dictionary: str) -> list[str]:
    return [n for spec in CODE_SPECS if spec.dictionary == dictionary for n in feature_names(spec)]


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


DOCUMENTS = _strings("file_name", "raw_txt")
UNPACKED = _strings("archive", "file_name", "raw_txt", "error")

LISTED = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])

WALKED = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("first", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)

ARCHIVE_BLOBS = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("content", T.BinaryType())]
)

WORD_COUNTS = T.StructType(
    [T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]
)
