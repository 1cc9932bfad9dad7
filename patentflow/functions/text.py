"""Cleaning, language test, tokens, and small string helpers."""

from collections.abc import Iterable
from datetime import date

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The stop words that take effect on upper-cased text.
STOP_WORDS = ("THE", "A", "OF", "TO", "AND", "IN", "IS", "AN", "FOR", "WITH", "IF")


def english_stop_words() -> list[str]:
    """Spark's English stop words in upper case, for callers who want all of them gone."""
    return [word.upper() for word in StopWordsRemover.loadDefaultStopWords("english")]


# What cleaning replaces, in this order; "\\n" is a literal backslash and n.
CLEANING = (
    ("\n", " "),
    ("\r", " "),
    ("\\n", " "),
    ("<br/>", ""),
    ("<![CDATA[", ""),
    ("]]>", ""),
)

# Fixed value: punctuation that separates words.
PUNCTUATION = r"[.,\[\]()]"


def clean(text: Column) -> Column:
    """Line ends and leftover markup removed, outer blanks trimmed."""
    for old, new in CLEANING:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.trim(text)


def is_ascii(text: Column) -> Column:
    """True when every character is one byte long in UTF-8."""
    return F.octet_length(text) == F.length(text)


def word_text(*parts: Column) -> Column:
    """Upper-case text of the concatenated parts with punctuation blanked out."""
    return F.trim(F.upper(F.regexp_replace(F.concat(*parts), PUNCTUATION, " ")))


def split_words(text: Column) -> Column:
    """Pieces between single blanks; a run of blanks yields empty words."""
    return F.split(text, " ")


def tokens(text: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Words of a text without stop words, repeats kept."""
    stop = list(stop_words)
    return F.filter(split_words(text), lambda word: ~word.isin(stop))


def parse_list(text: Column, drop: str = "[] ") -> Column:
    """`[A, 0A]` as an array: the characters of `drop` removed, split on commas."""
    return F.split(F.translate(text, drop, ""), ",")


def parse_token_list(text: Column) -> Column:
    """A stringified token list as an array; quote marks do not survive."""
    return parse_list(text, '[] "')


def base_name(path: Column) -> Column:
    """Second part of a `folder/file` path, NULL when there is no slash."""
    return F.get(F.split(path, "/"), F.lit(1))


def compact_date(day: str) -> str:
    """`yyyy-mm-dd` as `yyyymmdd`; any other text is refused."""
    return date.fromisoformat(day).strftime("%Y%m%d")
