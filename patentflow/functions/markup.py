"""Text between literal markers of patent XML.

Which expression finds a marker matters: documents are long and the fields short (README, "What was
measured"). Everything is evaluated once per mention, so each helper mentions its text once where
the text is long.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markers around the fields.
TITLE_OPEN, TITLE_CLOSE = 'id="title_en">', "</invention-title>"
IPC_OPEN, IPC_CLOSE = "<classifications-ipcr>", "</classifications-ipcr>"


def before(text: Column, marker: str) -> Column:
    """Text up to the first marker, the whole text when there is none."""
    return F.substring_index(text, marker, 1)


def segment(text: Column, marker: str) -> Column:
    """Text between the first and the second marker, '' when there is none.

    The appended marker makes sure that there are two marks in a text that has one, and that only
    '' remains of a text that has none. No marker here overlaps itself.
    """
    closed = F.concat(text, F.lit(marker))
    return F.substring_index(F.substring_index(closed, marker, 2), marker, -1)


def abstract(text: Column) -> Column:
    """First paragraph of the first abstract, up to its first nested tag."""
    paragraph = before(segment(segment(text, "<abstract"), "<p"), "</p>")
    return segment(F.replace(paragraph, F.lit("<br/>"), F.lit("")), ">")


def full_abstract(text: Column) -> Column:
    """The same paragraph to its end, nested tags removed and their contents kept."""
    paragraph = before(segment(segment(text, "<abstract"), "<p"), "</p>")
    return F.regexp_replace(F.regexp_replace(paragraph, "^[^>]*>?", ""), "<[^>]*>", "")


def title(text: Column) -> Column:
    """English title. Titles in other languages may precede it; the search ends where it ends."""
    ends = f"(?:{TITLE_CLOSE}|{TITLE_OPEN}|\\z)"
    return F.regexp_extract(text, f"(?s){TITLE_OPEN}(.*?){ends}", 1)


def publication_year(text: Column) -> Column:
    """First four characters of the first date of the first document id, as a string."""
    start = F.regexp_extract(text, "(?s)<document-id>(.*?<date>.{0,20})", 1)
    return F.substring(segment(before(start, "<document-id>"), "<date>"), 1, 4)


def ipc_block(text: Column) -> Column:
    """Body of the IPC classification block; '' unless the block is closed.

    Cutting at the closing tag first leaves the short head of a document to search. That is only
    the same where the block opens before its first closing tag.
    """
    head = before(text, IPC_CLOSE)
    in_order = F.contains(head, F.lit(IPC_OPEN))
    return (
        F.when(~F.contains(text, F.lit(IPC_CLOSE)), "")
        .when(in_order, segment(head, IPC_OPEN))
        .otherwise(before(segment(text, IPC_OPEN), IPC_CLOSE))
    )
