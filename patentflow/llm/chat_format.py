"""Conversations as training text: rendered, parsed back, and escaped until both agree."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNED_ROLE = "assistant"

# The grammar: a turn is a line break, "### role: body</turn>"; a conversation is its turns.
OPENING, ROLE_END, CLOSING = "\n### ", ": ", "</turn>"

# Escapes, in the order they are applied; they are read in reverse. An escaped string has no "<", no ":" and no "#",
# so none of the strings of the grammar, and every backslash in it starts an escape, so reading one escape never makes
# another.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (":", "\\c"), ("#", "\\h"))


def escaped(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def rendered(role: Column, body: Column) -> Column:
    return F.concat(F.lit(OPENING), role, F.lit(ROLE_END), body, F.lit(CLOSING))


def parsed(formatted: Column) -> Column:
    """Array of (role, text): a turn ends at the closing string, its role at the first colon and blank."""
    pieces = F.split(formatted, CLOSING)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, ROLE_END, 1)
        role = F.substr(head, F.lit(len(OPENING) + 1))
        body = F.substr(piece, F.char_length(head) + F.lit(len(ROLE_END) + 1))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def safe_turns(rows: DataFrame) -> DataFrame:
    """Add `safe_role` and `safe_text`: as they are if the turn alone reads back and opens once, else escaped.

    An escaped turn holds none of the strings of the grammar.
    """
    role, text = F.col("role"), F.col("text")
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    opens_again = F.contains(role, F.lit(OPENING)) | F.contains(text, F.lit(OPENING))
    checked = rows.withColumn("is_plain", ~opens_again & (parsed(rendered(role, text)) == source))
    return checked.withColumns(
        {
            "safe_role": F.when(F.col("is_plain"), role).otherwise(escaped(role)),
            "safe_text": F.when(F.col("is_plain"), text).otherwise(escaped(text)),
        }
    ).drop("is_plain")


def _formatted(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: rendered(t["safe_role"], t["safe_text"])), "")


def _segments(turn: Column, learned_role: str) -> Column:
    """The pieces of a rendered turn: up to the body, the body, the closing string."""
    head = F.concat(F.lit(OPENING), turn["safe_role"], F.lit(ROLE_END))
    learned = turn["role"] == learned_role
    return F.array(
        F.struct(head.alias("text"), F.lit(False).alias("loss")),
        F.struct(turn["safe_text"].alias("text"), learned.alias("loss")),
        F.struct(F.lit(CLOSING).alias("text"), F.lit(False).alias("loss")),
    )


def format_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", learned_role: str = LEARNED_ROLE
) -> DataFrame:
    """conv_id, formatted, segments, turns of each conversation in `rows(conv_id, turn, role, text)`.

    `formatted` is the text; `segments` are its pieces in order as (text, loss), true for the bodies of the
    learned role; `turns` are (role, text) parsed back from `formatted`. Turns that do not survive the
    round trip by themselves or hold the opening string are escaped; a conversation whose parsed turns still differ
    from the source is escaped as a whole, which always reads back.

    NULL roles and texts are empty. Turns with equal numbers follow in order of role and text, NULL
    numbers come first, repeated rows are repeated turns, NULL conversation ids are one conversation. An
    empty table gives no rows. A conversation is one string, and so must fit one task: below 2 GB.
    """
    clean = rows.select(
        F.col(conv_col),
        F.col(turn_col).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turn = F.struct("turn", "role", "text", "safe_role", "safe_text")
    grouped = safe_turns(clean).groupBy(conv_col).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    first = grouped.withColumn("agrees", parsed(_formatted(F.col("turns"))) == source)
    all_escaped = F.transform(
        "turns",
        lambda t: F.struct(
            t["turn"].alias("turn"),
            t["role"].alias("role"),
            t["text"].alias("text"),
            escaped(t["role"]).alias("safe_role"),
            escaped(t["text"]).alias("safe_text"),
        ),
    )
    second = first.withColumn("turns", F.when(F.col("agrees"), F.col("turns")).otherwise(all_escaped))
    segments = F.flatten(F.transform("turns", lambda t: _segments(t, learned_role)))
    final = second.select(conv_col, _formatted(F.col("turns")).alias("formatted"), segments.alias("segments"))
    return final.withColumn("turns", parsed(F.col("formatted")))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
