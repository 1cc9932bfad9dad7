"""Column functions on hand-written rows, and against DuckDB on random marker sequences."""

import random

import pandas as pd
import pytest
from helpers import values
from pyspark.sql import functions as F

from patentflow.functions import ipc, markup, text
from patentflow.operators.patents import extract_codes
from patentflow.schemas import CODE_LISTS, CODE_SPECS, DOCUMENTS


def apply(spark, function, *inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return values(df.orderBy("i").select(function(F.col("v"))))


@pytest.mark.parametrize(
    "raw, expected",
    [
        ('<abstract lang="en"><p id="p1">Foo <b>bar</b><br/> baz</p></abstract>', "Foo <b"),
        ('<abstract lang="en"><p>Plain<br/> text (x), [y].</p></abstract>', "Plain text (x), [y]."),
        ("<nothing/>", ""),
        ("<abstract></abstract>", ""),
        ("<abstract><p>open end", "open end"),
        ("<abstract></p><p>late</p></abstract>", "late"),
        ("<abstract><p>é 中</p></abstract><p>x</p>", "é 中"),
        ("<abstract>none</abstract><description><p>first</p><p>second</p>", "first"),
        (None, None),
    ],
)
def test_abstract(spark, raw, expected):
    assert apply(spark, markup.abstract, raw) == [expected]


@pytest.mark.parametrize(
    "raw, expected",
    [
        (
            'x id="title_en">Wind<br/> <![CDATA[T]]></invention-title>y',
            "Wind<br/> <![CDATA[T]]>",
        ),
        ('id="title_de">Wind</invention-title>', ""),
        ("<nothing/>", ""),
        (None, None),
    ],
)
def test_title(spark, raw, expected):
    assert apply(spark, markup.title, raw) == [expected]


def test_year(spark):
    raw = "<document-id><country>US</country><date>20190321</date></document-id>"
    other = raw.replace("2019", "1999")
    found = apply(spark, markup.publication_year, raw, raw + other, "<nothing/>", "<document-id>")
    assert found == ["2019", "2019", "", ""]


def test_block_needs_its_closing_tag(spark):
    opened = "<classifications-ipcr><x/>"
    found = apply(spark, markup.ipc_block, opened, opened + "</classifications-ipcr>", "", None)
    assert found == ["", "<x/>", "", None]


def document(*entries):
    items = "".join(
        "<classification-ipcr>"
        + "".join(f"<{tag}>{value}</{tag}>" for tag, value in entry.items())
        + "</classification-ipcr>"
        for entry in entries
    )
    return f"<doc><classifications-ipcr>{items}</classifications-ipcr></doc>"


def codes_of(spark, raw):
    docs = spark.createDataFrame([("f/a.xml", raw)], DOCUMENTS)
    return extract_codes(docs).first().asDict()


def test_code_lists(spark):
    raw = document(
        {"section": "H", "class": "02", "main-group": "3", "classification-level": "A"},
        {"section": "B", "class": "60", "main-group": "11", "subclass": "J"},
        {"section": "H", "class": "01", "subgroup": "00"},
    )
    found = codes_of(spark, raw)
    assert found["levels"] == ["A", "0A"]
    assert found["sections"] == ["H", "B"]
    assert found["classes"] == ["02", "60", "01"]
    assert found["subclasses"] == ["J", "0A", "0A"]
    assert found["groups"] == ["3", "11", "-1", "-1"]
    assert found["subgroups"] == ["00", "-1", "-1", "-1"]


def test_more_codes_than_the_list_holds(spark):
    found = codes_of(spark, document(*({"section": s, "subgroup": s} for s in "ABCDEF")))
    assert found["sections"] == ["A", "B"]
    assert found["subgroups"] == ["A", "B", "C", "D"]


def test_documents_without_block_get_pads(spark):
    found = codes_of(spark, "<doc/>")
    for spec in CODE_SPECS:
        assert found[spec.name] == [spec.pad] * spec.length


def test_null_document_gives_null_lists(spark):
    found = codes_of(spark, None)
    assert [found[name] for name in CODE_LISTS] == [None] * 6


def test_entries_keep_the_trailing_piece(spark):
    block = "<classification-ipcr>1</classification-ipcr><classification-ipcr>2</classification-ipcr>"
    found = apply(spark, lambda c: ipc.items(c), block, "")
    assert found == [["<classification-ipcr>1", "<classification-ipcr>2", ""], []]


def test_element_by_position_is_null_past_the_end(spark):
    assert values(spark.range(1).select(F.get(F.array(F.lit(1)), F.lit(3)))) == [None]


def test_clean(spark):
    found = apply(
        spark,
        text.clean,
        "Wind<br/> <![CDATA[T]]>",
        "  a\r\nb\\nc ",
        "<![CD<br/>ATA[x]]>",
        "  ",
        None,
    )
    assert found == ["Wind T", "a  b c", "x", "", None]


def test_ascii(spark):
    assert apply(spark, text.is_ascii, "plain ~\x7f\t", "é", "", "a中") == [True, False, True, False]


def test_ascii_is_the_same_before_and_after_cleaning(spark):
    raw = ["a\né", "<![CDATA[é]]>", "a<br/>b", " é ", "\\n", ""]
    before = apply(spark, text.is_ascii, *raw)
    assert before == apply(spark, lambda c: text.is_ascii(text.clean(c)), *raw)


def test_tokens(spark):
    words = apply(spark, lambda c: text.tokens(text.word_text(c)), " the Rotor (of)  a [wind], mill.")
    # three blanks, from "], ", leave two empty words
    assert words == [["ROTOR", "", "", "", "", "WIND", "", "", "MILL"]]


def test_stop_words_are_an_option(spark):
    words = apply(spark, lambda c: text.tokens(text.word_text(c), ["WIND"]), "the wind")
    assert words == [["THE"]]


def test_list_parsing(spark):
    assert apply(spark, text.parse_list, "[A, 0A]", "[]") == [["A", "0A"], [""]]
    assert apply(spark, text.parse_token_list, '[A, "B"]') == [["A", "B"]]


def test_base_name(spark):
    assert apply(spark, text.base_name, "f/a.xml", "no-slash", "x/y/z.xml") == ["a.xml", None, "y"]


def test_compact_date():
    assert text.compact_date("2024-01-31") == "20240131"
    with pytest.raises(ValueError):
        text.compact_date("../x")


def test_whole_abstract(spark):
    raw = '<abstract lang="en"><p id="p1">Foo <b>bar</b><br/> baz</p><p>no</p></abstract>'
    table = spark.createDataFrame([(raw,), ("<nothing/>",)], "raw_txt string")
    assert values(table.select(markup.full_abstract(F.col("raw_txt")))) == ["Foo bar baz", ""]


def test_english_stop_words():
    assert {"THE", "WE", "WITH"} <= set(text.english_stop_words())


PIECES = [
    "<abstract", "<p", "</p>", ">", "<br/>", "</abstract>", "<document-id>", "<date>", "1987",
    'id="title_en">', "</invention-title>", "<classifications-ipcr>", "</classifications-ipcr>",
    "é", " ", "ab", "<", "\n",
]


def test_markup_matches_sql_on_random_marker_sequences(spark, duck):
    """Mostly malformed documents: markers missing, doubled, or out of order."""
    draw = random.Random(7)
    docs = pd.DataFrame(
        {"i": range(3000), "t": ["".join(draw.choices(PIECES, k=draw.randint(1, 25))) for _ in range(3000)]}
    )
    found = (
        spark.createDataFrame(docs)
        .select(
            "i",
            markup.abstract(F.col("t")).alias("a"),
            markup.title(F.col("t")).alias("b"),
            markup.publication_year(F.col("t")).alias("c"),
            markup.ipc_block(F.col("t")).alias("d"),
        )
        .orderBy("i")
        .toPandas()
    )
    duck.register("soup", docs)
    expected = duck.sql("""
        SELECT i,
          split_part(replace(split_part(split_part(split_part(t, '<abstract', 2), '<p', 2),
            '</p>', 1), '<br/>', ''), '>', 2) AS a,
          split_part(split_part(t, 'id="title_en">', 2), '</invention-title>', 1) AS b,
          substr(split_part(split_part(t, '<document-id>', 2), '<date>', 2), 1, 4) AS c,
          CASE WHEN contains(t, '</classifications-ipcr>') THEN split_part(split_part(t,
            '<classifications-ipcr>', 2), '</classifications-ipcr>', 1) ELSE '' END AS d
        FROM soup ORDER BY i""").df()
    assert found.values.tolist() == expected.values.tolist()
    assert (expected["a"] != "").sum() > 100
