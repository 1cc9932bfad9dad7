"""Grouping sets, frames, sketches and JSON against brute force."""

import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patentflow import sinks
from patentflow.functions import props
from patentflow.operators import frames, sketches, totals
from patentflow.storage import scratch_dir, stage

EVENTS = "key bigint, time bigint, name bigint, amount bigint"


# Totals


def test_totals_tell_missing_keys_from_those_summed_over(spark):
    given = [("x", 1, 10), ("x", 2, 20), (None, 1, 40), (None, None, 80), ("x", None, None)]
    table = spark.createDataFrame(given, "a string, b int, amount bigint")
    found = totals.grouped_totals(table, ["a", "b"], totals.cube_sets(["a", "b"]), ["amount"])
    expected = {}
    for level, keep in ((0, (1, 1)), (1, (1, 0)), (2, (0, 1)), (3, (0, 0))):
        for a, b, amount in given:
            key = (a if keep[0] else None, b if keep[1] else None, level)
            n, total = expected.get(key, (0, None))
            expected[key] = (n + 1, total if amount is None else (total or 0) + amount)
    assert {(r.a, r.b, r.level): (r.n_rows, r.amount) for r in found.collect()} == expected
    assert found.count() == len(expected)


def test_sets_of_rollup_and_cube():
    assert totals.rollup_sets(["a", "b"]) == [["a", "b"], ["a"], []]
    assert totals.cube_sets(["a", "b"]) == [["a", "b"], ["a"], ["b"], []]


def test_totals_are_added_up_before_the_shuffle(spark):
    table = spark.createDataFrame([("x", 1)], "a string, amount bigint")
    found = totals.grouped_totals(table, ["a"], [["a"], []], ["amount"])
    text = plan(found)
    assert text.count("Exchange") == 1 and "Expand" in text and "partial_sum" in text


# Frames


def odd_events(seed):
    """A hot key, ties, long pauses, NULLs in every column."""
    draws = random.Random(seed)
    keys = [0] * 6 + [1, 2, None]
    return [
        (draws.choice(keys), draws.choice([None, *range(0, 400, 3), 10_000]), i, draws.choice([None, 1, 2, 3]))
        for i in range(500)
    ]


def in_order(events):
    found = {}
    for event in sorted(events, key=lambda e: (e[1] is not None, e[1] or 0, e[2])):
        found.setdefault(event[0], []).append(event)
    return found


def total(amounts):
    known = [a for a in amounts if a is not None]
    return sum(known) if known else None


@pytest.mark.parametrize("bucket", [1, 50, 10**6])
def test_running_totals_match_brute_force(spark, bucket):
    events = odd_events(bucket)
    table = spark.createDataFrame(events, EVENTS)
    found = frames.running_totals(table, ["key"], "time", ["name"], ["amount"], bucket)
    expected = [
        (*event, n + 1, total(e[3] for e in group[: n + 1])) for group in in_order(events).values() for n, event in enumerate(group)
    ]
    assert rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize(("n_rows", "size"), [(1, 7), (5, 7), (5, 2), (30, 4096)])
def test_trailing_rows_match_brute_force(spark, monkeypatch, n_rows, size):
    monkeypatch.setattr(frames, "ROWS_A_PART", size)
    events = odd_events(n_rows)
    numbered = frames.running_totals(spark.createDataFrame(events, EVENTS), ["key"], "time", ["name"], [], 50)
    found = frames.trailing_rows(numbered, ["key"], n_rows, {"n": F.count("*"), "total": F.sum("amount")})
    expected = []
    for group in in_order(events).values():
        for n, event in enumerate(group):
            last = group[max(0, n + 1 - n_rows) : n + 1]
            expected.append((*event, n + 1, len(last), total(e[3] for e in last)))
    assert rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize(("width", "bucket"), [(0, None), (10, None), (10, 1000), (100, None)])
def test_trailing_ranges_match_brute_force(spark, width, bucket):
    events = odd_events(width)
    table = spark.createDataFrame(events, EVENTS)
    found = frames.trailing_range(table, ["key"], "time", width, {"n": F.count("*"), "total": F.sum("amount")}, bucket)
    expected = []
    for group in in_order(events).values():
        for event in group:
            if event[1] is None:
                near = [e for e in group if e[1] is None]
            else:
                near = [e for e in group if e[1] is not None and event[1] - width <= e[1] <= event[1]]
            expected.append((*event, len(near), total(e[3] for e in near)))
    assert rows(found) == sorted(expected, key=repr)


def test_frames_of_no_rows(spark):
    none = spark.createDataFrame([], EVENTS)
    numbered = frames.running_totals(none, ["key"], "time", [], ["amount"])
    assert numbered.collect() == frames.trailing_rows(numbered, ["key"], 3, {"n": F.count("*")}).collect() == []
    assert frames.trailing_range(none, ["key"], "time", 5, {"n": F.count("*")}).collect() == []


# Sketches


def test_merged_sketches_tell_what_one_sketch_tells(spark):
    draws = random.Random(1)
    words = [(i % 4, f"w{draws.randrange(30_000)}") for i in range(60_000)] + [(0, "often")] * 5000 + [(1, None)] * 10
    table = stage(spark.createDataFrame(words, "run int, word string"))
    path = scratch_dir(spark)
    sketches.word_sketches(table, "run").write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and dict(stored.dtypes)["distinct_words"] == "binary"
    (merged,) = sketches.distinct_estimate(sketches.merge_sketches(stored)).collect()
    (whole,) = sketches.distinct_estimate(sketches.word_sketches(table)).collect()
    exact = len({w for _, w in words if w})
    assert merged.n_words == whole.n_words == sum(w is not None for _, w in words)
    assert abs(merged.n_distinct - exact) <= 0.04 * exact and abs(merged.n_distinct - whole.n_distinct) <= 0.01 * exact
    top = sketches.frequent_estimate(sketches.merge_sketches(stored), 1).collect()
    assert top[0].word == "often" and abs(top[0].n - 5000) <= 4 * len(words) / sketches.TRACKED


def test_sketches_of_no_words(spark):
    none = spark.createDataFrame([], "run int, word string")
    assert sketches.word_sketches(none, "run").collect() == []
    (empty,) = sketches.distinct_estimate(sketches.word_sketches(none)).collect()
    assert (empty.n_words, empty.n_distinct) == (0, 0)


# JSON

FIELDS = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])


@pytest.mark.parametrize(
    ("text", "read", "is_rejected"),
    [
        ('{"k": 5, "s": "a"}', (5, "a"), False),
        ('{"s": "é", "other": {"k": 1}}', (None, "é"), False),
        ("{}", (None, None), False),
        ('{"k": "five", "s": "a"}', (None, "a"), True),
        ('{"k": 5, "s": "a"', None, True),
        ("[1]", None, True),
        ("words", None, True),
        ("", None, True),
        ("  ", None, True),
        (None, None, False),
    ],
)
def test_json_is_read_or_kept(spark, text, read, is_rejected):
    table = spark.createDataFrame([(1, text)], "id int, props string")
    (row,) = props.with_parsed(table, "props", FIELDS).collect()
    assert row.rejected == (text if is_rejected else None)
    if read:
        assert tuple(row.parsed) == read


def test_counts_as_one_object(spark, tmp_path):
    import json

    counts = spark.createDataFrame([("b", 2), ('say "a"', 1), ("é", 3)], "word string, n bigint")
    sinks.write_counts_map(counts, str(tmp_path / "map"))
    (file,) = (tmp_path / "map").glob("part-*")
    assert json.loads(file.read_text(encoding="utf-8")) == {"b": 2, 'say "a"': 1, "é": 3}
