"""Sessions, as-of and interval joins against brute force, and streams across restarts, late rows and failures."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from patentflow.operators.asof import asof_join
from patentflow.operators.intervals import interval_join
from patentflow.operators.sessions import sessions
from patentflow.streaming import archives as arriving
from patentflow.streaming import events as streams

EVENTS = "event_id bigint, user_id bigint, ts timestamp, cents bigint"
START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


# Sessions


def brute_sessions(events, gap):
    """(user, first, last, n, sum) of (user, time, amount)."""
    found = {}
    for user, time, amount in sorted((e for e in events if e[1] is not None), key=lambda e: (repr(e[0]), e[1])):
        runs = found.setdefault(user, [])
        if runs and time - runs[-1][1] <= gap:
            runs[-1] = [runs[-1][0], time, runs[-1][2] + 1, runs[-1][3] + amount]
        else:
            runs.append([time, time, 1, amount])
    return sorted(((user, *run) for user, runs in found.items() for run in runs), key=repr)


@pytest.mark.parametrize("bucket", [1, 7, 50, 10_000])
def test_sessions_match_brute_force(spark, bucket):
    """A hot user, ties, repeated events, gaps hit exactly, sessions over many buckets, NULLs."""
    draws = random.Random(bucket)
    events = [(0, draws.randrange(2000), draws.randrange(9)) for _ in range(400)]
    events += [(draws.choice([1, 2, 3, None]), draws.randrange(500), 1) for _ in range(200)]
    events += [(4, time, 1) for time in (0, 5, 10, 16, 16, 21, -5, -11)] + [(5, None, 1), (6, 3, None)]
    table = spark.createDataFrame(events, "user bigint, time bigint, amount bigint").withColumn("start", F.lit(0))
    found = sessions(table, ["user"], "time", 5, ["amount"], bucket)
    assert found.columns == ["user", "first_at", "last_at", "n_events", "amount"]
    expected = brute_sessions([(u, t, a or 0) for u, t, a in events], 5)
    assert sorted((tuple(v if v is not None or i == 0 else 0 for i, v in enumerate(r)) for r in rows(found)), key=repr) == expected


def test_sessions_agree_with_session_window(spark):
    draws = random.Random(5)
    times = [at(draws.randrange(300)) for _ in range(200)] + [at(1000), at(1006), at(1012, ), at(1018) + timedelta(microseconds=1)]
    table = spark.createDataFrame([(i, i % 3, t, i) for i, t in enumerate(times)], EVENTS)
    ours = sessions(table, ["user_id"], "ts", 6 * 3_600_000_000, ["cents"])
    theirs = streams.session_totals(table, ["user_id"], ["cents"], "6 hours")
    six = F.expr("INTERVAL 6 HOURS")
    ends = theirs.select("user_id", F.col("start").alias("first_at"), (F.col("end") - six).alias("last_at"), "n_events", "cents")
    assert rows(ours) == rows(ends)


def test_events_of_a_user_are_dealt_by_time(spark):
    table = spark.createDataFrame([(1, i, 1) for i in range(10)], "user bigint, time bigint, amount bigint")
    text = plan(sessions(table, ["user"], "time", 2, [], 3))
    assert "bucket" in text.split("hashpartitioning(")[-1].split(")")[0] or text.count("bucket") > 2


def test_no_events_have_no_sessions(spark):
    none = spark.createDataFrame([], "user bigint, time bigint, amount bigint")
    assert sessions(none, ["user"], "time", 5, ["amount"]).collect() == []


# As-of join


def brute_asof(left, right):
    found = []
    for key, time, name in left:
        fits = [r for r in right if None not in (key, time, r[0], r[1]) and r[0] == key and r[1] <= time]
        best = max(fits, key=lambda r: (r[1], r[2]), default=None)
        found.append((key, time, name, best and best[2]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("bucket", [1, 10, 100_000])
def test_asof_matches_brute_force(spark, bucket):
    """A hot key, ties in time, long pauses, keys on one side only, NULLs, repeated rows, clashing names."""
    draws = random.Random(bucket)

    def side(n, names):
        keys = [0] * 6 + [1, 2, 3, None]
        return [(draws.choice(keys), draws.choice([None, *range(0, 3000, 7)]), draws.randrange(names)) for _ in range(n)]

    left, right = side(300, 10**6) + [(9, 5, 1), (7, 900, 5), (7, 900, 5)], side(200, 5) + [(8, 5, 1), (7, 0, 3)]
    schema = "key bigint, time bigint, name bigint"
    lefts = spark.createDataFrame(left, schema).withColumnRenamed("name", "bucket")
    rights = spark.createDataFrame(right, schema).withColumn("side", F.lit("x"))
    found = asof_join(lefts, rights, ["key"], "time", ["name"], "last", bucket)
    assert found.columns == ["key", "time", "bucket", "last"]
    assert rows(found.select("key", "time", "bucket", "last.name")) == brute_asof(left, right)


def test_asof_of_empty_tables(spark):
    schema = "key bigint, time bigint, name bigint"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([(1, 1, 1)], schema)
    assert asof_join(none, one, ["key"], "time").collect() == []
    assert [r.found for r in asof_join(one, none, ["key"], "time").collect()] == [None]


# Interval join


def brute_overlaps(left, right):
    return sorted(
        (
            (a[3], b[3])
            for a in left
            for b in right
            if None not in (*a, *b) and a[0] == b[0] and a[1] < a[2] and b[1] < b[2] and a[1] < b[2] and b[1] < a[2]
        ),
        key=repr,
    )


def overlaps(spark, left, right, base):
    lefts = spark.createDataFrame(left, "key bigint, a bigint, b bigint, left_id bigint")
    rights = spark.createDataFrame(right, "key bigint, c bigint, d bigint, right_id bigint")
    return interval_join(lefts, rights, ["key"], ("a", "b"), ("c", "d"), base)


@pytest.mark.parametrize("base", [1, 10, 100_000])
def test_overlaps_match_brute_force(spark, base):
    """Short and very long ranges, touching and empty ones, NULLs, negative times, repeated rows."""
    draws = random.Random(base)

    def ranges(n):
        made = []
        for i in range(n):
            start = draws.randrange(-2000, 2000)
            made.append((draws.choice([0, 0, 0, 1]), start, start + draws.choice([0, 1, 5, 30, 300, 100_000, -4]), i))
        return made + [(1, 5, 10, 1000), (1, 10, 15, 1001), (1, 10, 15, 1001), (None, 0, 9, 1002), (1, None, 9, 1003), (1, 3, None, 1004)]

    left, right = ranges(120), ranges(100) + [(0, -(10**12), 10**12, 2000)]
    found = overlaps(spark, left, right, base)
    assert found.columns == ["key", "a", "b", "left_id", "c", "d", "right_id"]
    assert rows(found.select("left_id", "right_id")) == brute_overlaps(left, right)


def test_overlaps_are_an_equality_join(spark):
    found = overlaps(spark, [(0, 1, 5, 1)], [(0, 2, 9, 2)], 2)
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Join" in text


def test_a_long_range_makes_few_rows(spark):
    """However long a range is, it is in 17 buckets of its own level at most."""
    found = overlaps(spark, [(0, 0, 10**15, 1)], [(0, 5, 6, 2), (0, 10**14, 10**14 + 1, 3)], 1)
    assert rows(found.select("left_id", "right_id")) == [(1, 2), (1, 3)]
    explode = found.sparkSession.createDataFrame([(0, 0, 10**15, 1)], "key bigint, a bigint, b bigint, left_id bigint")
    others = found.sparkSession.createDataFrame([(0, 0, 10**15, 1)], "key bigint, c bigint, d bigint, right_id bigint")
    assert interval_join(explode, others, ["key"], ("a", "b"), ("c", "d"), 1).count() == 1


def test_overlaps_of_empty_tables(spark):
    some = [(0, 1, 5, 1)]
    assert overlaps(spark, [], [], 1).collect() == overlaps(spark, some, [], 1).collect() == overlaps(spark, [], some, 1).collect() == []


# Streams


def deliver(spark, folder, events):
    spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def take(spark, folder, process):
    stream = process(streams.read_events(spark, f"{folder}/in", spark.createDataFrame([], EVENTS).schema))
    streams.append_available(stream, f"{folder}/out", f"{folder}/log")
    return spark.read.parquet(f"{folder}/out")


def hourly(rows):
    return streams.window_totals(rows, ["user_id"], ["cents"], "1 hour", late="2 hours")


def test_late_rows_inside_and_behind_the_watermark(spark, tmp_path):
    folder = str(tmp_path)
    deliver(spark, folder, [(1, 0, at(0.5), 1), (2, 0, at(5.5), 2), (3, None, at(0.2), 4), (4, 0, None, 9)])
    # The watermark is at 3:30, so windows up to three o'clock are closed.
    found = take(spark, folder, hourly)
    assert {(r.start, r.user_id, r.cents) for r in found.collect()} == {(at(0), 0, 1), (at(0), None, 4)}
    deliver(spark, folder, [(5, 0, at(2.9), 100), (6, 0, at(3.1), 8), (7, 0, at(20), 16)])
    found = take(spark, folder, hourly)
    totals = {(r.start, r.user_id): r.cents for r in found.collect()}
    assert totals == {(at(0), 0): 1, (at(0), None): 4, (at(3), 0): 8, (at(5), 0): 2}
    assert take(spark, folder, hourly).count() == 4


def test_a_stream_without_late_rows_equals_the_table(spark, tmp_path):
    folder, draws = str(tmp_path), random.Random(2)
    events = sorted(((i, i % 3, at(draws.random() * 100), i) for i in range(300)), key=lambda e: e[2])
    for part in (events[:100], events[100:200], events[200:]):
        deliver(spark, folder, part)

        def sliding(rows):
            return streams.window_totals(rows, ["user_id"], ["cents"], "6 hours", "2 hours", "1 hour")

        found = take(spark, folder, sliding)
    closed = F.col("end") <= F.lit(max(e[2] for e in events) - timedelta(hours=1))
    assert rows(found) == rows(sliding(spark.createDataFrame(events, EVENTS)).where(closed))


def test_sessions_go_on_across_a_restart(spark, tmp_path):
    folder = str(tmp_path)

    def by_user(rows):
        return streams.session_totals(rows, ["user_id"], ["cents"], "2 hours", "1 hour")

    deliver(spark, folder, [(1, 0, at(1), 1), (2, 0, at(2), 2)])
    assert take(spark, folder, by_user).count() == 0
    deliver(spark, folder, [(3, 0, at(3.5), 4), (4, 1, at(30), 8)])
    (session,) = take(spark, folder, by_user).collect()
    assert (session.start, session.end, session.n_events, session.cents) == (at(1), at(5.5), 3, 7)


def test_repeated_events_come_once_across_restarts(spark, tmp_path):
    folder = str(tmp_path)

    def once(rows):
        return streams.first_events(rows, ["event_id"], "2 hours")

    deliver(spark, folder, [(1, 0, at(1), 1), (1, 0, at(1), 1), (2, 0, at(2), 2)])
    assert take(spark, folder, once).count() == 2
    deliver(spark, folder, [(1, 0, at(1), 1), (2, 0, at(2), 2), (3, 0, at(9), 3)])
    assert take(spark, folder, once).count() == 3
    # Keys 1 and 2 are forgotten by now; their repetitions are behind the watermark.
    deliver(spark, folder, [(1, 0, at(1), 1), (4, 0, at(9.5), 3)])
    found = take(spark, folder, once)
    assert sorted(r.event_id for r in found.collect()) == [1, 2, 3, 4]
    assert take(spark, folder, once).count() == 4


# Archives as they arrive


def archive(folder, name, docs, damaged=False):
    import io
    import tarfile

    with tarfile.open(folder / name, "w") as tar:
        for doc, content in docs:
            member = tarfile.TarInfo(f"f/{doc}.xml")
            member.size = len(content)
            tar.addfile(member, io.BytesIO(content))
    if damaged:
        content = (folder / name).read_bytes()
        (folder / name).write_bytes(content[:700])


def patent(title):
    return (
        f'<document-id><date>20190321</date></document-id><invention-title id="title_en">{title}</invention-title>'
        "<abstract><p>Some words</p></abstract>"
    ).encode()


def test_new_archives_are_read_once(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    archive(source, "a.tar", [("1", patent("One")), ("2", patent("Two"))])
    arriving.ingest_archives(spark, str(source), out, "*.tar")
    archive(source, "b.tar", [("3", patent("Three"))])
    archive(source, "c.tar", [("4", patent("Four") * 9)], damaged=True)
    (source / "d.txt").write_text("another file")
    arriving.ingest_archives(spark, str(source), out, "*.tar")
    arriving.ingest_archives(spark, str(source), out, "*.tar")
    found = arriving.read_ingested(spark, out, "patents")
    assert rows(found.select("title", "batch")) == [("One", 0), ("Three", 1), ("Two", 0)]
    errors = arriving.read_ingested(spark, out, "archive_errors").collect()
    assert [(r.archive.rpartition("/")[2], r.batch) for r in errors] == [("c.tar", 1)]
    counts = {r.word: r.n for r in arriving.merged_counts(spark, out).collect()}
    # The abstract is joined to itself, so its last word and its first one fuse.
    assert counts == {"SOME": 3, "WORDSSOME": 3, "WORDS": 3}


def test_a_batch_run_again_leaves_its_rows_once(spark, tmp_path, monkeypatch):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    archive(source, "a.tar", [("1", patent("One"))])
    arriving.ingest_archives(spark, str(source), out)
    archive(source, "b.tar", [("2", patent("Two"))])
    whole = arriving.archives.failures

    def fails(found):
        raise OSError("no space")

    # The patents are written before the table of errors fails, so a second attempt meets them.
    monkeypatch.setattr(arriving.archives, "failures", fails)
    with pytest.raises(Exception, match="no space"):
        arriving.ingest_archives(spark, str(source), out)
    assert rows(arriving.read_ingested(spark, out, "patents").select("title")) == [("One",)]
    monkeypatch.setattr(arriving.archives, "failures", whole)
    arriving.ingest_archives(spark, str(source), out)
    assert rows(arriving.read_ingested(spark, out, "patents").select("title", "batch")) == [("One", 0), ("Two", 1)]


def test_times_without_a_zone_are_utc(spark):
    from patentflow.operators.asof import position

    table = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 12:00:00' AS t")
    noon = int(datetime(2024, 1, 1, 12, tzinfo=timezone.utc).timestamp() * 1_000_000)
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert table.select(position("t", table)).first()[0] == noon
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
