"""Counts, labels, dictionaries, sinks and plans on small hand-made and derived tables."""

from collections import Counter

import pytest
from helpers import plan, rows, values
from pyspark.sql import functions as F

from patentflow import sinks, storage
from patentflow.functions import text
from patentflow.operators import labeling, patents, wordcount
from patentflow.operators.model import accuracy, fit_forest
from patentflow.operators.dictionary import (
    dictionary_of,
    encode_columns,
    encode_features,
    fit_dictionaries,
)
from patentflow.plans import corpus
from patentflow.plans.queries import QUERIES
from patentflow.schemas import CODE_LISTS, DICTIONARIES, DOCUMENTS, TRAIN_COLS
from patentflow.sources import tables
from patentflow.storage import remove_scratch, scratch_dir, stage, swap_in


def counts_of(df):
    return {row.word: row.n for row in df.collect()}


def abstracts(spark, *found):
    return spark.createDataFrame([(a,) for a in found], "abstract string")


def test_abstract_counts_twice_and_its_ends_fuse(spark):
    found = counts_of(wordcount.count_words(abstracts(spark, "wind blows", "Wind.")))
    assert found == {"WIND": 3, "BLOWSWIND": 1, "BLOWS": 1}


def test_quotes_leave_words_after_stop_words_do(spark):
    found = counts_of(wordcount.count_words(abstracts(spark, 'the "the" "mill" .')))
    assert found == {"THE": 2, "MILL": 2, "": found[""]}


def test_other_text_and_stop_words(spark):
    one = abstracts(spark, "the wind")
    source = text.word_text(F.col("abstract"))
    assert counts_of(wordcount.count_words(one, source=source, stop_words=["WIND"])) == {"THE": 1}


def test_counts_match_brute_force(spark, sf_dir):
    rows_ = patents.extract_patents(corpus.patents(spark, sf_dir)).cache()
    expected = Counter()
    for row in rows_.select("abstract").collect():
        joined = row.abstract * 2
        for mark in ".,[]()":
            joined = joined.replace(mark, " ")
        words = joined.upper().strip(" ").split(" ")
        expected.update(w.replace('"', "") for w in words if w not in text.STOP_WORDS)
    assert counts_of(wordcount.count_words(rows_)) == expected


def test_merged_partial_counts_are_the_direct_count(spark, sf_dir):
    rows_ = patents.extract_patents(corpus.patents(spark, sf_dir)).withColumn(
        "slice", F.pmod(F.hash("file_name"), F.lit(5))
    )
    parts = [wordcount.count_words(rows_.where(F.col("slice") == i)) for i in range(5)]
    merged = wordcount.merge_counts(*parts)
    assert counts_of(merged) == counts_of(wordcount.count_words(rows_))


def test_top_words_drop_the_empty_word_and_break_ties(spark):
    counts = spark.createDataFrame([("", 9), ("B", 2), ("A", 2), ("C", 3)], "word string, n long")
    assert [tuple(r) for r in wordcount.top_words(counts, 2).collect()] == [("C", 3), ("A", 2)]
    assert values(wordcount.rarest_first(counts).select("word")) == ["A", "B", "C", ""]


def docs_and_known(spark):
    names = ["f/a.xml", "f/b.xml", "g/a.xml", "g/c.xml", "no-folder", "h/d.xml"]
    docs = spark.createDataFrame([(n, n.upper()) for n in names], DOCUMENTS)
    known = spark.createDataFrame([("a.xml",), ("a.xml",), ("zzz.xml",)], "base_name string")
    return docs, known


def test_positives_and_others(spark):
    docs, known = docs_and_known(spark)
    assert values(labeling.positives(docs, known).select("file_name").sort("file_name")) == [
        "f/a.xml",
        "g/a.xml",
    ]
    assert values(labeling.others(docs, known).select("file_name").sort("file_name")) == [
        "f/b.xml",
        "g/c.xml",
        "h/d.xml",
    ]
    assert values(labeling.first_others(docs, known, 2).select("file_name")) == ["f/b.xml", "g/c.xml"]


def test_shuffled_joins_agree_with_broadcast_joins(spark, sf_dir):
    docs = corpus.patents(spark, sf_dir).select("file_name")
    known = corpus.known(spark, sf_dir)
    broadcast = rows(labeling.label(docs, known))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        labelled = labeling.label(docs, known)
        assert "SortMergeJoin" in plan(labelled)
        assert rows(labelled) == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_negatives_with_one_hot_name(spark):
    """A third of all rows share a name; the bound still holds exactly."""
    names = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "f/hot.xml").otherwise(F.concat(F.lit("f/"), F.col("id"))).alias("file_name")
    )
    known = spark.createDataFrame([], "base_name string")
    found = values(labeling.first_others(names, known, 2500))
    assert found == sorted(values(names))[:2500]


def test_split_is_a_partition_and_depends_on_the_name_only(spark, sf_dir):
    docs = corpus.patents(spark, sf_dir).select("file_name")
    split = labeling.with_split(docs)
    assert rows(split) == rows(labeling.with_split(docs.repartition(7)))
    assert 0.15 < split.where("is_test").count() / docs.count() < 0.35


def test_shuffle_keeps_rows_and_changes_order(spark):
    staged = stage(spark.range(1000))
    found = values(labeling.shuffle_rows(staged, 3))
    assert sorted(found) == list(range(1000)) and found != sorted(found)
    assert found == values(labeling.shuffle_rows(staged, 3))


def test_shuffle_query_moves_whole_texts(spark, sf_dir, monkeypatch):
    moved = []
    shuffle = labeling.shuffle_rows
    monkeypatch.setattr(labeling, "shuffle_rows", lambda df, *a: moved.append(df.columns) or shuffle(df, *a))
    found = QUERIES["sample_shuffle"](spark, sf_dir)
    assert found.columns == ["doc_id", "is_shuffled"] and moved == [["doc_id", "text"]]


def test_dictionaries_number_sorted_values(spark):
    """Levels, sections and subclasses share one dictionary; classes, groups and subgroups another."""
    lists = [
        (["A"], ["H", "0A"], ["10", "1", "-1"], ["J"], ["é", "100"], []),
        (["A", "C"], ["AB"], ["1", "2", ""], [], ["11", "a"], None),
        ([], [], [], [], ["3"], ["1", "40"]),
    ]
    columns = ", ".join(f"{name} array<string>" for name in CODE_LISTS)
    fitted = fit_dictionaries(spark.createDataFrame(lists, columns))

    def expected(*values_):
        return {value: i for i, value in enumerate(sorted(values_, key=str.encode))}

    found = {n: {r.value: r.id for r in dictionary_of(fitted, n).collect()} for n in DICTIONARIES}
    assert found["categorical"] == expected("A", "H", "0A", "J", "C", "AB")
    # a row with a NULL list adds none of its numeric values
    assert found["numeric"] == expected("10", "1", "-1", "é", "100", "3", "40")


def test_dictionaries_read_their_table_once(spark, sf_dir):
    fitted = fit_dictionaries(stage(patents.extract_codes(corpus.patents(spark, sf_dir))))
    fitted.collect()
    final = plan(fitted).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 1 and final.count("FileScan") == 1


def test_unseen_codes_become_minus_one(spark):
    dictionary = spark.createDataFrame([("A", 0), ("B", 1)], "value string, id int")
    df = spark.createDataFrame([("k", "B", "Z")], "key string, s_0 string, s_1 string")
    assert encode_columns(df, dictionary, ["s_0", "s_1"]).select("key", "s_0", "s_1").first() == ("k", 1, -1)


def encoded(spark, sf_dir):
    codes = stage(patents.extract_codes(corpus.patents(spark, sf_dir)))
    seen = codes.where(F.get("sections", F.lit(0)).isin("A", "B", "C"))
    dictionaries = stage(fit_dictionaries(seen))
    return encode_features(patents.feature_table(codes, "file_name"), dictionaries), dictionaries


def test_encoding_yields_known_ids_or_minus_one(spark, sf_dir):
    found, dictionaries = encoded(spark, sf_dir)
    size = dictionaries.agg(F.max("id") + 1).first()[0]
    for row in found.select(*TRAIN_COLS).collect():
        assert all(-1 <= v < size for v in row)
    assert found.where("s_0 = -1").count() > 0


def test_encoding_beyond_the_broadcast_threshold(spark, sf_dir):
    found, _ = encoded(spark, sf_dir)
    assert plan(found).count("BroadcastHashJoin") == 18 and "SortMergeJoin" not in plan(found)
    broadcast = rows(found)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled, _ = encoded(spark, sf_dir)
        assert "BroadcastHashJoin" not in plan(shuffled)
        assert rows(shuffled) == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_padded_rows_are_spread(spark):
    """Nine in ten rows hold the pad; without a broadcast they still meet in no one task."""
    pad_or_code = F.when(F.col("id") % 10 < 9, "0A").otherwise(F.concat(F.lit("c"), F.col("id")))
    df = spark.range(4000).select("id", pad_or_code.alias("s_0"))
    dictionary = spark.createDataFrame([("0A", 0), ("c9", 1)], "value string, id int")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = encode_columns(df, dictionary, ["s_0"])
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert "SortMergeJoin" in plan(found) and max(sizes) < 2 * 4000 / 4
        assert found.where("s_0 = 0").count() == 3600 and found.where("s_0 = 1").count() == 1
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_row_ids_are_unique(spark):
    ids = values(patents.with_row_id(spark.range(100).repartition(5)).select("row_id"))
    assert len(set(ids)) == 100


def test_import_of_older_tables(spark):
    names = ["levels", "sections", "clasess", "subclasess", "groups", "subgroups"]
    old = spark.createDataFrame([("f/a", *["[A, 0A]"] * 6, 0)], ["file_name", *names, "target"])
    new = patents.from_stringified(old)
    assert new.select(*CODE_LISTS).first() == tuple([["A", "0A"]] * 6)
    assert new.columns == ["file_name", *CODE_LISTS, "target"]


def test_file_list(spark, tmp_path):
    (tmp_path / "list.txt").write_bytes(b"f/a.xml\r\nno-slash\nx/y/z.xml\n\ng/b.xml")
    lines = tables.read_file_list(spark, str(tmp_path / "list.txt"))
    assert rows(tables.parse_file_list(lines)) == [("a.xml",), ("b.xml",)]
    assert rows(tables.rejected_lines(lines)) == [("",), ("no-slash",), ("x/y/z.xml",)]


def test_unreadable_parts_are_left_out(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "part-bad.parquet").write_bytes(b"not parquet at all")
    assert tables.read_parts(spark, str(tmp_path / "t")).count() == 10
    assert tables.read_parts(spark, str(tmp_path / "t"), spark.range(1).schema).count() == 10


@pytest.mark.parametrize("compression", ["snappy", "none"])
def test_damage_inside_parts_is_reported(spark, tmp_path, compression):
    """A bit of a page of the last column, a cut, no parquet at all; other columns of the first can be read."""
    path = tmp_path / "t"
    texts = spark.range(0, 4000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    texts.write.option("compression", compression).parquet(str(path))
    page, cut, other, sound = sorted(path.glob("*.parquet"))
    data = bytearray(page.read_bytes())
    data[len(data) * 3 // 4] ^= 1
    page.write_bytes(data)
    cut.write_bytes(cut.read_bytes()[:5000])
    other.write_bytes(b"no parquet")
    for name in path.glob(".*.crc"):
        name.unlink()
    found = tables.unreadable_parts(spark, str(path), texts.schema).collect()
    told = {r.part.rpartition("/")[2]: (r.n_rows, r.n_read) for r in found}
    assert told == {page.name: (1000, 0), cut.name: (None, 0), other.name: (None, 0)}
    read = tables.read_parts(spark, str(path), texts.schema)
    assert read.select(F.count("text")).first()[0] == 1000
    assert rows(read.select("id", "text").exceptAll(texts)) == []


def test_sound_parts_are_not_reported(spark, tmp_path):
    nested = spark.range(0, 50, 1, 3).select("id", F.create_map("id", "id").alias("m"), F.array("id").alias("a.b"), F.lit(None).cast("int").alias("n"))
    nested.write.parquet(str(tmp_path / "t"))
    assert tables.unreadable_parts(spark, str(tmp_path / "t")).collect() == []


def test_a_run_that_fails_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "dated")
    sinks.write_dated(spark.range(100), path, "2024-01-31")
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") > 60, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_dated(broken, path, "2024-01-31")
    with pytest.raises(Exception, match="broken"):
        sinks.write_dated(broken, path, "2024-02-01")
    found = sinks.read_dated(spark, path)
    assert sorted(r.id for r in found.collect()) == list(range(100))
    assert [p.name for p in (tmp_path / "dated").iterdir()] == ["ex_date=20240131"]


def test_a_folder_is_not_lost_if_its_successor_cannot_move(spark, tmp_path):
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "row").write_text("here")
    with pytest.raises(Exception):
        swap_in(spark, str(tmp_path / "missing"), str(tmp_path / "old"))
    assert (tmp_path / "old" / "row").read_text() == "here"


def test_tables_are_read_as_they_are(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "small"))
    assert "Exchange" not in plan(tables.read_table(spark, str(tmp_path / "small")))


def test_forest_has_a_bin_for_every_code(spark):
    """3000 codes with a class each: merged into fewer bins they could not be told apart."""
    ids = spark.range(3000).select(*[F.col("id").cast("int").alias(name) for name in TRAIN_COLS])
    rows_ = stage(ids.withColumn("target", (F.xxhash64(TRAIN_COLS[0]) % 2 == 0).cast("int")))
    right = {}
    for bins in (None, 512):
        fitted = fit_forest(rows_, trees=3, bins=bins)
        right[bins] = accuracy(fitted.transform(rows_)).first().accuracy
    # How well three trees do depends on which rows each draws.
    assert right[None] > 0.75 and right[None] > right[512] + 0.05, right


def test_bounded_files(spark, tmp_path):
    sinks.write_table(spark.range(1000).coalesce(1), str(tmp_path / "t"), 300)
    per_file = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count()
    assert sorted(row[1] for row in per_file.collect()) == [100, 300, 300, 300]


def test_bounded_files_without_checksum_files(spark, tmp_path):
    """Neither an earlier table's files of checksums stay, nor does the next table lack its own."""
    path = tmp_path / "t"
    sums_beside, found = [], []
    for with_sums, n in ((True, 1000), (False, 900), (True, 800)):
        sinks.write_table(spark.range(n).coalesce(1), str(path), 300, checksum_files=with_sums)
        names = [file.name for file in path.iterdir()]
        sums_beside.append(sum(name.endswith(".crc") for name in names))
        found.append((sum(name.endswith(".parquet") for name in names), rows(spark.read.parquet(str(path)))))
    assert sums_beside == [5, 0, 4]
    assert found == [(n_files, rows(spark.range(n))) for n_files, n in ((4, 1000), (3, 900), (3, 800))]


def test_pages_without_checksum_files_still_tell_damage(spark, tmp_path):
    path = tmp_path / "t"
    texts = spark.range(14).select(F.sha2(F.col("id").cast("string"), 512).alias("word")).coalesce(1)
    sinks.write_table(texts, str(path), 7, checksum_files=False)
    spoilt, _ = sorted(path.glob("*.parquet"))
    data = bytearray(spoilt.read_bytes())
    data[data.index(texts.first().word[:40].encode()) + 20] ^= 1
    spoilt.write_bytes(data)
    told = [row.part for row in tables.unreadable_parts(spark, str(path), texts.schema).collect()]
    assert [part.rsplit("/", 1)[1] for part in told] == [spoilt.name]


def test_other_storages_keep_their_writer(spark, tmp_path):
    """Neither a path that is not on a local disk nor a session's own class for local files is touched."""
    conf, path = spark._jsc.hadoopConfiguration(), str(tmp_path / "t")
    assert storage.without_checksum_files(spark, path)
    link = "fs.viewfs.mounttable.sums.link./in"
    conf.set(link, f"file://{tmp_path}")
    try:
        assert storage.without_checksum_files(spark, "viewfs://sums/in/t") == {}
        sinks.write_table(spark.range(3), "viewfs://sums/in/t", 2, checksum_files=False)
        assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]
    finally:
        conf.unset(link)
    conf.set("fs.file.impl", "org.apache.hadoop.fs.LocalFileSystem")
    try:
        assert storage.without_checksum_files(spark, path) == {}
    finally:
        conf.unset("fs.file.impl")


def test_dated_rerun_replaces_its_own_date_only(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_dated(spark.range(5), path, "2024-01-30")
    sinks.write_dated(spark.range(7), path, "2024-01-31")
    sinks.write_dated(spark.range(3), path, "2024-01-31")
    counted = sinks.read_dated(spark, path).groupBy("ex_date").count()
    assert rows(counted) == [("20240130", 5), ("20240131", 3)]
    sinks.write_dated(spark.range(0), path, "2024-02-01")
    assert sinks.read_dated(spark, path).count() == 8
    sinks.write_dated(spark.range(0), path, "2024-01-31")
    assert sinks.read_dated(spark, path).count() == 5


def test_write_if_any(spark, tmp_path):
    assert not sinks.write_if_any(spark.range(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert sinks.write_if_any(spark.range(2), str(tmp_path / "some"))
    assert spark.read.parquet(str(tmp_path / "some")).count() == 2


def test_counts_as_json_lines(spark, tmp_path):
    counts = spark.createDataFrame([('A"', 2), ("é", 1)], "word string, n long")
    sinks.write_counts_json(counts, str(tmp_path / "j"))
    assert rows(spark.read.schema(counts.schema).json(str(tmp_path / "j"))) == rows(counts)


def test_scratch_lies_below_the_folder_of_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark), scratch_dir(spark)
    assert first.startswith(f"{root}/patentflow/") and first != second


def test_scratch_of_an_application_is_removed_as_a_whole(spark, tmp_path, monkeypatch):
    own = tmp_path / "patentflow" / spark.sparkContext.applicationId
    assert f"/patentflow/{own.name}/" in scratch_dir(spark)
    monkeypatch.setattr(storage, "scratch_root", lambda session: str(own))
    (tmp_path / "patentflow" / "other").mkdir(parents=True)
    stage(spark.range(3))
    assert own.exists()
    remove_scratch(spark)
    assert [p.name for p in (tmp_path / "patentflow").iterdir()] == ["other"]


NATIVE = [
    "extract_patent",
    "ipc_feature_columns",
    "tokens_list",
    "agg_word_topk",
    "join_semi_positive",
    "join_anti_negative",
    "label_union",
    "dict_numeric",
    "encode_codes",
]


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_the_plan(spark, sf_dir, name):
    text_ = plan(QUERIES[name](spark, sf_dir))
    for node in ("EvalPython", "MapInArrow", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert node not in text_


def test_plan_shapes(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["agg_word_topk"](spark, sf_dir))
    assert "partial_count" in plan(QUERIES["agg_word_count"](spark, sf_dir))
    assert "BroadcastHashJoin" in plan(QUERIES["join_semi_positive"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan(QUERIES["first_negatives"](spark, sf_dir))


def test_extraction_searches_each_document_once(spark, sf_dir):
    """The filters on extracted fields stay above the generator."""
    text_ = plan(patents.extract_patents(corpus.patents(spark, sf_dir)))
    assert text_.index("Filter") < text_.index("Generate") < text_.index("regexp_extract")


def test_codes_scan_reads_needed_columns_only(spark, sf_dir):
    scan = plan(wordcount.count_words(stage(patents.extract_patents(corpus.patents(spark, sf_dir)))))
    assert "ReadSchema: struct<abstract:string>" in scan


def test_registered_names_have_lists(spark):
    assert set(DICTIONARIES) == {"categorical", "numeric"} and len(TRAIN_COLS) == 18
