"""The jobs from tar files on disk to dated results."""

import os
import subprocess
import sys

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_archives import write_tar

from patentflow import sinks
from patentflow.functions import text
from patentflow.operators.model import Classifier
from patentflow.operators.patents import OLDER_NAMES, extract_codes, extract_patents
from patentflow.operators.wordcount import count_words, top_words
from patentflow.plans import corpus, jobs
from patentflow.schemas import CODE_LISTS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def place(spark, sf_dir, tmp_path_factory):
    """Archives per source and a list of the documents whose first class is below 30."""
    root = tmp_path_factory.mktemp("jobs")
    (root / "archives").mkdir()
    docs = corpus.patents(spark, sf_dir).select("file_name", "raw_txt").cache()
    by_source = {}
    for name, raw in rows(docs):
        by_source.setdefault(name.split("/")[0], []).append((name, raw))
    for i, (source, files) in enumerate(by_source.items()):
        write_tar(root / "archives" / f"{source}.tar", files, "w:gz" if i % 2 else "w")
    first = F.get("classes", F.lit(0))
    energy = extract_codes(docs).where((first >= "01") & (first < "30"))
    names = [row.file_name for row in energy.collect()]
    (root / "list.txt").write_text("\n".join([*names, "not a path"]))
    return root, docs, names


def test_extract(spark, place):
    root, docs, _ = place
    assert jobs.extract_job(spark, f"{root}/archives", f"{root}/out", max_rows=50) == 0
    expected = extract_patents(docs)
    assert rows(spark.read.parquet(f"{root}/out/patents")) == rows(expected)
    assert rows(spark.read.parquet(f"{root}/out/word_counts")) == rows(count_words(expected))
    best = rows(top_words(count_words(expected)))
    assert rows(spark.read.parquet(f"{root}/out/top_words")) == best
    assert rows(spark.read.json(f"{root}/out/top_words_json").select("word", "n")) == best
    assert spark.read.parquet(f"{root}/out/archive_errors").count() == 0
    assert not os.path.exists(f"{root}/out/staged")


def test_extract_names_damaged_archives(spark, tmp_path):
    write_tar(tmp_path / "good.tar", [("EP/a.xml", "<doc/>")])
    (tmp_path / "bad.tar").write_bytes(b"junk")
    for _ in range(2):
        assert jobs.extract_job(spark, str(tmp_path), f"{tmp_path}/out", "*.tar") == 1
    errors = spark.read.parquet(f"{tmp_path}/out/archive_errors").collect()
    assert [row.archive.rsplit("/")[-1] for row in errors] == ["bad.tar"]


def test_counts_of_two_runs_merge(spark, tmp_path):
    for i, words in enumerate([[("A", 2), ("B", 1)], [("A", 3), ("", 9)]]):
        sinks.write_counts(spark.createDataFrame(words, "word string, n long"), f"{tmp_path}/{i}")
    jobs.write_top_words(spark, f"{tmp_path}/out", f"{tmp_path}/0", f"{tmp_path}/1")
    assert rows(spark.read.parquet(f"{tmp_path}/out/top_words")) == [("A", 5), ("B", 1)]


def test_train_and_score(spark, place):
    root, docs, names = place
    places = f"{root}/archives", f"{root}/list.txt", f"{root}/training"
    jobs.training_job(spark, *places, documents_out=f"{root}/raw")
    training = spark.read.parquet(f"{root}/training")
    assert training.count() == docs.count()
    assert sorted(r.file_name for r in training.where("target = 0").collect()) == sorted(names)
    raw = spark.read.parquet(f"{root}/raw")
    assert rows(raw.select("file_name", "raw_txt")) == rows(docs)
    assert sorted(r.file_name for r in raw.where("target = 0").collect()) == sorted(names)

    assert jobs.fit_job(spark, f"{root}/training", f"{root}/model") >= 0.9

    patents = extract_patents(docs)
    classifier = Classifier.load(spark, f"{root}/model")
    predicted = classifier.predict(patents, "file_name")
    found = {row.file_name: row.prediction for row in predicted.collect()}
    right = sum((name in names) == (p == 0) for name, p in found.items())
    assert len(found) == patents.count() and right / len(found) >= 0.95

    patents.write.parquet(f"{root}/patents")
    for _ in range(2):
        jobs.score_job(spark, f"{root}/patents", f"{root}/model", f"{root}/energy", "2024-01-31")
    scored = sinks.read_dated(spark, f"{root}/energy")
    assert rows(scored.select("ex_date").distinct()) == [("20240131",)]
    with open(f"{root}/patents/part-bad.parquet", "wb") as part:
        part.write(b"junk")
    with pytest.raises(Exception):
        jobs.score_job(spark, f"{root}/patents", f"{root}/model", f"{root}/energy", "2024-02-01")
    jobs.score_job(spark, f"{root}/patents", f"{root}/model", f"{root}/energy", "2024-02-02", True)
    assert [r.part.rsplit("/")[-1] for r in spark.read.parquet(f"{root}/energy_unreadable").collect()] == ["part-bad.parquet"]
    tolerant = sinks.read_dated(spark, f"{root}/energy").where("ex_date = '20240202'")
    scored = sinks.read_dated(spark, f"{root}/energy").where("ex_date = '20240131'")
    assert rows(tolerant.drop("ex_date")) == rows(scored.drop("ex_date"))
    wanted = patents.where(F.col("file_name").isin([n for n, p in found.items() if p == 0]))
    columns = ["title", "abstract", "year"]
    assert rows(scored.select(columns)) == rows(wanted.select(columns))


def test_labels_report_damage_and_older_tables_are_scored(spark, place, tmp_path):
    root, docs, _ = place
    (tmp_path / "in").mkdir()
    write_tar(tmp_path / "in" / "good.tar", rows(docs)[:120])
    (tmp_path / "in" / "bad.tar").write_bytes(b"junk")
    places = f"{tmp_path}/in", f"{root}/list.txt", f"{tmp_path}/training"
    assert jobs.training_job(spark, *places, max_negatives=None) == 1
    assert spark.read.parquet(f"{tmp_path}/training_errors/archive_errors").count() == 1
    training = spark.read.parquet(f"{tmp_path}/training")
    assert training.count() == 120

    def older(rows):
        text_of = {c: F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]")) for c in CODE_LISTS}
        return rows.withColumns(text_of).withColumnsRenamed({new: old for old, new in OLDER_NAMES.items()})

    older(training).write.parquet(f"{tmp_path}/older_training")
    jobs.fit_job(spark, f"{tmp_path}/older_training", f"{tmp_path}/model", trees=5)
    patents = extract_patents(docs)
    for name, table in (("new", patents), ("old", older(patents))):
        table.write.parquet(f"{tmp_path}/{name}")
        jobs.score_job(spark, f"{tmp_path}/{name}", f"{tmp_path}/model", f"{tmp_path}/{name}_out", "2024-01-31")
    assert rows(sinks.read_dated(spark, f"{tmp_path}/old_out")) == rows(sinks.read_dated(spark, f"{tmp_path}/new_out"))


def test_saved_model_predicts_the_same(spark, place, tmp_path):
    _, docs, names = place
    codes = extract_codes(docs).withColumn("target", (~F.col("file_name").isin(names)).cast("int"))
    classifier, score = jobs.fit_classifier(codes, trees=5, depth=5)
    assert score.first().n_rows > 0
    classifier.save(str(tmp_path / "m"))
    loaded = Classifier.load(spark, str(tmp_path / "m"))
    assert rows(loaded.predict(codes, "file_name")) == rows(classifier.predict(codes, "file_name"))


def test_command_line(tmp_path):
    """The jobs in a process of its own, away from the repository folder."""
    (tmp_path / "in").mkdir()
    raw = '<invention-title id="title_en">T</invention-title><abstract><p>Wind</p></abstract>'
    write_tar(tmp_path / "in" / "a.tar", [("EP/a.xml", raw)])
    command = [sys.executable, "-m", "patentflow", "extract", f"{tmp_path}/in", f"{tmp_path}/out"]
    environment = {**os.environ, "PYTHONPATH": ROOT}
    done = subprocess.run(command, cwd=tmp_path, env=environment, capture_output=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert b"{'damaged': 0}" in done.stdout
    assert os.path.exists(tmp_path / "out" / "top_words_json" / "_SUCCESS")
