"""The registered queries against their SQL, and the pipeline against brute force."""

import hashlib
import itertools
import os
import re

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from patentflow.llm import simhash_dedup
from patentflow.llm.oracles import ORACLES
from patentflow.llm.queries import QUERIES, vocabulary_path


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "conversations"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, tables, sf_dir, name):
    found, expected = QUERIES[name](spark, sf_dir), tables.sql(ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    ours = sorted(map(repr, (tuple(row[c] for c in columns) for row in found.collect())))
    theirs = sorted(map(repr, expected.select(*[f'"{c}"' for c in columns]).fetchall()))
    assert ours and ours == theirs


def test_chat_sql_escapes_what_the_formatter_escapes(spark, tmp_path):
    """All short texts made of what the grammar and its escapes use, as texts and as roles."""
    parts = ["", "x", "\n", "### ", "\n### ", "\n### assistant: ", ": ", ":", "</turn>", "<", "\\", "\\h", "\\b", "b", "#"]
    texts = sorted({a + b + c for a in parts for b in parts for c in ("", "x", ": ")})
    rows = [(i, 0, "user", text) for i, text in enumerate(texts)]
    rows += [(i, 1, text if i % 2 else "assistant", texts[-1 - i]) for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    table.coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found, expected = QUERIES["op6_chat_format"](spark, str(tmp_path)), connection.sql(ORACLES["op6_chat_format"])
    assert sorted(map(tuple, found.collect())) == sorted(expected.select(*[f'"{c}"' for c in found.columns]).fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_a_row_per_document(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_token_digests(spark, sf_dir):
    """Ids, their number and the decoded text of the whole query are those of the tokenizers library."""
    library = Tokenizer.from_file(vocabulary_path())
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in QUERIES["op8_bpe"](spark, sf_dir).collect():
        ids = library.encode(docs[row.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(text.encode()).hexdigest() for text in (",".join(map(str, ids)), decoded)]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), *digests)


def test_pipeline_stages(spark, sf_dir):
    """Each stage judged on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, names = docs.columns, [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mixing", "bpe"]
    kept = {None: docs}
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = docs
        assert name == "bpe" or docs.columns == columns
    of = {name: {r.doc_id: r.text for r in rows.collect()} for name, rows in kept.items() if name != "bpe"}
    assert len(of["toxicity"]) >= 0.7 * len(of[None])

    best = {}
    for doc, text in of["toxicity"].items():
        norm = re.sub(r"[\x20\x09-\x0D]", "", text)
        best[norm] = min(best.get(norm, (0, doc)), (-len(text), doc))
    assert set(of["exact_dedup"]) == {doc for _, doc in best.values()}

    prints = {d: simhash_dedup.fingerprint_of(t) & (1 << 64) - 1 for d, t in of["exact_dedup"].items()}
    group = {d: {d} for d in prints}
    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] is not group[b]:
            group[a] |= group[b]
            for d in group[b]:
                group[d] = group[a]
    assert set(of["near_dedup"]) == {min(g) for g in group.values()}
    assert set(of["mixing"]) <= set(of["near_dedup"])
    tokens = kept["bpe"].collect()
    assert len(tokens) == kept["mixing"].count()
    for row in tokens:
        assert row.decoded_sha256 == hashlib.sha256(of["mixing"][row.doc_id].encode()).hexdigest()
    run = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, tokens))


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, print bigint, score double"


@pytest.fixture
def odd_documents(spark):
    """NULL in every column, empty and very long texts, copies, repeated rows and ids; columns with names that
    operators use."""
    long = " ".join(f"word{i}" for i in range(40_000))
    rows = [(1, "one two three four five", "en", "a", 23), (2, "one  two three four five", "en", "a", 24)]
    rows += [(3, "one two three four five", None, None, None), (None, "text without an id", "en", "b", 18), (5, None, "en", "b", None)]
    rows += [(6, "", "en", "b", 0), (7, long, "en", "c", len(long)), (8, long + " end", "en", "c", None), (9, "x", None, None, 1)]
    rows += [(9, "x", None, None, 1), (10, "y", "en", "a", 1), (10, "y z", "en", "a", 3)]
    return spark.createDataFrame([(*row, "r", 7, 0.5) for row in rows], DOCUMENTS)


def test_stages_with_odd_rows(spark, tmp_path, odd_documents):
    labels = spark.createDataFrame([(3, 1, None), (None, 0, 1), (4, None, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stages, folder = dict(corpus_pipeline.STAGES), str(tmp_path)
    given = [tuple(r) for r in odd_documents.collect()]

    clean = stages["toxicity"](spark, odd_documents, folder)
    assert clean.columns == odd_documents.columns and sorted(map(tuple, clean.collect()), key=repr) == sorted(given, key=repr)

    best = {}
    for row in given:
        norm = re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")
        order = (-len(row[1] or ""), row[0] is None, row[0] or 0)
        best[norm] = min(best.get(norm, (order, row)), (order, row), key=lambda b: b[0])
    unique = stages["exact_dedup"](spark, clean, folder)
    # NULL and empty texts are equal, and of rows that agree in all that counts any one stays.
    assert sorted((r.doc_id, (r.text or "")[:30]) if r.doc_id else () for r in unique.collect()) == sorted(
        (row[0], (row[1] or "")[:30]) if row[0] else () for _, row in best.values()
    )

    docs = [tuple(r) for r in unique.collect()]
    prints = [simhash_dedup.fingerprint_of(row[1]) & (1 << 64) - 1 for row in docs]
    group = list(range(len(docs)))
    for _ in docs:
        for a, b in itertools.combinations(range(len(docs)), 2):
            if None not in (docs[a][0], docs[b][0]) and (prints[a] ^ prints[b]).bit_count() <= 2:
                group[a] = group[b] = min(group[a], group[b])
    expected = {min((docs[i] for i in range(len(docs)) if group[i] == g), key=lambda r: (r[0] is None, r[0] or 0))[0] for g in group}
    near = stages["near_dedup"](spark, unique, folder)
    assert near.columns == odd_documents.columns and {r.doc_id for r in near.collect()} == expected

    mixed = stages["mixing"](spark, near, folder)
    texts = {(r.doc_id, r.text) for r in near.collect()}
    assert mixed.columns == odd_documents.columns and {(r.doc_id, r.text) for r in mixed.collect()} <= texts
    tokens = stages["bpe"](spark, near, folder).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.decoded_sha256) for r in tokens) == sorted(
        (i is None, i or 0, hashlib.sha256((text or "").encode()).hexdigest()) for i, text in texts
    )


def test_stages_of_no_documents(spark, tmp_path, odd_documents):
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd_documents.limit(0)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, str(tmp_path)).collect() == []


def test_bits_beyond_the_keys_are_refused(spark, odd_documents):
    with pytest.raises(ValueError):
        simhash_dedup.one_of_each(odd_documents, max_bits=3)


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for folder, _, files in os.walk(os.path.join(root, "patentflow")):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as file:
                        assert "patentflow.llm" not in file.read()
