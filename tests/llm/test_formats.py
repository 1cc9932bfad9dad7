"""Token files, Merkle manifests and fill-in-the-middle against brute force."""

import hashlib
import io
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import plan
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patentflow.llm import bpe, fill_in_middle, merkle, token_files
from patentflow.llm.queries import QUERIES, vocabulary_path
from patentflow.storage import scratch_dir

DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def tokenizer_json():
    with open(vocabulary_path(), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(tokenizer_json):
    return Tokenizer.from_str(tokenizer_json)


# Token files


@pytest.mark.parametrize("top", [1, 2, 300, 50_257, 1 << 32])
@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1023, 1024, 1025, 70_000])
def test_blocks_round_trip(n, top):
    draws = np.random.default_rng(n + top)
    ids = draws.integers(0, top, n, dtype=np.uint64).astype("<u4")
    if top == 300 and n:
        ids[draws.integers(0, n, n // 30)] = (1 << 32) - 1
    blocks = token_files.encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1].astype("<u8")
    assert np.array_equal(token_files.decode_blocks(b"".join(blocks), starts), ids)


def test_outliers_do_not_widen_a_block():
    ids = np.full(1024, 7, dtype="<u4")
    ids[::50] = 7 + (1 << 31)
    (block,) = token_files.encode_blocks(ids)
    n_odd = len(ids[::50])
    assert len(block) == token_files.BLOCK_BYTES + 6 * n_odd
    (wide,) = token_files.encode_blocks(ids, 100)
    assert len(wide) == token_files.BLOCK_BYTES + 1024 * 32 // 8


def written(docs):
    sink = io.BytesIO()
    sink.close = lambda: None
    writer = token_files.FileWriter(sink)
    for doc, ids in docs:
        writer.add(doc, [np.array(ids[i : i + 700], dtype="<u4") for i in range(0, len(ids), 700)])
    writer.close()
    return sink.getvalue()


def test_file_gives_documents_and_ranges():
    draws = random.Random(1)
    docs = [(i if i else None, [draws.randrange(50_257) for _ in range(draws.choice([0, 1, 900, 3000]))]) for i in range(90)]
    docs[40] = (40, [5] * 200_000)
    reader = token_files.FileReader(pa.BufferReader(written(docs)))
    flat = [number for _, ids in docs for number in ids]
    at = 0
    for (doc, ids), (found_doc, first, found) in zip(docs, reader.documents(), strict=True):
        assert (doc, at, ids) == (found_doc, first, found.tolist())
        at += len(ids)
    for _ in range(50):
        start = draws.randrange(len(flat))
        stop = min(len(flat), start + draws.choice([0, 1, 1024, 5000]))
        assert reader.ids(start, stop).tolist() == flat[start:stop]


def test_damaged_files_are_refused():
    data = written([(1, [1, 2, 3])])
    broken = bytearray(data)
    broken[-token_files.TRAILER_BYTES - 1] ^= 1
    for content in (b"", data[:20], data[:-1], b"x" + data[1:], bytes(broken)):
        with pytest.raises(ValueError):
            token_files.FileReader(pa.BufferReader(content))


PIECES = ["a", "é", "Ж", "中", "1", "٣", " ", "  ", "\n", "\t", "\xa0", "　", "\x0b", "\x85", "\x1c", "'s", "'", "!", "."]
PIECES += ["$", "×", "<|endoftext|>", "<|", "ª", "ƻ", "́", "​", " ", "😀", "_", "İ", "don't", "I'LL", "word"]


@pytest.mark.parametrize("stretch", [3, 1 << 16])
def test_chunks_change_no_id(tokenizer_json, library, monkeypatch, stretch):
    monkeypatch.setattr(bpe, "STRETCH_CHARS", stretch)
    encoder, draws = token_files.ChunkEncoder(tokenizer_json), random.Random(stretch)
    assert encoder.cuts
    for _ in range(3000):
        text = "".join(draws.choices(PIECES, k=draws.randrange(15)))
        ids = [number for part in encoder.parts(text) for number in part.tolist()]
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_forgotten_chunks_are_encoded_again(tokenizer_json, library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_CHUNKS", 3)
    encoder = token_files.ChunkEncoder(tokenizer_json)
    text = "one two three four five six one two one seven six five four"
    assert np.concatenate([*encoder.parts(text)]).tolist() == library.encode(text).ids
    assert len(encoder.cache) <= 3 and len(encoder.cache.older) <= 3


def test_other_tokenizers_get_whole_texts():
    other = Tokenizer.from_file(os.path.join(os.path.dirname(vocabulary_path()), "word_bpe_49k.json"))
    encoder = token_files.ChunkEncoder(other.to_str())
    assert not encoder.cuts
    text = "Two  words, and don't <|endoftext|> é"
    assert np.concatenate([*encoder.parts(text)]).tolist() == other.encode(text, add_special_tokens=False).ids


def brute_files(library, docs, end):
    found, start = [], 0
    for doc, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end]
        found.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return found


def test_token_query_matches_brute_force(spark, sf_dir, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    rows = QUERIES["op11_token_files"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == brute_files(library, docs, 2)


def test_token_files_of_odd_rows(spark, tokenizer_json, library):
    long = "many words " * 40_000
    rows = [(3, "three"), (1, None), (None, "no id"), (2, ""), (5, long), (4, "same"), (4, "same"), (-7, "first")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    docs = docs.withColumn("file", F.lit(1)).withColumn("ids", F.lit(2)).withColumn("doc", F.lit(3)).withColumn("place", F.lit(4))
    folder = scratch_dir(spark)
    index = token_files.write_token_files(docs, folder, tokenizer_json, 2, file_ids=2).collect()
    assert len(index) > 3 and sum(r.n_docs for r in index) == len(rows)
    found = token_files.read_token_files(spark, folder, tasks=3).withColumn("ids", F.crc32("ids")).collect()
    expected = brute_files(library, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), 2)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    for row in index:
        with open(row.file.removeprefix("file:"), "rb") as file:
            reader = token_files.FileReader(pa.BufferReader(file.read()))
        assert (len(reader.docs), reader.n_ids) == (row.n_docs, row.n_ids)


def test_no_documents_give_no_files(spark, tokenizer_json):
    folder = scratch_dir(spark)
    assert token_files.write_token_files(spark.createDataFrame([], DOCS), folder, tokenizer_json).collect() == []
    assert token_files.read_token_files(spark, folder).collect() == []


def test_files_of_lost_attempts_do_not_count(spark, tokenizer_json):
    """A file that another attempt left beside those of the index is not read."""
    folder = scratch_dir(spark)
    docs = spark.createDataFrame([(i, "text") for i in range(5)], DOCS)
    index = token_files.write_token_files(docs, folder, tokenizer_json).collect()
    name = index[0].file.removeprefix("file:")
    with open(name, "rb") as file, open(name + ".lost.ids", "wb") as other:
        other.write(file.read()[:50])
    assert token_files.read_token_files(spark, folder).count() == 5


# Merkle manifests


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(nodes):
    """The root, and the siblings of each leaf by level as (left, right)."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, merged = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for k in range(len(run)):
                for leaf in groups[at + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h(*run))
            merged.append([leaf for group in groups[at : at + 16] for leaf in group])
        nodes, groups = above, merged
    return nodes[0], paths


def brute_manifest(leaves):
    """(source, doc_id, leaf) -> (doc_id, leaf, subroot, root, siblings)."""
    sources = sorted({s for s, _, _ in leaves}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = [(d, leaf) for s, d, leaf in leaves if s == source]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[source] = (own, *brute_tree([leaf for _, leaf in own]))
    root, tops = brute_tree([trees[source][1] for source in sources])
    found = []
    for source, top in zip(sources, tops):
        own, subroot, paths = trees[source]
        found += [(d, leaf, subroot, root, [*path, *top]) for (d, leaf), path in zip(own, paths)]
    return found


def leaves_of(sizes, seed=0):
    draws = random.Random(seed)
    rows = [(source, draws.randrange(-5, 10**6), h(f"{source}{i}")) for source, n in sizes.items() for i in range(n)]
    draws.shuffle(rows)
    return rows


CASES = {
    "one": {"a": 1},
    "sixteen": {"a": 16},
    "seventeen": {"a": 17},
    "levels": {"a": 257, None: 1, "": 16, "b": 18, "é": 2},
    "sources": {f"s{i:03d}": 1 + i % 3 for i in range(40)},
}


@pytest.mark.parametrize("case", CASES)
def test_proofs_match_brute_force(spark, case):
    rows = leaves_of(CASES[case])
    table = spark.createDataFrame(rows, "source string, doc_id bigint, leaf string").repartition(3)
    proofs = merkle.prove(merkle.build_manifest(table))
    found = proofs.withColumn("folded", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    ours = sorted((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in found)
    assert ours == sorted(brute_manifest(rows))
    assert all(r.folded == r.root for r in found)


def test_some_leaves_are_proven_alone(spark):
    rows = leaves_of(CASES["levels"])
    manifest = merkle.build_manifest(spark.createDataFrame(rows, "source string, doc_id bigint, leaf string"))
    asked = spark.createDataFrame([("=a", 255), ("=a", 256), ("=a", 3), ("", 0), ("=b", 17), ("=b", 17), ("=x", 1)], "tree string, idx bigint")
    found = merkle.prove(manifest, asked).collect()
    everything = {(r.tree, r.idx): r for r in merkle.prove(manifest).collect()}
    assert len(found) == 5 and all(everything[r.tree, r.idx].asDict(True) == r.asDict(True) for r in found)


@pytest.mark.parametrize("case", ["levels", "sources"])
def test_nodes_on_their_way_down_are_not_broadcast(spark, case):
    """Spark takes sixteen children for one row, so below its threshold it would send any number of paths."""
    rows = leaves_of(CASES[case])
    manifest = merkle.build_manifest(spark.createDataFrame(rows, "source string, doc_id bigint, leaf string"))
    found = plan(merkle.prove(manifest))
    assert "SortMergeJoin" in found and "BroadcastHashJoin" not in found


def test_leaves_of_odd_documents(spark):
    docs = [(1, "s", "en", 3, "abc"), (1, "s", "en", 3, "abc"), (None, None, None, None, None), (2, None, "", 0, "É"), (1, "s", "en", 3, "ABC")]
    table = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    table = table.withColumn("leaf", F.lit("x")).withColumn("tree", F.lit("y")).withColumn("other", F.lit("z"))

    def leaf(doc, text):
        values = [doc[0], doc[1], doc[2], doc[3], text]
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    claimed = merkle.document_leaves(table, F.lower("text"))
    found = sorted(map(tuple, claimed.collect()), key=repr)
    expected = [(d[1], d[0], leaf(d, d[4]), None if d[4] is None else leaf(d, d[4].lower())) for d in docs]
    assert found == sorted(expected, key=repr)
    proofs = merkle.prove(merkle.build_manifest(claimed)).collect()
    expected = brute_manifest([row[:3] for row in expected])
    assert sorted((repr(r.doc_id), r.leaf, r.root) for r in proofs) == sorted((repr(e[0]), e[1], e[3]) for e in expected)
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    verified = merkle.prove(merkle.build_manifest(claimed)).select("leaf", "tampered", (folded == F.col("root")).alias("v"))
    assert all(r.v == (r.tampered in (None, r.leaf)) for r in verified.collect())


def test_no_leaves_have_no_root(spark):
    manifest = merkle.build_manifest(spark.createDataFrame([], "source string, doc_id bigint, leaf string"))
    assert manifest.root is None
    proofs = merkle.prove(manifest)
    assert proofs.collect() == [] and {"subroot", "root", "path"} <= set(proofs.columns)


def test_records_are_found_by_their_digest(spark):
    """Runs of equal leaves are one record, and every record gives its digest."""
    rows = [("a", 1, h("x"))] * 64 + [("b", 1, h("x"))] * 32
    manifest = merkle.build_manifest(spark.createDataFrame(rows, "source string, doc_id bigint, leaf string"))
    records = manifest.records("source", 1).collect()
    assert len(records) == 1 and h(*records[0].children) == records[0].digest
    assert merkle.prove(manifest).count() == 96


# Fill in the middle


def brute_cut(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    draws = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    a, b = sorted(draw % (n + 1) for draw in draws[:2])
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= 90:
        return doc_id, n, "plain", text, None, None, None
    if draws[3] % 100 < 20:
        return doc_id, n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", prefix, middle, suffix
    return doc_id, n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", prefix, middle, suffix


def test_cuts_match_brute_force(spark):
    draws = random.Random(3)
    texts = ["".join(draws.choices(["ab", "Z", " ", "é", "\n", "1", "<", "P>", "<M", ">", "😀", "K"], k=draws.randrange(30))) for _ in range(300)]
    texts += ["", None, "<P>", "a<S>b", "x" * 100_000, "a b " * 50_000, "\x00", "same", "same"]
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, "no id, but a text"), (-3, "below zero"), (1, "again"), (1, "again")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit(1)).withColumn("cut", F.lit(2)).withColumn("row", F.lit(3))
    made = fill_in_middle.fill_in_middle(docs, ["doc_id"])
    restored = fill_in_middle.restore(F.col("output"), F.col("form"))
    found = made.withColumn("restored", restored).collect()
    assert sorted((tuple(r)[:-1] for r in found), key=repr) == sorted((brute_cut(*row) for row in rows), key=repr)
    assert sorted((repr(r.doc_id), r.restored) for r in found) == sorted((repr(i), text or "") for i, text in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_no_documents_give_no_cuts(spark):
    assert fill_in_middle.fill_in_middle(spark.createDataFrame([], DOCS), ["doc_id"]).collect() == []


@pytest.mark.parametrize("error", [1, 2, 7, 127, 1000])
def test_rank_index_is_bounded_and_exact(error):
    draws = np.random.default_rng(error)
    for steps in ([], [1], [1] * 5000, draws.integers(1, 9, 3000), draws.choice([1, 1, 1, 4000], 2000)):
        offsets = np.concatenate(([0], np.cumsum(np.array(steps, dtype=np.int64))))
        index, ranks = fill_in_middle.RankIndex.fit(offsets, error), np.arange(len(offsets))
        assert np.array_equal(index.offsets(ranks), offsets)
        assert np.abs(index.predict(ranks) - offsets).max() <= error
    even = fill_in_middle.RankIndex.fit(np.arange(10_000) * 3, error)
    assert len(even.first) == 1 and not even.missed.any()
