"""Exact deduplication, fingerprints, Golay keys, vectors and components against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from patentflow.llm import exact_dedup, simhash_dedup, vector_dedup
from patentflow.llm.buckets import cells
from patentflow.llm.components import connected_components

DOCS = "doc_id bigint, text string"


def brute_components(ids, linked):
    """Smallest reachable id of each id."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in linked:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return {i: find(i) for i in ids}


# Exact deduplication


def brute_exact(rows):
    groups = {}
    for number, (doc, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc is None, doc, number))
    found = []
    for group in groups.values():
        best = min(group, key=lambda g: (g[0], g[1], g[2] if g[2] is not None else 0))
        for i, (_, _, doc, _) in enumerate(sorted(group, key=lambda g: (g[0], g[1], g[2] or 0))):
            found.append((doc, best[2], len(group), i == 0))
    return sorted(found, key=repr)


@pytest.mark.parametrize("copies", [3, 400])
def test_exact_groups(spark, copies):
    rnd = random.Random(copies)
    rows = [(i, "hot text" + " " * rnd.randint(0, 3)) for i in range(copies)]
    rows += [(1000 + i, rnd.choice(["a b", "ab", "a\tb\n", "b a", "", None, " ", "ä", "ä "])) for i in range(60)]
    rows += [(5000, "long " * 50_000), (5001, "long" * 50_000), (1000, "ab"), (1000, "ab"), (None, "ab")]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    found = exact_dedup.mark_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept")
    assert sorted(map(tuple, found.collect()), key=repr) == brute_exact(rows)


@pytest.mark.parametrize("batch_rows", [1, 2, 7])
def test_runs_across_batches_and_ranges(spark, batch_rows):
    """Groups that fill several ranges and many batches, with beginnings in common; ranges of one run and of none."""
    rnd = random.Random(batch_rows)
    start = "the same beginning " * 40
    rows = [(i, start + "a" + " " * (i % 5)) for i in range(150)] + [(200 + i, start + "b") for i in range(40)]
    rows += [(300 + i, start + f"{i:03d}") for i in range(60)] + [(400, "x"), (401, "y")]
    rnd.shuffle(rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
        for parts in ("3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            docs = spark.createDataFrame(rows, DOCS).repartition(5)
            found = exact_dedup.mark_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept")
            assert sorted(map(tuple, found.collect()), key=repr) == brute_exact(rows)
            kept = exact_dedup.deduplicate(docs)
            assert sorted(r.doc_id for r in kept.collect()) == sorted({k for _, k, _, _ in brute_exact(rows)})
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_text_that_fills_several_ranges_is_never_held(spark):
    """2,000 copies of a text of 100,000 characters: rows leave before their run ends, with a batch at most inside."""
    text = "words " * 16_000
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        found = exact_dedup.mark_duplicates(docs)
        (one,) = found.groupBy("keep_id", "group_size").agg(F.count_if("kept").alias("kept"), F.count("*").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert tuple(one) == (0, 2000, 1, 2000)


def test_rows_leave_before_their_run_ends(monkeypatch):
    """The marking of a range never waits: each batch of rows comes out before the next one is asked for."""
    import pyarrow as pa

    class Task:
        def partitionId(self):
            return 3

    monkeypatch.setattr(exact_dedup.TaskContext, "get", lambda: Task())
    asked = []

    def batches():
        for number, text in enumerate(["a", "a", "a", "b"]):
            asked.append(number)
            ids = pa.array([10 * number, 10 * number + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([{"doc_id": i} for i in ids.to_pylist()]), ids, pa.array([text] * 2), pa.array([f"d{text}"] * 2)],
                names=["row", "id", "norm", "digest"],
            )

    seen = []
    for found in exact_dedup._runs(batches()):
        seen.append((len(asked), found.num_rows, found.column("is_run")[0].as_py()))
    assert [s for s in seen if not s[2]] == [(1, 2, False), (2, 2, False), (3, 2, False), (4, 2, False)]
    assert [s[0] for s in seen if s[2]] == [4, 4]


def test_exact_ignores_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x"), (2, "x ")], DOCS)
    clashing = docs.withColumns({name: F.lit("?") for name in ("norm", "digest", "kept", "run", "doc", "row", "head")})
    kept = exact_dedup.deduplicate(clashing)
    assert kept.columns == clashing.columns and [r.doc_id for r in kept.collect()] == [2]
    assert exact_dedup.mark_duplicates(docs.limit(0)).collect() == []


def test_exact_digest(spark):
    docs = spark.createDataFrame([(1, " "), (2, "é b")], DOCS)
    found = {r.doc_id: r.text_sha256 for r in exact_dedup.mark_duplicates(docs).collect()}
    assert found[1] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert found[2] == hashlib.sha256("éb".encode()).hexdigest()


# Fingerprints


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_matches_its_definition():
    rnd = random.Random(0)
    texts = [None, "", " \n", "One", "one two", "ÄÖ Ü\x0bß A", "a b c " * 2000, "x y z\x1c w v"]
    texts += [" ".join(rnd.choices(["the", "A", "of", "Σ", "b c"], k=rnd.randint(1, 40))) for _ in range(50)]
    for text in texts:
        assert simhash_dedup.fingerprint_of(text) & (1 << 64) - 1 == brute_print(text)


def test_golay_code_is_perfect_and_close_words_share_an_index():
    table = simhash_dedup.error_patterns()
    assert len(np.unique(table)) == 2048
    words = np.random.default_rng(0).integers(0, 1 << 23, 300)
    near = simhash_dedup.nearby_codewords(words, table)
    assert {len(set(row)) for row in near.tolist()} <= {1, 6}
    for i, j in itertools.combinations(range(23), 2):
        other = simhash_dedup.nearby_codewords(words ^ 1 << i ^ 1 << j, table)
        assert all(set(a) & set(b) for a, b in zip(near.tolist(), other.tolist()))


def test_any_two_errors_share_a_key():
    table = simhash_dedup.error_patterns()
    value = np.random.default_rng(1).integers(0, 1 << 63, 1).astype(np.uint64)
    keys = lambda v: set(simhash_dedup.fuzzy_keys(v, table)[1].tolist())
    own = keys(value)
    for i, j in itertools.combinations_with_replacement(range(64), 2):
        flipped = value ^ np.uint64(1 << i)
        assert own & keys(flipped ^ np.uint64(1 << j) if i != j else flipped)


@pytest.mark.parametrize("block_rows", [8, 2048])
def test_near_prints_against_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(simhash_dedup, "cells", lambda *a: cells(*a, block_rows))
    rnd = random.Random(3)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    prints = [rnd.getrandbits(64) for _ in range(40)] + [0, 0, 1]
    for _ in range(150):
        prints.append(rnd.choice(centres) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame(list(enumerate(signed)), "id bigint, print bigint")
    found = {r.id: r.component for r in rows.join(simhash_dedup.near_prints(rows), "print").collect()}
    linked = [(i, j) for i, j in itertools.combinations(range(len(prints)), 2) if (prints[i] ^ prints[j]).bit_count() <= 2]
    assert found == brute_components(range(len(prints)), linked)


def test_near_documents_and_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(5, text), (3, text.upper()), (3, text), (9, None), (8, ""), (None, "other words here"), (None, None), (4, "short")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"print": F.lit(1), "row": F.lit(2), "component": F.lit(3)})
    found = simhash_dedup.near_documents(docs).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id) for r in found if r.doc_id} == {(5, 3), (3, 3), (9, 8), (8, 8), (4, 4)}
    assert {r.fingerprint for r in found if r.doc_id in (8, 9)} == {"0" * 16}
    kept = simhash_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 8]
    assert simhash_dedup.near_documents(docs.limit(0)).collect() == []


# Components


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, j) for j in range(101, 180)]
    edges += [(rnd.randint(200, 400), rnd.randint(200, 400)) for _ in range(150)] + [(7, 7), (None, 3), (1, 0), (0, 1)]
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.id: r.component for r in connected_components(table).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert found == brute_components({x for e in real for x in e}, real)
    assert connected_components(table.limit(0)).collect() == []


# Vectors


def brute_links(vectors, cosine=0.9):
    ok = {i: np.array(v, dtype=float) for i, v in vectors if v and None not in v and np.isfinite(v).all() and any(v)}
    pairs = []
    for i, j in itertools.combinations(ok, 2):
        a, b = ok[i], ok[j]
        if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
            pairs.append((i, j))
    return pairs


@pytest.mark.parametrize("block_rows", [16, 2048])
def test_vectors_against_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(vector_dedup, "cells", lambda *a: cells(*a, block_rows))
    draw = np.random.default_rng(2)
    rows = [draw.normal(size=24) for _ in range(150)]
    rows += [rows[i % 20] + draw.normal(size=24) * 0.1 for i in range(150)] + [rows[0] * 3, rows[1], rows[1]]
    vectors = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 24, [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0], [2.0], [1.0, 0.0]]
    vectors += [(1000 + i, v) for i, v in enumerate(odd)]
    table = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").withColumn("rep", F.lit("?"))
    found = {r.vec_id: r for r in vector_dedup.near_vectors(table).collect()}
    pairs = brute_links(vectors)
    assert len(found) == len(vectors) and len(pairs) > 200
    expected = brute_components([i for i, _ in vectors], pairs)
    count = {i: 0 for i in expected}
    for i, j in pairs:
        count[i] += 1
        count[j] += 1
    links = sum(r.n_links for r in found.values())
    assert 0.995 * 2 * len(pairs) <= links <= 2 * len(pairs)
    assert all(found[i].n_links <= count[i] for i in count)
    assert sum(found[i].component_id == expected[i] for i in expected) >= 0.99 * len(expected)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert vector_dedup.near_vectors(table.limit(0)).collect() == []


def test_recall_at_the_threshold():
    draw = np.random.default_rng(4)
    a = vector_dedup.unit_rows(draw.normal(size=(20_000, 64)).ravel(), 20_000)
    b = draw.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    codes = [vector_dedup.bucket_codes(x, vector_dedup.TABLES, vector_dedup.PROBES, 0) for x in (a, b)]
    one, other = (c.reshape(len(a), vector_dedup.TABLES, -1) for c in codes)
    # A pair meets in any bucket that both are put in, whether it is the own of one of them or not.
    met = (one[:, :, :, None] == other[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() >= 0.999


def test_pairs_in_a_shared_bucket_count_once():
    """Also where two rows meet in next likely buckets of both only."""
    draw, tables = np.random.default_rng(6), vector_dedup.TABLES
    a = vector_dedup.unit_rows(draw.normal(size=(3000, 128)).ravel(), 3000)
    b = draw.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    own, other = (vector_dedup.bucket_codes(x, tables, vector_dedup.PROBES, 0) for x in (a, b))
    counted = [
        sum(vector_dedup._meet_first(i[None], j[None], tables, bucket)[0] for bucket in set(i.tolist()) & set(j.tolist()))
        for i, j in zip(own, other)
    ]
    shared = [bool(set(i.tolist()) & set(j.tolist())) for i, j in zip(own, other)]
    assert counted == [int(x) for x in shared] and np.mean(shared) >= 0.997


def test_hadamard_is_orthogonal():
    assert np.allclose(vector_dedup.hadamard(np.eye(16)) @ vector_dedup.hadamard(np.eye(16)).T, 16 * np.eye(16))
