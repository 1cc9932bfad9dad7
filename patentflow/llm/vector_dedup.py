"""Near-duplicate vectors by cross-polytope hashing."""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentflow.llm.buckets import Stars, cells, compare_cells
from patentflow.llm.components import connected_components
from patentflow.storage import stage

COSINE = 0.9
TABLES, PROBES, ROTATIONS = 6, 4, 3
CHUNK = 512


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The Hadamard transform of each row, unscaled, by log2(n) rounds of sums and differences."""
    n, half = rows.shape[1], 1
    while half < n:
        pairs = rows.reshape(len(rows), -1, 2, half)
        rows = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(rows), n)
        half *= 2
    return rows


def nearest_vertices(unit: np.ndarray, seed: int, n: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and squared lengths of the `n` cross-polytope vertices nearest to each rotated row.

    A rotation is three rounds of seeded sign flips and a Hadamard transform over the dimensions, filled
    up to a power of two. A vertex is a dimension with the sign of its component.
    """
    signs = np.random.default_rng(seed)
    size = max(4, 1 << (unit.shape[1] - 1).bit_length())
    rotated = np.pad(unit, ((0, 0), (0, size - unit.shape[1])))
    for _ in range(ROTATIONS):
        rotated = hadamard(rotated * signs.choice([-1.0, 1.0], size)) / np.sqrt(size)
    largest = np.argsort(-np.abs(rotated), axis=1, kind="stable")[:, :n]
    values = np.take_along_axis(rotated, largest, 1)
    return largest * 2 + (values < 0), np.abs(values)


def bucket_codes(unit: np.ndarray, tables: int, probes: int, seed: int) -> np.ndarray:
    """For each row and table its own bucket and then its next likely ones: rows x (tables * probes).

    A bucket is a pair of vertices under two rotations. The next likely ones are those whose vertices are
    least nearer to the opposite side than the row's own.
    """
    codes = []
    for table in range(tables):
        a, near_a = nearest_vertices(unit, seed + 2 * table)
        b, near_b = nearest_vertices(unit, seed + 2 * table + 1)
        pairs = [(i, j) for i in range(a.shape[1]) for j in range(b.shape[1])]
        code = np.stack([a[:, i] * (1 << 20) + b[:, j] for i, j in pairs], axis=1)
        loss = [(near_a[:, 0] - near_a[:, i]) ** 2 + (near_b[:, 0] - near_b[:, j]) ** 2 for i, j in pairs]
        order = np.argsort(np.stack(loss, axis=1), axis=1, kind="stable")[:, :probes]
        own = np.int64(unit.shape[1]) << 48 | np.int64(table) << 41
        codes.append(np.take_along_axis(code, order, 1) + own)
    return np.concatenate(codes, axis=1)


def unit_rows(flat: np.ndarray, n: int) -> np.ndarray:
    """Rows of length one in double precision; rows are scaled first, so no square over- or underflows."""
    rows = flat.astype(np.float64).reshape(n, -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _hash_batches(tables: int, probes: int, seed: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            dims = np.asarray(vectors.value_lengths())
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                flat = np.asarray(part.column("embedding").flatten())
                codes = bucket_codes(unit_rows(flat, part.num_rows), tables, probes, seed)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), codes.shape[1])
                columns = [part.column(name) for name in ("rep", "size", "embedding")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, lists.cast(pa.list_(pa.int64()))], names=["rep", "size", "embedding", "codes"]
                )

    return run


def _meet_first(own: np.ndarray, other: np.ndarray, tables: int, bucket: int) -> np.ndarray:
    """For pairs of rows: whether `bucket` is the smallest of all buckets that both are put in."""
    pairs = len(own)
    own, other = own.reshape(pairs, tables, -1), other.reshape(pairs, tables, -1)
    shared = (own[:, :, :, None] == other[:, :, None, :]).any(axis=3)
    return np.where(shared, own, np.iinfo(np.int64).max).min(axis=(1, 2)) == bucket


def _compare(tables: int, cosine: float) -> Callable:
    def run(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, left, right = (cell.column(name)[0].as_py() for name in ("bucket", "left", "right"))
        n = cell.num_rows
        rep, size, side = (cell.column(name).to_numpy() for name in ("rep", "size", "side"))
        unit = unit_rows(cell.column("embedding").combine_chunks().flatten().to_numpy(), n)
        codes = cell.column("codes").combine_chunks().flatten().to_numpy().reshape(n, -1)
        lefts, rights = np.flatnonzero(side == left), np.flatnonzero(side == right)
        links, stars = np.zeros(n, dtype=np.int64), Stars(n)
        for start in range(0, len(lefts), CHUNK):
            rows = lefts[start : start + CHUNK]
            a, b = np.nonzero(unit[rows] @ unit[rights].T >= cosine)
            a, b = rows[a], rights[b]
            if left == right:
                once = a < b
                a, b = a[once], b[once]
            for at in range(0, len(a), 1 << 16):
                i, j = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
                first = _meet_first(codes[i], codes[j], tables, bucket)
                i, j = i[first], j[first]
                links += np.bincount(i, weights=size[j], minlength=n).astype(np.int64)
                links += np.bincount(j, weights=size[i], minlength=n).astype(np.int64)
                stars.add(i, j)
        linked = np.flatnonzero(links)
        if len(linked):
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[linked]), pa.array(links[linked]), pa.array(rep[stars.root[linked]])],
                names=["rep", "links", "root"],
            )

    return run


def is_comparable(vector: Column) -> Column:
    """Not NULL, not zero, and all components finite numbers."""
    is_odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~is_odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    rows: DataFrame,
    cosine: float = COSINE,
    tables: int = TABLES,
    probes: int = PROBES,
    seed: int = 0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """id, n_links, component_id, kept of every row.

    Two vectors of equal dimension link if they meet in a bucket and their cosine in double precision is
    at least `cosine`. With six tables and four probes, pairs at a cosine of 0.9 meet with a probability
    of 0.999, closer ones with more; no pair below the threshold links. Equal vectors are one class, which
    is hashed once and links all its rows.

    Vectors that are NULL, empty, zero or have NULL or non-finite components, and rows with a NULL id,
    link with nothing and are kept. A repeated row counts as another vector. An empty table gives no rows.

    Every pair that meets several times is counted in the smallest of its buckets only, so pairs never leave
    the cell that compares them: it returns sums and the edges of a forest, at most one a row.
    """
    slim = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"))
    usable = F.col("id").isNotNull() & is_comparable(F.col("embedding"))
    valid = slim.where(usable)
    classes = valid.groupBy("embedding").agg(F.min("id").alias("rep"), F.count("*").alias("size"))
    element = rows.schema[vector_col].dataType.simpleString()
    schema = f"rep bigint, size bigint, embedding {element}, codes array<bigint>"
    hashed = stage(
        classes.select(F.col("rep").cast("bigint"), "size", "embedding").mapInArrow(
            _hash_batches(tables, probes, seed), schema
        )
    )
    keys = hashed.select("rep", F.explode("codes").alias("bucket"))
    dealt = cells(keys, ["bucket"], "rep").join(hashed, "rep")
    found = stage(compare_cells(dealt, ["bucket"], _compare(tables, cosine), "rep bigint, links bigint, root bigint"))

    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select("rep", "root")).withColumnRenamed("id", "rep")
    described = hashed.select("rep", "size", "embedding").join(sums, "rep", "left").join(groups, "rep", "left")
    joined = valid.join(described, "embedding")
    n_links = F.coalesce("links", F.lit(0)) + F.col("size") - 1
    component = F.coalesce("component", "rep")
    linked = joined.select("id", n_links.alias("n_links"), component.alias("component_id"))
    alone = slim.where(~usable).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    whole = linked.unionByName(alone)
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return whole.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))
