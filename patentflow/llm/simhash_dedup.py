"""Near-duplicate texts: SimHash fingerprints matched by Golay-code fuzzy hashing."""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patentflow.llm.buckets import Stars, cells, compare_cells
from patentflow.llm.components import connected_components
from patentflow.storage import stage

SHINGLE_WORDS, SEED = 3, 42
MAX_BITS = 2
# Segments of a fingerprint as (lowest bit, bits): 64 bits in three words of at most 23.
SEGMENTS = ((0, 22), (22, 21), (43, 21))

# The binary Golay code: words of 23 bits, 12 of them free, any two words 7 bits apart or more. Fixed
# value: its generator polynomial, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR, WORD_BITS, CHECK_BITS = 0b110001110101, 23, 11


def fingerprint_of(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of a whole text.

    A-Z are lower-cased, words are what stands between ASCII white space; every run of `words` words is
    hashed, repetitions included. A bit is set if it is in more than half of the hashes. Fewer words are
    hashed as one sequence, no words give 0.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
    last = ends[min(words, len(tokens)) - 1 :].tolist()
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], seed) for i, j in zip(first, last)), dtype="<u8", count=len(last))
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed 64-bit number."""

    @F.pandas_udf(T.LongType())
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint_of(text, words) for text in batch], dtype="int64")

    return simhash(text)


def remainders(words: np.ndarray) -> np.ndarray:
    """Words of 23 bits modulo the generator polynomial: 0 exactly for code words."""
    rest = words.astype(np.int64)
    for bit in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ GENERATOR << (bit - CHECK_BITS), rest)
    return rest


def error_patterns() -> np.ndarray:
    """For each remainder the one pattern of at most three bits that leaves it: the code is perfect."""
    bits = [0, *(1 << i for i in range(WORD_BITS))]
    errors = np.unique([a | b | c for a in bits for b in bits for c in bits])
    table = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    table[remainders(errors)] = errors
    return table


def nearby_codewords(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Indices of the code words that each word and its 23 neighbours decode to: one or six different
    ones.

    Words up to two bits apart share one: a word between them is a neighbour of both.
    """
    flips = np.array([0, *(1 << i for i in range(WORD_BITS))], dtype=np.int64)
    around = words[:, None] ^ flips[None, :]
    return (around ^ table[remainders(around)]) >> CHECK_BITS


def fuzzy_keys(prints: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) such that fingerprints with at most two differing bits share a key.

    Two errors leave one of three segments untouched, and at most two in the following one. So a key is
    the number of a segment, its exact bits, and the index of a code word near the following segment.
    """
    parts = [(prints >> np.uint64(low) & np.uint64((1 << bits) - 1)).astype(np.int64) for low, bits in SEGMENTS]
    rows, keys = [], []
    for i, exact in enumerate(parts):
        near = np.sort(nearby_codewords(parts[(i + 1) % len(parts)], table), axis=1)
        fresh = np.ones(near.shape, dtype=bool)
        fresh[:, 1:] = near[:, 1:] != near[:, :-1]
        row, at = np.nonzero(fresh)
        rows.append(row)
        keys.append(i << 40 | exact[row] << 12 | near[row, at])
    return np.concatenate(rows), np.concatenate(keys)


def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = error_patterns()
    for batch in batches:
        prints, rep = batch.column("print").to_numpy().view(np.uint64), batch.column("rep").to_numpy()
        row, key = fuzzy_keys(prints, table)
        columns = [pa.array(rep[row]), pa.array(prints[row].view(np.int64)), pa.array(key)]
        yield pa.RecordBatch.from_arrays(columns, names=["rep", "print", "bucket"])


def _compare(max_bits: int) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
    def run(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        """Edges of a forest over the fingerprints of a cell that differ in few bits."""
        left, right = cell.column("left")[0].as_py(), cell.column("right")[0].as_py()
        rep, side = (cell.column(name).to_numpy() for name in ("rep", "side"))
        prints = cell.column("print").to_numpy().view(np.uint64)
        lefts, rights = np.flatnonzero(side == left), np.flatnonzero(side == right)
        stars = Stars(len(rep))
        for start in range(0, len(lefts), 256):
            rows = lefts[start : start + 256]
            near = np.bitwise_count(prints[rows][:, None] ^ prints[rights][None, :]) <= max_bits
            i, j = np.nonzero(near)
            stars.add(rows[i], rights[j])
        rows, roots = stars.edges()
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rep[rows]), pa.array(rep[roots])], names=["rep", "root"])

    return run


def near_prints(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(print, component) of each distinct fingerprint in `rows(id, print)`, which should be a stored
    table.

    The component is the smallest id of all rows whose fingerprints are connected by steps of at most `max_bits`
    bits, two at most, which is what the keys are made for. Equal fingerprints are one class and are matched once. Rows with a NULL id have a component only
    if others share it.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"keys find pairs of at most {MAX_BITS} differing bits")
    classes = stage(rows.groupBy("print").agg(F.min("id").cast("bigint").alias("rep")))
    known = classes.where("rep IS NOT NULL")
    keys = stage(known.mapInArrow(_keys, "rep bigint, print bigint, bucket bigint"))
    dealt = cells(keys, ["bucket"], "rep")
    edges = compare_cells(dealt, ["bucket"], _compare(max_bits), "rep bigint, root bigint")
    groups = connected_components(edges).withColumnRenamed("id", "rep")
    joined = classes.join(groups, "rep", "left")
    return joined.select("print", F.coalesce("component", "rep").alias("component"))


def near_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """id, fingerprint (16 hex digits) of shingles of `words` words, component_id of every row.

    NULL and empty texts have fingerprint zero and are linked like any other. Repeated rows are repeated
    in the result. A NULL id takes part in no link, but gets the component of its fingerprint. An empty
    table gives no rows.
    """
    prints = stage(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("print")))
    joined = prints.join(near_prints(prints, max_bits), "print")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return joined.select(
        F.col("id").alias(id_col), digits.alias("fingerprint"), F.col("component").alias("component_id")
    )


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row of each group of near-duplicates, with the columns it came with: the row with the smallest
    id.

    Of several rows with that id one stays. Rows with a NULL id all stay unless they share a fingerprint.
    """
    numbered = docs.select(
        F.struct("*").alias("doc"),
        F.col(id_col).cast("bigint").alias("id"),
        fingerprint(F.col(text_col), words).alias("print"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(numbered)
    narrow = rows.select("id", "print", "row")
    grouped = narrow.join(near_prints(narrow, max_bits), "print")
    # Groups without any id are told apart by their fingerprints.
    own_print = F.when(F.col("component").isNull(), F.col("print"))
    order = F.struct(F.col("id").isNull().alias("is_null"), "id", "row")
    first = grouped.groupBy("component", own_print.alias("own_print")).agg(F.min(order).alias("first"))
    return rows.join(first.select(F.col("first.row").alias("row")), "row", "left_semi").select("doc.*")
