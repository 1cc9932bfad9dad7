"""Comparing the rows that share a bucket, without one task or one join ever holding a whole bucket."""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048


def cells(rows: DataFrame, bucket: list[str], ident: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of buckets with two rows or more, dealt to cells: columns `left`, `right` and `side` are added.

    A bucket of at most `block_rows` rows is one cell (0, 0). A larger one is cut into blocks by a hash
    of `ident`, and each pair of blocks is a cell, so any two of its rows meet in exactly one cell and no
    cell holds more than about two blocks. `side` is the row's own block. `rows` should be a stored
    table, as it is read twice. Rows with a NULL bucket column are in no bucket.
    """
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block_rows).cast("int")
    dealt = rows.join(sizes, bucket).withColumn("blocks", blocks)
    side = F.pmod(F.xxhash64(ident), "blocks").cast("int")
    pairs = dealt.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left, right = F.least("side", "other").alias("left"), F.greatest("side", "other").alias("right")
    return pairs.select(*rows.columns, left, right, "side")


def compare_cells(
    dealt: DataFrame, bucket: list[str], compare: Callable[[dict], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """Run `compare` on the columns of each cell; cells come together by a shuffle and a sort.

    `compare` gets numpy arrays (lists as lists) of one cell by column name. Tasks stream over their
    sorted rows and hold one cell at a time.
    """
    key = [*bucket, "left", "right"]
    together = dealt.repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, key):
            yield from compare(cell)

    return together.mapInArrow(run, schema)


def runs(batches: Iterable[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Tables of two or more neighbouring rows that agree in the key columns, from sorted batches."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        codes = [np.asarray(table.column(name)) for name in key]
        change = np.zeros(table.num_rows - 1, dtype=bool)
        for code in codes:
            change |= code[1:] != code[:-1]
        starts = np.concatenate(([0], np.flatnonzero(change) + 1, [table.num_rows]))
        if held and all(held[-1].column(k)[0] == table.column(k)[0] for k in key):
            held.append(table.slice(0, starts[1]))
            starts = starts[1:]
            if len(starts) == 1:
                continue
        if held and sum(part.num_rows for part in held) > 1:
            yield pa.concat_tables(held)
        for i in np.flatnonzero(np.diff(starts[:-1]) > 1):
            yield table.slice(starts[i], starts[i + 1] - starts[i])
        held = [table.slice(starts[-2], starts[-1] - starts[-2])]
    if held and sum(part.num_rows for part in held) > 1:
        yield pa.concat_tables(held)


class Stars:
    """Union of links between the rows of a cell, kept as a forest of one number per row."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Join the trees of linked rows: smaller roots are taken over until nothing changes."""
        while True:
            a, b = self.root[i], self.root[j]
            differ = a != b
            if not differ.any():
                return
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while ((above := self.root[self.root]) != self.root).any():
                self.root = above

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, root) of the rows that are not their own root: fewer edges than rows."""
        rows = np.flatnonzero(self.root != np.arange(len(self.root)))
        return rows, self.root[rows]
