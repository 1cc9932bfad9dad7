"""Exact deduplication by sorting content."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from patentflow.storage import stage

WHITE_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SPLITTER_CHARS = 64

DECIDED = T.StructType(
    [
        T.StructField("keep_id", T.LongType()),
        T.StructField("group_size", T.LongType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("text_sha256", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("run", T.IntegerType()),
        T.StructField("is_run", T.BooleanType()),
        T.StructField("border", T.BooleanType()),
        T.StructField("edge", T.StringType()),
    ]
)


def normalised(text: Column) -> Column:
    """The text without white space; NULL counts as empty. Byte searches are far cheaper than a regex."""
    text = F.coalesce(text, F.lit(""))
    for char in WHITE_SPACE:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def mark_duplicates(docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The `keep` columns of every row, with keep_id, group_size, kept and text_sha256.

    Rows are equal when their normalised texts are; of equal rows the one with the most code points in
    the original text stays, then the one with the smallest id. One row of a group is kept, also when an
    id occurs twice. NULL and empty texts are one group; a NULL id sorts last. Other columns of the input
    do not matter and may have any name. An empty table gives no rows.

    Sampled splitters deal the rows to ranges of content order, every range is sorted externally, and each row is
    compared with its whole neighbour. Content order is that of the first 64 characters; texts that agree in these
    follow each other by their digest and then by all their bytes, so that what is sampled to the driver is bounded
    and one common beginning does not fill a range. Length and id follow in the order, so a group of any
    size is spread over several ranges; `_whole_runs` puts it together again. Very long texts take a few times their
    size in one task at a time; no task holds more than a batch of rows and the text it compares with.
    """
    keep = [id_col] if keep is None else keep
    text = F.coalesce(F.col(text_col), F.lit(""))
    carried = F.struct(*[F.col(name) for name in keep]).alias("row")
    rows = docs.select(
        carried,
        F.col(id_col).cast("bigint").alias("id"),
        F.char_length(text).alias("n_chars"),
        normalised(F.col(text_col)).alias("norm"),
    )
    rows = rows.withColumn("digest", F.sha2(F.col("norm").cast("binary"), 256))
    rows = rows.withColumn("head", F.substring("norm", 1, SPLITTER_CHARS))
    within = [F.col("n_chars").desc(), F.col("id").asc_nulls_last()]
    ranges = rows.repartitionByRange("head", "digest", *within)
    ranges = ranges.sortWithinPartitions("head", "digest", "norm", *within)
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), *DECIDED.fields])
    found = stage(ranges.select("row", "id", "norm", "digest").mapInArrow(_runs, schema))
    return _whole_runs(found).select("row.*", "keep_id", "group_size", "kept", "text_sha256")


class _Run:
    """A run of equal texts that is not yet known to have ended."""

    def __init__(self, number: int, head: int | None, digest: str, text: str):
        self.number, self.head, self.digest, self.text, self.size = number, head, digest, text, 0


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark the runs of equal neighbours of one sorted range; rows leave at once.

    `run` counts on. The rows of a run that begins and ends within a batch know its size. Those of the first run and
    of a run at the end of a batch have a NULL size; when such a run ends, a row of its own (`is_run`) tells its
    size. The first run of the range and its last, which another range may go on with, are its `border`, and that row
    has their whole text as `edge`.
    """
    part, run = TaskContext.get().partitionId(), None

    def ended(is_last: bool) -> pa.RecordBatch:
        border = is_last or run.number == 0
        values = {"keep_id": run.head, "group_size": run.size, "text_sha256": run.digest, "part": part, "run": run.number}
        values |= {"is_run": True, "border": border, "edge": run.text if border else None}
        arrays = [pa.nulls(1, row_type)]
        arrays += [pa.array([values.get(field.name)], to_arrow_type(field.dataType)) for field in DECIDED]
        return pa.RecordBatch.from_arrays(arrays, names=["row", *DECIDED.names])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        texts, ids, digests, row_type = batch.column("norm"), batch.column("id"), batch.column("digest"), batch.column("row").type
        same = np.asarray(pc.equal(texts.slice(1), texts.slice(0, n - 1))).astype(bool)
        starts = np.concatenate(([0], np.flatnonzero(~same) + 1))
        sizes = np.diff(np.concatenate((starts, [n])))
        goes_on = run is not None and texts[0].as_py() == run.text
        if run is not None and not goes_on:
            yield ended(False)
        number = 0 if run is None else run.number + (not goes_on)
        numbers = number + np.arange(len(starts))
        heads = ids.take(pa.array(starts)).to_pylist()
        is_open = np.zeros(len(starts), dtype=bool)
        is_open[0] = goes_on or number == 0
        is_open[-1] = True
        kept = np.zeros(n, dtype=bool)
        kept[starts] = True
        if goes_on:
            heads[0], kept[0] = run.head, False
        at = np.repeat(np.arange(len(starts)), sizes)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(heads, pa.int64()).take(pa.array(at)),
                pa.array(sizes[at], pa.int64(), mask=is_open[at]),
                pa.array(kept),
                digests,
                pa.array(np.full(n, part, dtype=np.int32)),
                pa.array(numbers[at].astype(np.int32)),
                pa.array(np.zeros(n, dtype=bool)),
                pa.array(np.zeros(n, dtype=bool)),
                pa.nulls(n, pa.string()),
            ],
            names=["row", *DECIDED.names],
        )
        if not goes_on:
            run = _Run(number, heads[0], digests[0].as_py(), texts[0].as_py())
        run.size += int(sizes[0])
        if len(starts) > 1:
            if is_open[0]:
                yield ended(False)
            begin = int(starts[-1])
            run = _Run(int(numbers[-1]), heads[-1], digests[begin].as_py(), texts[begin].as_py())
            run.size = int(sizes[-1])
    if run is not None:
        yield ended(True)


def _whole_runs(found: DataFrame) -> DataFrame:
    """The rows with the sizes and heads of their runs, those that the end of a range cut put together.

    Only the last run of a range and the first of the next can be parts of one. Their digests tell which may be, and
    their whole texts which are; the table of borders has at most two rows for each range, whatever the number of
    documents, and texts are joined in pairs. Rows of runs inside a batch go by unshuffled.
    """
    rows, runs = found.where("NOT is_run"), found.where("is_run")
    borders = runs.where("border")
    in_order = Window.orderBy("part", "run")
    earlier = F.lag(F.struct("part", "run", "text_sha256")).over(in_order).alias("earlier")
    narrow = borders.select("part", "run", "keep_id", "group_size", "text_sha256", earlier)
    alike = narrow.where(F.col("text_sha256") == F.col("earlier.text_sha256"))
    pairs = alike.select("part", "run", F.col("earlier.part").alias("part_before"), F.col("earlier.run").alias("run_before"))
    edges = borders.select("part", "run", "edge")
    before = edges.toDF("part_before", "run_before", "edge_before")
    equal = pairs.join(edges, ["part", "run"]).join(before, ["part_before", "run_before"])
    equal = equal.where(F.col("edge") == F.col("edge_before")).select("part", "run", F.lit(True).alias("continues"))

    chained = narrow.join(equal, ["part", "run"], "left")
    continues = F.coalesce("continues", F.lit(False))
    running = in_order.rowsBetween(Window.unboundedPreceding, 0)
    chained = chained.withColumn("chain", F.sum(F.when(continues, 0).otherwise(1)).over(running))
    heads = chained.groupBy("chain").agg(
        F.sum("group_size").alias("total"), F.min(F.struct("part", "run", "keep_id")).alias("least")
    )
    joined = chained.join(heads, "chain")
    inside = runs.where("NOT border").select("part", "run", F.col("keep_id").alias("head"), F.col("group_size").alias("total"), F.lit(False).alias("continues"))
    whole = joined.select("part", "run", F.col("least.keep_id").alias("head"), "total", continues.alias("continues"))
    mended = rows.where("group_size IS NULL").join(whole.unionByName(inside), ["part", "run"])
    mended = mended.select(
        "row",
        F.col("head").alias("keep_id"),
        F.col("total").alias("group_size"),
        (F.col("kept") & ~F.col("continues")).alias("kept"),
        "text_sha256",
    )
    done = rows.where("group_size IS NOT NULL")
    return done.select("row", "keep_id", "group_size", "kept", "text_sha256").unionByName(mended)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with."""
    marked = mark_duplicates(docs.select(F.struct("*").alias("doc"), id_col, text_col), ["doc"], id_col, text_col)
    return marked.where("kept").select("doc.*")
