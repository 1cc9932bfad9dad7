"""Mixing sources to target weights by capped water-filling."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patentflow.llm.sharding import hash_bits
from patentflow.storage import stage

WORDS = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
WEIGHTS = (5, 2, 1)
DRAW_BITS, SLICE_BITS = 60, 12


def n_words(text: Column) -> Column:
    """Number of words between white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def draw(id_col: str, seed: int) -> Column:
    """60 seeded bits per id, which put the documents of a source in random order."""
    return hash_bits(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def measure(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Narrow stored rows id, source, size, draw: the texts are read once."""
    return stage(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            n_words(F.col(text_col)).alias("size"),
            draw(id_col, seed).alias("draw"),
        )
    )


def weighted(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Add the weight of each source: `weights` in turn over the sources by code point, NULL last.

    Sources are numbered within sampled ranges, and the ranges by their counts, so no task sorts all
    of them; only one row a range meets in one task.
    """
    order = F.col("source").asc_nulls_last()
    ranged = stage(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    offsets = counts.select("part", before.alias("before"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    numbered = ranged.withColumn("nth", nth).join(offsets, "part")
    turn = (F.col("nth") + F.col("before")) % len(weights)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), turn.cast("int")).cast("bigint")
    return numbered.select("source", "source_size", weight.alias("weight"))


def water_fill(sources: DataFrame, total: int | None = None, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add `target` to (source, source_size, weight).

    The total (all sizes, unless given) is shared by weight. Sources whose share would exceed
    `max_epochs` times their size are held there, and the rest is shared by weight among the others, until
    none is above. Each round is one aggregation to four numbers. A total that no mix can reach leaves all
    sources at their caps.
    """
    cap = F.col("source_size") * max_epochs
    if total is None:
        total = sources.agg(F.sum("source_size")).first()[0] or 0
    held, n_held, level = F.lit(False), -1, F.lit(0.0)
    while True:
        capped, weight, now = sources.agg(
            F.coalesce(F.sum(F.when(held, cap).otherwise(0)), F.lit(0)),
            F.coalesce(F.sum(F.when(held, 0).otherwise(F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(held.cast("int")), F.lit(0)),
        ).first()
        if now == n_held or not weight:
            return sources.withColumn("target", F.when(held, cap.cast("double")).otherwise(level))
        n_held, level = now, F.col("weight") * F.lit((total - capped) / weight)
        held = level >= cap


def plan(
    measured: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, total: int | None = None
) -> DataFrame:
    """One stored row a source: source, source_size, target, whole, last_draw, last_id.

    Each document of a source is taken `whole` times, and once more if its (draw, id) is not above
    (last_draw, last_id): that is a seeded sample of the documents whose words come nearest to the
    fraction that is missing. The running sum of words that finds the cut is taken over 4096 slices of the
    draws; only the slice that holds the cut is sorted, so a source may hold any share of the rows.
    """
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    filled = water_fill(stage(weighted(sizes, weights)), total, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate).cast("bigint")
    sources = stage(filled.withColumn("whole", whole).withColumn("rest", F.col("target") - whole * F.col("source_size")))

    same_source = F.col("a.source").eqNullSafe(F.col("b.source"))
    shift = DRAW_BITS - SLICE_BITS
    slice_of = F.shiftright("draw", shift)
    sliced = measured.withColumn("slice", slice_of.cast("int"))
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    through = F.sum("words").over(Window.partitionBy("source").orderBy("slice")).alias("through")
    running = sums.select("source", "slice", "words", through).alias("a")
    cut_slice = running.join(sources.alias("b"), same_source).where(
        (F.col("rest") > 0) & (F.col("rest") < F.col("through")) & (F.col("rest") >= F.col("through") - F.col("words"))
    )
    cut = cut_slice.select("a.source", "slice", (F.col("rest") - F.col("through") + F.col("words")).alias("room"))
    inside = sliced.alias("a").join(cut.alias("b"), same_source & (F.col("a.slice") == F.col("b.slice")))
    inside = inside.select("a.source", "a.draw", "a.id", "a.size", "b.room")
    peers = Window.partitionBy("source").orderBy("draw", "id")
    upto = F.sum("size").over(peers.rangeBetween(Window.unboundedPreceding, 0))
    placed = inside.withColumn("upto", upto)
    group = F.sum("size").over(Window.partitionBy("source", "draw", "id"))
    taken = placed.withColumn("own", group).where(F.col("upto") - F.col("own") / 2 <= F.col("room"))
    last = taken.groupBy("source").agg(F.max(F.struct("draw", "id")).alias("last")).alias("a")
    whole_slices = cut.alias("b").join(last, same_source, "left")
    edge = whole_slices.select(
        "b.source",
        F.coalesce("last.draw", F.shiftleft(F.col("slice").cast("bigint"), shift) - 1).alias("last_draw"),
        F.col("last.id").alias("last_id"),
    ).alias("a")
    joined = sources.alias("b").join(edge, same_source, "left")
    return stage(joined.select("b.source", "source_size", "target", "whole", "last_draw", "last_id"))


def copies() -> Column:
    """How often the mix takes a document, from its draw and id and the plan of its source."""
    above = F.col("draw") > F.col("last_draw")
    tied = (F.col("draw") == F.col("last_draw")) & (F.coalesce(F.col("id") > F.col("last_id"), F.lit(False)))
    extra = F.coalesce(~above & ~tied, F.lit(False))
    return F.col("whole") + extra.cast("bigint")


def mix_amounts(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """id, size, source_size, target, taken of every row.

    Size is the number of words, 0 for NULL. NULL is a source of its own. Sources without words get
    nothing. Rows with the same id are taken alike. An empty table gives no rows.
    """
    measured = measure(docs, seed, id_col, text_col, source_col)
    sources = plan(measured, weights, max_epochs).alias("b")
    joined = measured.alias("a").join(sources, F.col("a.source").eqNullSafe(F.col("b.source")))
    return joined.select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * copies()).alias("taken")
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of the mix with the columns they came with, each as often as it is taken.

    Texts are not shuffled while the plan, of one row a source, is small enough for Spark to broadcast.
    """
    measured = measure(docs, seed, id_col, text_col, source_col)
    sources = plan(measured, weights, max_epochs)
    whole = docs.select(
        F.struct("*").alias("doc"),
        F.col(source_col).alias("source"),
        F.col(id_col).alias("id"),
        draw(id_col, seed).alias("draw"),
    ).alias("a")
    joined = whole.join(sources.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
    repeated = joined.select("doc", F.explode(F.array_repeat(F.lit(0), copies().cast("int"))))
    return repeated.select("doc.*")
