"""Merkle manifests of datasets: a tree of digests for each source, a tree over the sources, and proofs.

Every inner node is stored as a record, its digest and the digests of its children, and is found by its digest
alone. A proof is read by descending from the root: the digits of a leaf's rank, sixteen children a node, select a
child at each record, the other children are collected, and the path is reversed to run from the leaf to the root.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patentflow.storage import scratch_dir, stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_BITS = 4
FAN = 1 << FAN_BITS
SEGMENT = "struct<left:string,right:string>"
TOP = "top"


def digest(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def framed(value: Column) -> Column:
    """A value as its number of bytes, a colon and itself; NULL is a dash, which no value gives."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: list[Column]) -> Column:
    return digest(F.concat(*map(framed, values)))


@dataclass
class Manifest:
    """A stored manifest: its folder, its root, and how many levels of records its trees have."""

    spark: SparkSession
    folder: str
    root: str | None
    depth: int
    top_depth: int

    def leaves(self) -> DataFrame:
        """Rows in their place: `tree`, `idx` (the rank in the source), `size` of the source, and what was given."""
        return self.spark.read.parquet(f"{self.folder}/leaves")

    def subroots(self) -> DataFrame:
        """tree, digest and depth of each source, and its rank `idx`."""
        return self.spark.read.parquet(f"{self.folder}/subroots")

    def records(self, part: str, level: int) -> DataFrame:
        """digest and children of the nodes of a level; equal nodes are one record."""
        stored = self.spark.read.parquet(f"{self.folder}/{part}/{level}")
        return stored.select("digest", "children").dropDuplicates(["digest"])


def build_manifest(leaves: DataFrame, folder: str | None = None) -> Manifest:
    """Store the manifest of rows with `source`, `doc_id` and `leaf` (a hexadecimal digest).

    Leaves of a source ascend by doc_id, NULL first; equal ids by their leaf, so repeated rows make
    repeated leaves in a defined order. Each 16 consecutive nodes are one node above, until one is left; the last
    of a level may have fewer children, even one. Sources follow each other by code points, NULL first. No rows
    give a manifest without a root. Further columns stay with their leaves.

    Ranks come from ranges of the whole order, so the rows of one source are numbered by many tasks, and a group
    of a level has sixteen rows at most. Every level is written before the next one reads it.
    """
    spark = leaves.sparkSession
    folder = folder or scratch_dir(spark)
    # NULL sorts first, and every other source starts with a sign of its own.
    tree = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    placed = stage(_ranked(leaves.withColumn("tree", tree), order, f"{folder}/ranges"), f"{folder}/leaves")
    nodes = placed.select("tree", "idx", F.col("leaf").alias("digest"), "size")
    depth, lone = _build(nodes, f"{folder}/source")
    if depth is None:
        return Manifest(spark, folder, None, 0, 0)
    named = lone.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "digest", "depth")
    tops = stage(_ranked(named, [F.col("name")], f"{folder}/source_ranges"), f"{folder}/subroots")
    top_depth, roots = _build(tops.select("tree", "idx", "digest", "size"), f"{folder}/{TOP}")
    return Manifest(spark, folder, roots.first()["digest"], depth, top_depth)


def _ranked(rows: DataFrame, order: list[Column], folder: str) -> DataFrame:
    """Rows with `idx`, their place in the order of their `tree`, and `size`, the number of its rows.

    Rows are dealt by ranges of (tree, order, place in the table). The place before a range in its tree is a sum of
    counts, the place in a range a row number, so no task holds a tree that is larger than a range.
    """
    place = F.monotonically_increasing_id()
    ranged = rows.withColumn("place", place).repartitionByRange("tree", *order, "place").drop("place")
    parts = stage(ranged.withColumn("part", F.spark_partition_id()), folder)
    counts = parts.groupBy("tree", "part").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    offsets = counts.select("tree", "part", before, F.sum("n").over(whole).alias("size"))
    nth = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))
    numbered = parts.withColumn("nth", nth - 1).join(offsets, ["tree", "part"])
    return numbered.withColumn("idx", F.col("before") + F.col("nth")).drop("part", "nth", "before")


def _build(nodes: DataFrame, folder: str) -> tuple[int | None, DataFrame]:
    """Write the records of all levels of all trees; the number of levels, and (tree, digest, depth) of the
    single nodes that remain."""
    largest = nodes.agg(F.max("size")).first()[0]
    if largest is None:
        return None, nodes
    level, left = 0, largest
    lone = nodes.where("size = 1").select("tree", "digest", F.lit(0).alias("depth"))
    while left > 1:
        level, left = level + 1, -(-left // FAN)
        parent = F.shiftright("idx", FAN_BITS)
        run = nodes.where("size > 1").groupBy("tree", parent.alias("parent"))
        grouped = run.agg(
            F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("run"),
            F.ceil(F.first("size") / FAN).cast("bigint").alias("size"),
        )
        children = grouped.select("tree", F.col("parent").alias("idx"), F.col("run.digest").alias("children"), "size")
        made = children.withColumn("digest", digest(F.concat_ws("", "children")))
        nodes = stage(made, f"{folder}/{level}")
        lone = lone.unionByName(nodes.where("size = 1").select("tree", "digest", F.lit(level).alias("depth")))
    return level, lone


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The leaves with `subroot`, `root` and `path`, an array of (left, right) from the leaf to the root: the
    joined digests of the siblings before and behind the node at each level.

    `requests` (tree, idx) asks for some leaves alone. All requests that share the first digits of their
    rank descend as one, so a record is read once for all below it, and the long paths are joined to whole runs of
    sixteen leaves. A manifest without a root gives no rows.

    Nodes on their way down are never broadcast: Spark takes sixteen children for one row and a path for one pair, so
    it would send tables far above its threshold through the driver. Such joins are asked to be merged.
    """
    spark = manifest.spark
    leaves = manifest.leaves()
    if manifest.root is None:
        return leaves.select("*", *[F.lit("").alias(name) for name in ("subroot", "root")], _no_path())
    if requests is not None:
        requests = requests.select("tree", "idx").distinct()
        leaves = leaves.join(requests, ["tree", "idx"], "left_semi")
    start = spark.range(1).select(F.lit(0).cast("bigint").alias("idx"), F.lit(manifest.root).alias("digest"), _no_path())
    frontier = start
    for level in range(manifest.top_depth, 0, -1):
        frontier = _children(frontier, manifest.records(TOP, level), ["idx"])
    names = manifest.subroots().select("idx", F.col("name").alias("tree"), "depth")
    if requests is not None:
        names = names.join(requests, "tree", "left_semi")
    entering = frontier.hint("merge").join(names, "idx").select("tree", "depth", "digest", "path")
    entering = stage(entering.withColumn("subroot", F.col("digest")).withColumn("idx", F.lit(0).cast("bigint")))
    kept = ["tree", "idx", "subroot", "digest", "path"]

    frontier = entering.where(F.col("depth") == manifest.depth).select(*kept)
    for level in range(manifest.depth, 1, -1):
        below = _children(frontier, manifest.records("source", level), ["tree", "idx", "subroot"])
        if requests is not None:
            prefix = F.shiftright("idx", FAN_BITS * (level - 1)).alias("idx")
            below = below.join(requests.select("tree", prefix), ["tree", "idx"], "left_semi")
        frontier = below.unionByName(entering.where(F.col("depth") == level - 1).select(*kept))

    alone = entering.where("depth = 0").select("tree", "idx", "subroot", "path", F.array("digest").alias("children"))
    if manifest.depth:
        runs = frontier.hint("merge").join(manifest.records("source", 1), "digest")
        runs = runs.select("tree", "idx", "subroot", "path", "children")
        runs = runs.unionByName(alone)
    else:
        runs = alone
    runs = runs.withColumnRenamed("idx", "run")
    found = leaves.withColumn("run", F.shiftright("idx", FAN_BITS)).join(runs.hint("merge"), ["tree", "run"])
    own = _segment(F.col("children"), F.col("idx").bitwiseAND(FAN - 1).cast("int"))
    down = F.when(F.col("size") > 1, F.concat("path", F.array(own))).otherwise(F.col("path"))
    columns = [*leaves.columns, "subroot", F.lit(manifest.root).alias("root"), F.reverse(down).alias("path")]
    return found.select(*columns)


def _no_path() -> Column:
    return F.array().cast(f"array<{SEGMENT}>").alias("path")


def _segment(children: Column, digit: Column) -> Column:
    left, right = F.slice(children, 1, digit), F.slice(children, digit + 2, FAN)
    return F.struct(F.concat_ws("", left).alias("left"), F.concat_ws("", right).alias("right"))


def _children(frontier: DataFrame, records: DataFrame, kept: list[str]) -> DataFrame:
    """One level down: each child with its own rank, its digest and the path that led to it."""
    opened = frontier.hint("merge").join(records, "digest").drop("digest")
    taken = opened.select(*kept, "path", "children", F.posexplode("children").alias("digit", "digest"))
    idx = F.shiftleft("idx", FAN_BITS) + F.col("digit")
    path = F.concat("path", F.array(_segment(F.col("children"), F.col("digit"))))
    return taken.select(*[idx.alias(name) if name == "idx" else name for name in kept], "digest", path.alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda node, at: digest(F.concat(at["left"], node, at["right"])))


def siblings(path: Column) -> Column:
    """All siblings of a path, from the leaf to the root, left to right."""
    return F.concat_ws("", F.transform(path, lambda at: F.concat(at["left"], at["right"])))


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """source, doc_id and `leaf` of documents, from all their fields, NULL or not, and whole texts.

    With `tampered`, a text that somebody may have put in the place of the true one, also the leaf that this text
    would give, NULL where it is NULL. No other column matters.
    """
    values = [F.col(name) for name in FIELDS]
    columns = [F.col("source"), F.col("doc_id"), leaf_of(values).alias("leaf")]
    if tampered is not None:
        other = leaf_of([*values[:-1], F.col("other")])
        rows = docs.select(*FIELDS, tampered.alias("other"))
        return rows.select(*columns, F.when(F.col("other").isNotNull(), other).alias("tampered"))
    return docs.select(*columns)
