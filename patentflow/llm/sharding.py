"""Shards of bounded size by extendible hashing."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentflow.storage import stage

HASH_BITS = 60


def hash_bits(value: Column) -> Column:
    """60 bits of the md5 of a value's text as a non-negative number; NULL hashes as empty text."""
    digits = F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def assign_shards(
    docs: DataFrame,
    shard_bytes: int,
    key: str = "doc_id",
    id_col: str = "doc_id",
    text_col: str = "text",
    step_bits: int = 4,
) -> DataFrame:
    """id, bytes, shard, depth, shard_bytes, shard_rows, oversized of every row.

    The directory starts with one bucket. A bucket of more than `shard_bytes` splits on the next bit of
    the hash of `key`, and no other does; a shard's name is the bits that lead to it, so any row finds its
    shard by its hash alone and a table that grows only splits some of its shards. Rows of one key share
    all 60 bits: beyond them the bits of the hash of id and text follow, then those of a number given to
    each row, so a key may hold any share of the rows. What is left `oversized` is a single row above the
    limit. NULL and empty texts have no bytes, NULL keys are one key. An empty table gives no rows.

    Bytes are first summed per cell of as many bits as fill a shard on average, plus `step_bits`; which
    prefixes split is read off those sums. Only cells that are too large even then go on, with their rows
    alone, `step_bits` at a time. Rows are narrow throughout, and nothing but the total comes to the
    driver.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage(
        docs.select(
            F.col(id_col),
            F.octet_length(text).cast("bigint").alias("bytes"),
            hash_bits(F.col(key)).alias("h0"),
            hash_bits(F.concat_ws(" ", F.col(id_col).cast("string"), F.md5(text))).alias("h1"),
            F.monotonically_increasing_id().alias("number"),
        )
    ).withColumn("h2", hash_bits(F.col("number")))
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    first = max(1, math.ceil(math.log2(max(1, total / shard_bytes)))) + step_bits
    open_rows = rows.withColumn("prefix", F.lit(""))
    done = None
    for column in ("h0", "h1", "h2"):
        at = 0
        while at < HASH_BITS:
            bits = min(first if done is None else step_bits, HASH_BITS - at)
            shards, left = _split(open_rows, column, at, bits, shard_bytes)
            done = shards if done is None else done.unionByName(shards)
            at += bits
            if left.isEmpty():
                return _described(done, shard_bytes, id_col)
            open_rows = stage(left)
    return _described(done.unionByName(open_rows.withColumnRenamed("prefix", "shard")), shard_bytes, id_col)


def _split(rows: DataFrame, column: str, at: int, bits: int, shard_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose shard is found within `bits` more bits, and the rows of cells that are still too large."""
    path = F.substring(F.lpad(F.conv(F.col(column).cast("string"), 10, 2), HASH_BITS, "0"), at + 1, bits)
    celled = rows.withColumn("cell", path)
    cells = celled.groupBy("prefix", "cell").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
    depths = cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(bits))))
    cut = F.expr("substring(cell, 1, depth)").alias("cut")
    sums = depths.groupBy("prefix", "depth", cut).agg(F.sum("bytes").alias("sum"), F.sum("rows").alias("n"))
    fitting = sums.where((F.col("sum") <= shard_bytes) | (F.col("n") == 1))
    leaves = depths.select("prefix", "cell", "depth", cut).join(fitting, ["prefix", "depth", "cut"])
    depth_of = leaves.groupBy("prefix", "cell").agg(F.min("depth").alias("depth"))
    placed = celled.join(depth_of, ["prefix", "cell"], "left")
    found = placed.where("depth IS NOT NULL").withColumn("shard", F.expr("concat(prefix, substring(cell, 1, depth))"))
    left = placed.where("depth IS NULL").withColumn("prefix", F.concat("prefix", "cell"))
    return found.select(*_kept(rows), "shard"), left.select(*_kept(rows), "prefix")


def _kept(rows: DataFrame) -> list[str]:
    return [name for name in rows.columns if name not in ("prefix", "cell", "depth", "shard")]


def _described(shards: DataFrame, shard_bytes: int, id_col: str) -> DataFrame:
    shards = stage(shards)
    joined = shards.join(directory(shards), "shard")
    return joined.select(
        id_col,
        "bytes",
        "shard",
        F.length("shard").alias("depth"),
        "shard_bytes",
        "shard_rows",
        (F.col("shard_bytes") > shard_bytes).alias("oversized"),
    )


def directory(shards: DataFrame) -> DataFrame:
    """shard, shard_bytes, shard_rows: one row for each bucket the directory points to."""
    return shards.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))


def write_shards(docs: DataFrame, shards: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write each row of `docs` into the folder of its shard; ids are taken to be unique here."""
    placed = docs.join(shards.select(id_col, "shard"), id_col)
    placed.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)
