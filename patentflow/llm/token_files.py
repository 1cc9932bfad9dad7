"""Token ids in binary files: patched frame-of-reference blocks behind an index of their starts.

A file holds the ids of neighbouring documents, in blocks of 1024 ids. A block stores its smallest id, the
differences from it packed at the width that most of them need, and the few larger ones in a list of exceptions.
All numbers are little-endian:

    header      8 bytes magic, u32 ids a block, u32 zero
    blocks      u32 smallest id, u16 ids, u16 exceptions, u8 width, 3 bytes zero
                packed differences: `width` u64 for every 64 ids
                u16 places of the exceptions, u32 their differences
    index       u64 start of each block and end of the last
                i64 document id, u8 whether it is known (not NULL), of each document
                u64 first id of each document in the file, and the number of ids
    trailer     u64 blocks, u64 documents, u64 ids, u64 start of the index, u32 crc32 of the index, u32 zero, magic
"""

import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from tokenizers import Tokenizer

from patentflow.llm.bpe import Remembered, byte_letters, chunks
from patentflow.storage import stage

MAGIC = b"TOKPFOR1"
HEADER, BLOCK, TRAILER = "<8sII", "<IHHB3x", "<QQQQII8s"
HEADER_BYTES, BLOCK_BYTES, TRAILER_BYTES = map(struct.calcsize, (HEADER, BLOCK, TRAILER))
BLOCK_IDS, PERCENTILE = 1024, 95
FLUSH_IDS = 64 * BLOCK_IDS
FILE_IDS, FILE_DOCS = 1 << 24, 1 << 18
TASKS_PER_CORE = 8
CACHED_CHUNKS = 1 << 19

FILES = pa.schema(
    [("part", pa.int32()), ("nth", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
)
DOCUMENTS = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)


# Blocks


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64 numbers below 2 ** width as rows of `width` words of 64 bits."""
    words = np.zeros((len(values), width), dtype="<u8")
    for i in range(64 if width else 0):
        at, shift = divmod(i * width, 64)
        words[:, at] |= values[:, i] << np.uint64(shift)
        if shift + width > 64:
            words[:, at + 1] |= values[:, i] >> np.uint64(64 - shift)
    return words


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of `pack`."""
    values = np.zeros((len(words), 64), dtype="<u8")
    mask = np.uint64((1 << width) - 1)
    for i in range(64 if width else 0):
        at, shift = divmod(i * width, 64)
        values[:, i] = words[:, at] >> np.uint64(shift)
        if shift + width > 64:
            values[:, i] |= words[:, at + 1] << np.uint64(64 - shift)
        values[:, i] &= mask
    return values


def encode_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> list[bytes]:
    """Blocks of ids below 2 ** 32, all full but the last.

    The width of a block is what `percentile` of a hundred of its differences need.
    """
    full = len(ids) // BLOCK_IDS
    parts = [ids[: full * BLOCK_IDS].reshape(full, BLOCK_IDS)] if full else []
    if len(ids) % BLOCK_IDS:
        parts.append(ids[None, full * BLOCK_IDS :])
    blocks: list[bytes] = []
    for part in parts:
        least = part.min(axis=1)
        above = part.astype("<u8") - least[:, None]
        nth = max(0, -(-part.shape[1] * percentile // 100) - 1)
        # Exact for numbers below 2 ** 53: the exponent of a floating point number is the number of its bits.
        widths = np.frexp(np.partition(above, nth, axis=1)[:, nth].astype(np.float64))[1]
        odd = above >> widths[:, None].astype("<u8") > 0
        groups = -(-part.shape[1] // 64)
        inside = np.zeros((len(part), groups * 64), dtype="<u8")
        inside[:, : part.shape[1]] = np.where(odd, 0, above)
        found: list[bytes] = [b""] * len(part)
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            packed = pack(inside[rows].reshape(-1, 64), width).reshape(len(rows), -1)
            for row, words in zip(rows.tolist(), packed):
                at = np.flatnonzero(odd[row])
                head = struct.pack(BLOCK, int(least[row]), part.shape[1], len(at), width)
                tail = at.astype("<u2").tobytes() + above[row, at].astype("<u4").tobytes()
                found[row] = head + words.tobytes() + tail
        blocks += found
    return blocks


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at `starts`, one after another."""
    heads = [struct.unpack_from(BLOCK, data, at) for at in starts.tolist()]
    lengths = np.array([head[1] for head in heads], dtype=np.int64)
    ends = np.cumsum(lengths)
    ids = np.empty(int(ends[-1]) if len(heads) else 0, dtype="<u4")
    shapes: dict[tuple[int, int], list[int]] = {}
    for i, (_, count, _, width) in enumerate(heads):
        shapes.setdefault((count, width), []).append(i)
    for (count, width), members in shapes.items():
        groups = -(-count // 64)
        words = [np.frombuffer(data, "<u8", groups * width, int(starts[i]) + BLOCK_BYTES) for i in members]
        values = unpack(np.concatenate(words).reshape(len(members) * groups, width), width)
        for i, row in zip(members, values.reshape(len(members), -1)):
            least, _, n_odd, _ = heads[i]
            row = row[:count]
            at = int(starts[i]) + BLOCK_BYTES + 8 * groups * width
            row[np.frombuffer(data, "<u2", n_odd, at)] = np.frombuffer(data, "<u4", n_odd, at + 2 * n_odd)
            ids[ends[i] - count : ends[i]] = row + np.uint64(least)
    return ids


# Files


class FileWriter:
    """Writes documents to an open file one after another, holding a bounded number of ids and the index."""

    def __init__(self, sink):
        self.sink = sink
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.starts, self.first = array("Q", [HEADER_BYTES]), array("Q", [0])
        self.docs, self.known = array("q"), bytearray()
        sink.write(struct.pack(HEADER, MAGIC, BLOCK_IDS, 0))

    def add(self, doc_id: int | None, ids: Iterable[np.ndarray]) -> None:
        """A document as parts of its ids, which may come one by one."""
        for part in ids:
            self.held.append(part)
            self.n_held += len(part)
            self.n_ids += len(part)
            if self.n_held >= FLUSH_IDS:
                self._flush(False)
        self.docs.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.first.append(self.n_ids)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, dtype="<u4")
        cut = len(ids) if last else len(ids) // BLOCK_IDS * BLOCK_IDS
        blocks = encode_blocks(ids[:cut])
        for block in blocks:
            self.starts.append(self.starts[-1] + len(block))
        self.sink.write(b"".join(blocks))
        self.held = [ids[cut:].copy()]
        self.n_held = len(ids) - cut

    def close(self) -> None:
        self._flush(True)
        little = [np.array(self.starts, "<u8"), np.array(self.docs, "<i8"), self.known, np.array(self.first, "<u8")]
        index = b"".join(map(bytes, little))
        sizes = len(self.starts) - 1, len(self.docs), self.n_ids, self.starts[-1]
        self.sink.write(index + struct.pack(TRAILER, *sizes, zlib.crc32(index), 0, MAGIC))
        self.sink.close()


class FileReader:
    """Reads an open file of random access: its documents in order, or any range of its ids."""

    def __init__(self, source):
        size = source.size()
        head = source.read_at(HEADER_BYTES, 0)
        last = source.read_at(TRAILER_BYTES, max(0, size - TRAILER_BYTES))
        if len(head) < HEADER_BYTES or len(last) < TRAILER_BYTES or head[:8] != MAGIC or last[-8:] != MAGIC:
            raise ValueError("not a whole file of token ids")
        n_blocks, n_docs, self.n_ids, at, crc, _, _ = struct.unpack(TRAILER, last)
        index = source.read_at(size - TRAILER_BYTES - at, at)
        if zlib.crc32(index) != crc:
            raise ValueError("the index of a file of token ids is damaged")
        self.source, self.block_ids = source, struct.unpack(HEADER, head)[1]
        known_at = 8 * (n_blocks + 1 + n_docs)
        self.starts = np.frombuffer(index, "<u8", n_blocks + 1)
        self.docs = np.frombuffer(index, "<i8", n_docs, 8 * (n_blocks + 1))
        self.known = np.frombuffer(index, "u1", n_docs, known_at)
        self.first = np.frombuffer(index, "<u8", n_docs + 1, known_at + n_docs)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from `start` up to `stop`, from the blocks that hold them alone."""
        if stop <= start:
            return np.empty(0, dtype="<u4")
        first, end = start // self.block_ids, -(-stop // self.block_ids)
        at = int(self.starts[first])
        data = self.source.read_at(int(self.starts[end]) - at, at)
        found = decode_blocks(data, self.starts[first:end] - np.uint64(at))
        return found[start - first * self.block_ids : stop - first * self.block_ids]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document, first id, ids) in the order of the file; short documents are read together."""
        at = 0
        while at < len(self.docs):
            base = int(self.first[at])
            end = max(at + 1, int(np.searchsorted(self.first, base + FLUSH_IDS, "right")) - 1)
            ids = self.ids(base, int(self.first[end]))
            for i in range(at, end):
                start, stop = int(self.first[i]), int(self.first[i + 1])
                yield int(self.docs[i]) if self.known[i] else None, start, ids[start - base : stop - base]
            at = end


# Encoding with the tokenizers library


class ChunkEncoder:
    """Ids of texts by the tokenizers library, which is asked once for chunks that recur.

    A byte-level tokenizer cuts texts into pieces it encodes on their own, and no piece crosses the chunks of
    `patentflow.llm.bpe`, so cutting a text there changes no id. Tokenizers that are not known to cut there get
    whole texts.
    """

    # A chunk that is one piece, which the library's model takes as it is, byte by byte in its own letters.
    PIECE = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")

    def __init__(self, tokenizer_json: str):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.cuts = _cuts_at_spaces(json.loads(tokenizer_json))
        self.model, self.letters = self.tokenizer.model, {byte: letter for letter, byte in byte_letters().items()}
        self.cache = Remembered(self.chunk, CACHED_CHUNKS)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def chunk(self, text: str) -> bytes:
        if not self.PIECE.fullmatch(text):
            return self.whole(text)
        letters = text.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def parts(self, text: str | None) -> Iterator[np.ndarray]:
        """The ids of a text; those of a long one stretch by stretch."""
        if not self.cuts:
            yield np.frombuffer(self.whole(text), dtype="<u4") if text else np.empty(0, dtype="<u4")
            return
        for group in chunks(text or ""):
            yield np.frombuffer(b"".join(map(self.cache.__getitem__, group)), dtype="<u4")


def worker_encoder(shipped: dict) -> ChunkEncoder:
    """The encoder of a broadcast tokenizer, kept beside it for later tasks of the same Python worker."""
    if "encoder" not in shipped:
        shipped["encoder"] = ChunkEncoder(shipped["tokenizer"])
    return shipped["encoder"]


def _cuts_at_spaces(content: dict) -> bool:
    """Whether a tokenizer is plainly byte-level, with no special string that the chunks could cut."""
    cut = content.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
    special = content.get("added_tokens") or []
    flags = any(token.get(flag) for token in special for flag in ("single_word", "lstrip", "rstrip"))
    whole = all(re.fullmatch(r"[!-/:-@\[-`{-~]\S*", token["content"]) for token in special)
    return bool(plain and whole and not flags and not content.get("normalizer"))


# Spark


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme of its file system, as tasks need it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a qualified path, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    uri = "s3" + path[3:] if path.startswith("s3a:") else path
    return fs.FileSystem.from_uri(quote(uri, safe=":/@"))


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_json: str,
    end_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode whole texts and write their ids in ascending order of `id_col`; the stored index of files.

    `tokenizer_json` is the content of a tokenizers file. NULL and empty texts have no ids but `end_id`, which
    follows every document if given. NULL document ids come first; rows of the same id follow each other in the
    order of a hash of their texts, equal rows in any. No other column matters. An empty table gives an index
    without files.

    Rows are dealt to tasks by ranges of the id, the hash and the place of the row, so rows of one id may fill
    several tasks. Tasks sort outside their memory, hold one text and 65,536 ids, and begin a new file after
    `file_ids` ids. Files have names of their own for every attempt of a task, and only those of the attempt
    that Spark commits enter the index, so repeated tasks leave no trace in the result. `folder` must be shared.
    """
    spark = docs.sparkSession
    target = qualified(spark, f"{folder}/data")
    shipped = spark.sparkContext.broadcast({"tokenizer": tokenizer_json})
    ends = [] if end_id is None else [np.array([end_id], dtype="<u4")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, nth, writer = worker_encoder(shipped.value), TaskContext.get().partitionId(), 0, None

        def closed() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_pylist(
                [{"part": part, "nth": nth, "file": path, "n_docs": len(writer.docs), "n_ids": writer.n_ids}], FILES
            )

        for batch in batches:
            texts = batch.column("text")
            for at, doc_id in enumerate(batch.column("doc").to_pylist()):
                if writer is None:
                    path = f"{target}/part-{part:06d}-{nth:04d}-{uuid.uuid4().hex}.ids"
                    store, name = store_of(path)
                    store.create_dir(name.rpartition("/")[0], recursive=True)
                    writer = FileWriter(store.open_output_stream(name))
                writer.add(doc_id, chain(encoder.parts(texts[at].as_py()), ends))
                if writer.n_ids >= file_ids or len(writer.docs) >= FILE_DOCS:
                    yield closed()
                    writer, nth = None, nth + 1
        if writer is not None:
            yield closed()

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), text.alias("text"))
    rows = rows.select("doc", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("place"), "text")
    order = [F.col("doc").asc_nulls_first(), "hash", "place"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc", "text")
    written = stage(ranged.mapInArrow(run, from_arrow_schema(FILES)), f"{folder}/written")
    return stage(_with_starts(written), f"{folder}/index")


def _with_starts(files: DataFrame) -> DataFrame:
    """Files with the number of ids before each: within its part, and in the parts before, which are few."""
    of_parts = files.groupBy("part").agg(F.sum("n_ids").alias("in_part"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = of_parts.select("part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    return files.join(parts, "part").withColumn("start", start).drop("before")


def read_token_files(spark: SparkSession, folder: str, tasks: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files: the ids of all documents before its own,
    how many it has, and these, 4 bytes each, little-endian.

    A task reads whole files, some blocks at a time. `tasks`, eight per core unless given, bounds the number of
    partitions.
    """
    index = spark.read.parquet(f"{folder}/index").select("file", "start")

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(*column) for column in zip(zip(*rows), DOCUMENTS.types)], schema=DOCUMENTS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in chain.from_iterable(batch.to_pylist() for batch in batches):
            store, name = store_of(row["file"])
            with store.open_input_file(name) as source:
                held, size = [], 0
                for doc, first, ids in FileReader(source).documents():
                    held.append((doc, row["start"] + first, len(ids), ids.tobytes()))
                    size += len(ids) + 16
                    if size >= FLUSH_IDS:
                        yield to_batch(held)
                        held, size = [], 0
                if held:
                    yield to_batch(held)

    tasks = tasks or TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return index.repartition(tasks).mapInArrow(run, from_arrow_schema(DOCUMENTS))
