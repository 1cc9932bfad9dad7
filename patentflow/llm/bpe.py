"""Byte-level BPE: encoding by a transducer of bounded lookahead, decoding byte by byte."""

import codecs
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: how byte-level tokenizers cut a text before merging. Words come first, as nothing else that
# starts like one can match there.
PIECES = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
GROUP = 4096
CACHED_CHUNKS, CACHED_CHARS = 1 << 18, 64
BATCH_TOKENS = 1 << 20

# No piece goes on from a character other than white space into white space, or from a letter into ASCII punctuation.
# A chunk is a run of Latin letters if white space, ASCII punctuation or the end follows, else all up to white space.
CHUNKS = re.compile(r"\s*+[A-Za-zÀ-ÖØ-öø-ɏ]++(?=[ \t\n\r!-/:-@\[-`{-~]|\Z)|\s*\S+|\s+")
BORDER, STRETCH_CHARS = re.compile(r"(?<=\S)[ \t\n\r]"), 1 << 16
# Separators that are white space for Python, but not for tokenizers.
ODD = re.compile("[\x1c-\x1f]")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable bytes are themselves, the others
    follow from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    """Bytes of each id, ids of single bytes, merges as (left, right, merged) ids by rank, special
    strings."""

    token_bytes: list[bytes]
    byte_ids: list[int]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        """Read the `tokenizer.json` of a byte-level BPE, on the driver; tasks get the result."""
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = byte_letters()
        ids = content["model"]["vocab"]
        special = {token["content"]: token["id"] for token in content["added_tokens"]}
        token_bytes = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for token, number in ids.items():
            token_bytes[number] = bytes(letters[letter] for letter in token)
        for token, number in special.items():
            token_bytes[number] = token.encode()
        byte_ids = [0] * 256
        for letter, byte in letters.items():
            byte_ids[byte] = ids[letter]
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in content["model"]["merges"]]
        return cls(token_bytes, byte_ids, [(ids[a], ids[b], ids[a + b]) for a, b in pairs], special)


def chunks(text: str) -> Iterator[list[str]]:
    """A text in chunks that no piece crosses, those of a bounded stretch at a time. The same chunks recur more often
    than texts do, and cutting into them is cheaper than into pieces."""
    if ODD.search(text):
        yield [text]
        return
    at = 0
    while at < len(text):
        border = BORDER.search(text, at + STRETCH_CHARS)
        end = border.start() if border else len(text)
        yield CHUNKS.findall(text, at, end)
        at = end


def sufficient_lookahead(vocabulary: Vocabulary) -> int | None:
    """Bytes behind a token boundary that can still move it, from the merge list alone.

    Let reach(t) be how many bytes behind token t may decide whether t forms, and taken(t) how many may decide
    whether something behind t has taken it away. A merge of a and b depends on whether b forms and is still
    there, on reach(b) and taken(b) bytes behind b, and on the same for a, whose end is the length of b
    earlier. Whether a is taken away then depends on all these, from its own end. Where every token is formed by one
    merge, after its parts, merges happen in order of rank, and one pass over them in this order finds all. A boundary
    behind t is final once all merges of t with something behind it are decided, whatever their rank.

    None for lists where a token is formed twice or before its parts are: nothing is final there before the end.
    """
    length = [len(token) for token in vocabulary.token_bytes]
    reach, taken = [0] * len(length), [0] * len(length)
    formed = set(vocabulary.byte_ids)
    for a, b, merged in vocabulary.merges:
        if merged in formed or a not in formed or b not in formed:
            return None
        formed.add(merged)
        before = max(reach[b], taken[b], max(reach[a], taken[a]) - length[b], 0)
        reach[merged] = before
        taken[a] = max(taken[a], length[b] + before)
    return max(max(reach), max(taken))


class Encoder:
    """Text to ids, in memory that does not grow with the text.

    Pieces are read from the text one by one and go through a buffer: what lies further than the lookahead before its
    end is final and leaves it, so the buffer holds `chunk` bytes and the lookahead. The end of a piece makes the rest
    final. What came out for short chunks of text is remembered, up to a bound.
    """

    def __init__(self, vocabulary: Vocabulary, chunk: int = 1024):
        self.chunk = chunk
        self.byte_ids = vocabulary.byte_ids
        self.length = [len(token) for token in vocabulary.token_bytes]
        self.ranks = {(a, b): rank for rank, (a, b, _) in enumerate(vocabulary.merges)}
        self.results = [merged for _, _, merged in vocabulary.merges]
        self.lookahead = sufficient_lookahead(vocabulary)
        self.special = vocabulary.special
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pieces = regex.compile(PIECES)
        self.cache = Remembered(self.chunk_ids)

    def merged(self, data: bytes) -> list[int]:
        """Merge by rank, leftmost first, until nothing merges."""
        ids = [self.byte_ids[byte] for byte in data]
        if len(ids) > 32:
            return self._merged_by_heap(ids)
        rank_of, results, none = self.ranks.get, self.results, len(self.results)
        # ranks[i] is the rank of the pair at i; a merge changes those of its neighbours only.
        ranks = [rank_of(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            ids[at : at + 2] = [results[best]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), none)
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), none)
        return ids

    def _merged_by_heap(self, ids: list[int]) -> list[int]:
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        ranks = self.ranks
        heap = [(ranks[pair], i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.results[ranks[a, b]], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (pair := (ids[i], ids[k])) in ranks:
                    heapq.heappush(heap, (ranks[pair], i, *pair))
            if (h := before[i]) >= 0 and (pair := (ids[h], ids[i])) in ranks:
                heapq.heappush(heap, (ranks[pair], h, *pair))
        return [number for number in ids if number >= 0]

    def stream(self, data: bytes) -> Iterator[list[int]]:
        """Ids of one piece as they become final."""
        start = 0
        size = len(data) if self.lookahead is None else self.chunk + self.lookahead
        while len(data) - start > size:
            end = start + size
            final = []
            for number in self.merged(data[start:end]):
                if start + self.length[number] > end - self.lookahead:
                    break
                start += self.length[number]
                final.append(number)
            if not final:
                size *= 2
            else:
                size = self.chunk + self.lookahead
                yield final
        yield self.merged(data[start:])

    def chunk_ids(self, text: str) -> bytes:
        """Ids of the pieces of a chunk, as 32-bit numbers."""
        found = array("i")
        for piece in self.pieces.finditer(text):
            for final in self.stream(piece.group().encode("utf-8", "surrogatepass")):
                found.extend(final)
        return found.tobytes()

    def encode(self, text: str | None) -> Iterator[bytes]:
        """Groups of ids of a text, as 32-bit numbers; strings of special tokens become their ids."""
        text, at = text or "", 0
        if self.split is not None:
            for match in self.split.finditer(text):
                yield from self._plain(text, at, match.start())
                yield array("i", [self.special[match.group()]]).tobytes()
                at = match.end()
        yield from self._plain(text, at, len(text))

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(self.encode(text)), dtype=np.int32)

    def _plain(self, text: str, start: int, end: int) -> Iterator[bytes]:
        # Special strings bound what a piece may look ahead to, so the part is cut out before it is searched.
        part = text if (start, end) == (0, len(text)) else text[start:end]
        for group in chunks(part):
            yield b"".join(map(self.cache.__getitem__, group))


class Remembered(dict):
    """Ids of short chunks that were met lately. When there are too many, those not met again since the last time
    that happened are forgotten."""

    def __init__(self, encode: Callable[[str], bytes], most: int | None = None):
        self.encode, self.most = encode, most or CACHED_CHUNKS
        self.older: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.pop(text, None)
        if ids is None:
            ids = self.encode(text)
        if len(text) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


def decode(token_bytes: list[bytes], ids: list[int]) -> str:
    """Text of ids: bytes enter a UTF-8 decoder group by group, which holds at most an unfinished
    character."""
    decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
    parts = []
    for at in range(0, len(ids), GROUP):
        parts.append(decoder.decode(b"".join([token_bytes[i] for i in ids[at : at + GROUP]])))
    parts.append(decoder.decode(b"", True))
    return "".join(parts)


def encode_documents(
    docs: DataFrame, vocabulary: Vocabulary, keep: list[str], text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """The `keep` columns and `ids`, an array of token numbers, of every row; with `decoded`, their text too.

    Whole texts are encoded; NULL and empty texts have no ids. Repeated rows stay repeated, no other
    column matters, an empty table gives no rows. Decoding in the same pass reads nothing but the ids.
    """
    shipped = SparkSession.active().sparkContext.broadcast(vars(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, token_bytes = Encoder(Vocabulary(**shipped.value)), shipped.value["token_bytes"]

        def columns(found: list[np.ndarray]) -> dict[str, pa.Array]:
            both = {"ids": _id_lists(found)}
            if decoded:
                both["decoded"] = pa.array([decode(token_bytes, ids.tolist()) for ids in found], pa.string())
            return both

        yield from _mapped(batches, "text", encoder.ids, columns)

    rows = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"))
    results = ["ids", "decoded"] if decoded else ["ids"]
    schema = _schema(rows, "ids array<int>, decoded string" if decoded else "ids array<int>")
    return rows.mapInArrow(run, schema).select("row.*", *results)


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """The `keep` columns and `decoded`, the text of the ids, of every row; NULL ids are an empty text."""
    shipped = SparkSession.active().sparkContext.broadcast(vars(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_bytes = shipped.value["token_bytes"]

        def text_of(ids: list[int] | None) -> str:
            return decode(token_bytes, ids or [])

        yield from _mapped(batches, "ids", text_of, lambda texts: {"decoded": pa.array(texts, pa.string())})

    rows = encoded.select(F.struct(*keep).alias("row"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, _schema(rows, "decoded string")).select("row.*", "decoded")


def _schema(rows: DataFrame, result: str) -> str:
    return f"row {rows.schema['row'].dataType.simpleString()}, {result}"


def _id_lists(found: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(ids) for ids in found]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))


def _mapped(batches, name: str, function: Callable, columns: Callable) -> Iterator[pa.RecordBatch]:
    """Batches with new columns made of what `function` finds, none with many more elements than a bound."""
    for batch in batches:
        values, found, held, start = batch.column(name), [], 0, 0
        for at in range(batch.num_rows):
            found.append(function(values[at].as_py()))
            held += len(found[-1])
            if held >= BATCH_TOKENS or at == batch.num_rows - 1:
                rows = batch.column("row").slice(start, len(found))
                made = columns(found)
                yield pa.RecordBatch.from_arrays([rows, *made.values()], names=["row", *made])
                found, held, start = [], 0, at + 1
