"""Fill-in-the-middle: texts cut at two token borders, found by a learned index from ranks to offsets."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest difference between a predicted offset and the true one: differences fit a byte.
ERROR = 127
FIRST_WINDOW = 512
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
CUTS = T.StructType([T.StructField(name, T.LongType()) for name in ("n", "first", "last")])


def borders(text: str) -> np.ndarray:
    """Offsets in code points behind 0, 1, 2, ... tokens: runs of A-Z and a-z, and all other characters one by
    one."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    is_letter = (points | 32) - np.uint32(97) < 26
    ends = np.ones(len(points), dtype=bool)
    ends[:-1] = ~(is_letter[:-1] & is_letter[1:])
    return np.concatenate(([0], np.flatnonzero(ends) + 1))


@dataclass
class RankIndex:
    """Offsets by rank as pieces of straight lines and what these miss.

    Piece i holds for the ranks from first[i] up to first[i + 1] and predicts
    base[i] + round(slope[i] * (rank - first[i])). `missed` are the differences of the true offsets.
    """

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    missed: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> "RankIndex":
        """The longest pieces, from the left, that some line through the first point keeps within the error.

        Each further point narrows the slopes that are left; a piece ends where none is. Points are taken in
        windows that double while a piece lasts, so what is held beside the offsets is bounded by them, and the
        work by a few times their number.
        """
        first, slopes = [], []
        missed = np.zeros(len(offsets), dtype=np.int8 if error <= 127 else np.int64)
        at = 0
        while at < len(offsets):
            low, high, end, window = -np.inf, np.inf, at + 1, FIRST_WINDOW
            while end < len(offsets):
                stop = min(len(offsets), end + window)
                run = np.arange(end - at, stop - at)
                rise = offsets[end:stop] - offsets[at]
                # Half an offset is left for rounding.
                lows = np.maximum.accumulate(np.maximum((rise - error + 0.5) / run, low))
                highs = np.minimum.accumulate(np.minimum((rise + error - 0.5) / run, high))
                bad = np.flatnonzero(lows > highs)
                took = int(bad[0]) if len(bad) else len(run)
                if took:
                    low, high = lows[took - 1], highs[took - 1]
                end += took
                if len(bad):
                    break
                window *= 2
            slope = 0.0 if end == at + 1 else (low + high) / 2
            first.append(at)
            slopes.append(slope)
            guess = offsets[at] + np.rint(slope * np.arange(end - at)).astype(np.int64)
            missed[at:end] = offsets[at:end] - guess
            at = end
        starts = np.array(first, dtype=np.int64)
        return cls(starts, offsets[starts], np.array(slopes), missed)

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        piece = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[piece] + np.rint(self.slope[piece] * (ranks - self.first[piece])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets: the predicted ones and what was missed there."""
        return self.predict(ranks) + self.missed[ranks]


def cut_offsets(text: str, draws: tuple[int, int]) -> tuple[int, int, int]:
    """Number of tokens, and the offsets behind the smaller and the larger of the draws modulo n + 1 tokens."""
    ends = borders(text)
    n = len(ends) - 1
    ranks = np.sort(np.array([draw % (n + 1) for draw in draws]))
    first, last = RankIndex.fit(ends).offsets(ranks).tolist()
    return n, first, last


def cuts(text: Column, first: Column, second: Column) -> Column:
    """The result of `cut_offsets` as a struct."""

    @F.pandas_udf(CUTS)
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, firsts, seconds in batches:
            draws = zip(firsts.tolist(), seconds.tolist())
            yield pd.DataFrame([cut_offsets(*row) for row in zip(texts, draws)], columns=CUTS.names)

    return cut(text, first, second)


def draw(id_col: str, nth: int, seed: int = 1) -> Column:
    """The nth of the 32-bit numbers that a seed and a document's id give; NULL counts as no digits."""
    ident = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(ident.cast("binary"), 256), 8 * nth - 7, 8), 16, 10).cast("bigint")


def fill_in_middle(
    docs: DataFrame,
    keep: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    plain_percent: int = 10,
    spm_percent: int = 20,
) -> DataFrame:
    """The `keep` columns, n, form, output, prefix, middle and suffix of every row.

    Whole texts are cut into n tokens. The draws of the document's id say where the prefix and the middle end,
    and whether the text stays plain (`plain_percent` of a hundred), or else has its suffix first
    (`spm_percent`). NULL and empty texts, and those that hold one of the marks, stay plain. Plain rows have
    NULL parts and their text as output. Rows of one id and text come out alike; NULL ids draw as
    one. No other column matters, an empty table gives no rows. Rows are taken one by one, without a shuffle;
    a very long text takes some ten times its size while it is cut.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*keep).alias("row"),
        text.alias("text"),
        *[draw(id_col, nth).alias(f"draw{nth}") for nth in (1, 2, 3, 4)],
    )
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(mark))
    is_plain = (F.col("text") == "") | marked | (F.col("draw3") % 100 >= 100 - plain_percent)
    form = F.when(is_plain, PLAIN).when(F.col("draw4") % 100 < spm_percent, SPM).otherwise(PSM)
    cut = rows.select("row", "text", form.alias("form"), cuts(F.col("text"), F.col("draw1"), F.col("draw2")).alias("cut"))
    is_cut = F.col("form") != PLAIN
    first, last = F.col("cut.first").cast("int"), F.col("cut.last").cast("int")
    parts = cut.select(
        "row",
        "text",
        "form",
        "cut.n",
        F.when(is_cut, F.substring("text", F.lit(1), first)).alias("prefix"),
        F.when(is_cut, F.substring("text", first + 1, last - first)).alias("middle"),
        F.when(is_cut, F.substring("text", last + 1, F.length("text") - last)).alias("suffix"),
    )
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    output = F.when(F.col("form") == PSM, psm).when(F.col("form") == SPM, spm).otherwise(F.col("text"))
    return parts.select("row.*", "n", "form", output.alias("output"), "prefix", "middle", "suffix")


def restore(output: Column, form: Column) -> Column:
    """The text of an output of a known form. Marks stand in no cut text, so the first of each ends a part."""
    start = F.length(F.lit(PREFIX)) + 1
    second = F.when(form == PSM, F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    at_second, at_middle = F.position(second, output), F.position(F.lit(MIDDLE), output)
    one = F.substring(output, start, at_second - start)
    two = F.substring(output, at_second + 3, at_middle - at_second - 3)
    middle = F.substring(output, at_middle + 3, F.length(output))
    return F.when(form == PSM, F.concat(one, middle, two)).when(form == SPM, F.concat(two, middle, one)).otherwise(output)
