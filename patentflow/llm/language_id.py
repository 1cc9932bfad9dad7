"""Language of texts by error-correcting output codes."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patentflow.llm.linear import fit_converged
from patentflow.llm.ngrams import hashed
from patentflow.llm.samples import sampled
from patentflow.storage import stage

SIZES, BITS = (1, 2, 3), 12
SAMPLE_PER_LANGUAGE, SAMPLE_ROWS = 600, 12_000
# A fit ends when no entry of its gradient is larger.
L2, TOLERANCE = 1e-5, 1e-6
UNDETERMINED, MARGIN = "und", 0.2
EXHAUSTIVE = 5


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """A code word of -1 and 1 for each of n languages; row by row as different as can be found.

    Up to five languages get every way to part them in two. More get about ten bits for each doubling of
    their number, the best of 200 seeded draws by the least distance between two words.
    """
    if n <= EXHAUSTIVE:
        splits = np.arange(1, 1 << max(0, n - 1))
        return np.where(splits[None, :] >> np.arange(n)[:, None] & 1, 1, -1)
    draws, best, apart = np.random.default_rng(seed), None, -1
    width = int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        words = draws.choice([-1, 1], (n, width))
        words = words[:, np.abs(words.sum(axis=0)) < n]
        distance = (words.shape[1] - words @ words.T) / 2
        least = distance[~np.eye(n, dtype=bool)].min()
        if least > apart:
            best, apart = words, least
    return best


def frequencies(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers that occur in a whole text, and the square roots of their shares."""
    counts = np.bincount(hashed(text, SIZES, BITS), minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, np.sqrt(counts[at] / max(1, counts.sum()))


@dataclass
class LanguageModel:
    """Code words, one linear classifier a bit, and how far to trust each bit for each language."""

    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray
    trust: np.ndarray

    def decode(self, margins: np.ndarray) -> tuple[int, float, bool]:
        """Nearest language, its share of the probability, and whether the next is close.

        The distance to a code word is the logistic loss of each bit against it, weighed by the trust in
        the bit.
        """
        loss = np.logaddexp(0, -self.words * margins) * self.trust
        near = np.exp(-self.words.shape[1] * (loss.sum(axis=1) - loss.sum(axis=1).min()))
        order = np.argsort(-near, kind="stable")
        share = near / near.sum()
        close = len(order) > 1 and share[order[0]] - share[order[1]] < MARGIN
        return int(order[0]), float(share[order[0]]), bool(close)

    def predict(self, text: Column) -> Column:
        """Struct (lang_pred, score, ambiguous) of a whole text."""
        shipped = SparkSession.active().sparkContext.broadcast(vars(self))

        @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
        def language(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            model = LanguageModel(**shipped.value)
            for batch in texts:
                found = []
                for text in batch:
                    at, value = frequencies(text)
                    best, score, close = model.decode(model.intercepts + value @ model.weights[at])
                    found.append((model.languages[best], score, close))
                yield pd.DataFrame(found, columns=["lang_pred", "score", "ambiguous"])

        return language(text)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    sample_rows: int = SAMPLE_ROWS,
) -> LanguageModel:
    """Fit on at most `per_language` rows of each language, those with the smallest md5 of their ids, and on about
    `sample_rows` of all languages together, the same number of each.

    Each bit's classifier is fitted by a task of its own on the n-gram shares of the sample, at most 4096 a row. Rows
    with a NULL language or text are not used. Repeated rows count repeatedly; rows of one id and language are
    taken together. Whole texts count, also very long ones.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    n_languages = known.select(lang_col).distinct().count()
    rows_each = max(1, min(per_language, sample_rows // max(1, n_languages)))
    chosen = sampled(known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")), "id", "lang", rows_each)
    # At most `sample_rows` short rows, or one a language.
    chosen = F.broadcast(chosen.distinct())
    texts = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = texts.join(chosen, ["id", "lang"])
    features = stage(rows.mapInPandas(_features, "lang string, buckets array<int>, parts array<double>"))
    languages = [row[0] for row in features.select("lang").distinct().orderBy("lang").collect()]
    words = codewords(len(languages))
    width = words.shape[1] if len(languages) else 0
    weights, intercepts = np.zeros((1 << BITS, width)), np.zeros(width)
    trust = np.ones((len(languages), width))
    if width:
        bits = features.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
        schema = "bit int, intercept double, weights array<double>, hits array<double>"
        for row in bits.groupBy("bit").applyInPandas(_trainer(languages, words), schema).collect():
            weights[:, row["bit"]], intercepts[row["bit"]] = row["weights"], row["intercept"]
            trust[:, row["bit"]] = row["hits"]
    trust /= np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)
    return LanguageModel(languages, words, weights, intercepts, trust)


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [frequencies(text) for text in batch["text"]]
        buckets = [at.astype(np.int32) for at, _ in found]
        yield pd.DataFrame({"lang": batch["lang"], "buckets": buckets, "parts": [part for _, part in found]})


def _trainer(languages: list[str], words: np.ndarray):
    place = {lang: i for i, lang in enumerate(languages)}

    def train(sample: pd.DataFrame) -> pd.DataFrame:
        """The classifier of one bit, and its share of right answers for each language."""
        bit = int(sample["bit"].iloc[0])
        sample = sample[sample["buckets"].map(len) > 0]
        lang = sample["lang"].map(place).to_numpy()
        y = (words[lang, bit] > 0).astype(float)
        lengths = sample["buckets"].map(len).to_numpy()
        at, values = np.concatenate(sample["buckets"].to_list()), np.concatenate(sample["parts"].to_list())
        rows_of = np.maximum(np.bincount(lang, minlength=len(languages)), 1)
        share = 1 / rows_of[lang]
        share /= share.sum()
        plain = np.ones(1 << BITS)
        weight, intercept, _ = fit_converged([(at, values, lengths)], y, share, plain, 0.0, L2, TOLERANCE)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(int)
        right = (intercept + np.add.reduceat(weight[at] * values, starts) > 0) == (y > 0)
        hits = np.bincount(lang, weights=right, minlength=len(languages)) / rows_of
        return pd.DataFrame({"bit": [bit], "intercept": [intercept], "weights": [weight], "hits": [hits]})

    return train


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, ambiguous of every row.

    NULL texts and texts without any letter are "und" with score 0, and so is every text if the model
    knows no language. Nothing but the text is looked at. Equal texts get equal answers; an empty table
    gives no rows.
    """
    text = F.col(text_col)
    has_letter = F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))
    rows = docs.select(F.col(id_col), text.alias("text"), has_letter.alias("has_letter"))
    if not model.languages:
        found = rows.withColumn("found", F.lit(None).cast("struct<lang_pred:string,score:double,ambiguous:boolean>"))
    else:
        found = rows.withColumn("found", model.predict(F.col("text")))
    known = F.col("has_letter") & F.col("found").isNotNull()
    return found.select(
        id_col,
        F.when(known, F.col("found.lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(known, F.col("found.score")).otherwise(0.0).alias("score"),
        F.when(known, F.col("found.ambiguous")).otherwise(True).alias("ambiguous"),
    )
