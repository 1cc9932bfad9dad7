"""Toxicity of texts: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patentflow.llm.linear import fit_converged
from patentflow.llm.ngrams import hashed, occurring
from patentflow.llm.samples import sampled
from patentflow.storage import stage

# An n-gram is one feature for each number of times it occurs at least, up to TIMES.
SIZES, BITS, TIMES = (3, 4, 5), 18, 3
FEATURES = TIMES << BITS
CHUNK_ROWS = 200
SAMPLE_PER_CLASS, SAMPLE_CHARS = 4000, 1 << 25
THRESHOLD = 0.7
SMOOTHING, MIN_DOCS, L2 = 1.0, 3, 0.003
# The fit ends when no entry of its gradient is larger.
TOLERANCE = 1e-6


def features_of(text: str | None) -> np.ndarray:
    """Numbers of the features of a whole text."""
    return occurring(hashed(text, SIZES, BITS), BITS, TIMES)


@dataclass
class ToxicityModel:
    """An intercept, and for each feature the learned weight times its log-count ratio."""

    intercept: float
    weights: np.ndarray

    def score(self, text: str | Column) -> Column:
        """Probability of the toxic class, from the whole text; NULL and empty texts get a score too."""
        shipped = SparkSession.active().sparkContext.broadcast((self.intercept, self.weights))

        @F.pandas_udf(T.DoubleType())
        def toxicity(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            intercept, weights = shipped.value
            for batch in texts:
                sums = [weights[features_of(text)].sum() for text in batch]
                yield pd.Series(1 / (1 + np.exp(-np.clip(intercept + np.array(sums, dtype=float), -30, 30))))

        return toxicity(text)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = SAMPLE_PER_CLASS,
    per_class_chars: int = SAMPLE_CHARS,
) -> ToxicityModel:
    """Fit on the documents that have a label of 0 or 1, given by id.

    At most `per_class` documents of each class are used, and of these, in the order of the sample, as many as have
    `per_class_chars` characters together (the first one always), so what one task and the driver hold is bounded:
    three features a character at most, and one weight a feature. The class shares of all labels set the
    intercept. Documents with several labels count once for each class they are in. Without any label
    every text gets a score of 0.5 at most; with one class only, that of its share.
    """
    labelled = labels.where(F.col(label_col).isin(0, 1)).select(id_col, label_col).distinct()
    known = stage(labelled.join(docs.select(id_col), id_col, "left_semi"))
    shares = dict(known.groupBy(label_col).count().collect())
    if not shares.get(1):
        return ToxicityModel(-30.0 if shares else 0.0, np.zeros(FEATURES))
    chosen = sampled(known, id_col, label_col, per_class)
    bounded = F.broadcast(chosen.withColumnRenamed(label_col, "label"))
    rows = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("text")).join(bounded, id_col)
    ident = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    running = Window.partitionBy("label").orderBy(ident, id_col, "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum(F.char_length("text")).over(running))
    is_first = F.col("upto") == F.char_length("text")
    rows = rows.where((F.col("upto") <= per_class_chars) | is_first).select("label", "text")
    features = rows.mapInPandas(_features, "label int, buckets array<int>")
    prior = (shares[1] + 0.5) / (sum(shares.values()) + 1)
    train = _trainer(prior)
    fitted = features.repartition(1).mapInArrow(train, "intercept double, weights binary")
    row = fitted.first()
    if row is None:  # no text has an n-gram
        return ToxicityModel(float(np.log(prior / (1 - prior))), np.zeros(FEATURES))
    return ToxicityModel(row["intercept"], np.frombuffer(row["weights"], dtype=np.float32))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        buckets = [features_of(text).astype(np.int32) for text in batch["text"]]
        rows = pd.DataFrame({"label": batch["label"].astype("int32"), "buckets": buckets})
        yield rows[rows["buckets"].map(len) > 0]


def _trainer(prior: float) -> Callable:
    """Logistic regression on features times log-count ratios, over the sample in one task.

    Classes are weighed so that the sample has the shares of all labels.
    """

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, labels = [], []
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(start, CHUNK_ROWS)
                at = part.column("buckets").flatten().to_numpy().copy()
                chunks.append((at, None, part.column("buckets").value_lengths().to_numpy().copy()))
                labels.append(part.column("label").to_numpy().astype(float))
        y = np.concatenate(labels) if labels else np.zeros(0)
        docs, toxic = np.zeros(FEATURES), np.zeros(FEATURES)
        for (at, _, lengths), label in zip(chunks, labels):
            docs += np.bincount(at, minlength=FEATURES)
            toxic += np.bincount(at, weights=np.repeat(label, lengths), minlength=FEATURES)
        n_toxic, n_clean = y.sum(), (1 - y).sum()
        ratio = np.log((toxic + SMOOTHING) / (n_toxic + 2 * SMOOTHING))
        ratio -= np.log((docs - toxic + SMOOTHING) / (n_clean + 2 * SMOOTHING))
        ratio[docs < MIN_DOCS] = 0
        intercept, weight = np.log(prior / (1 - prior)), np.zeros(FEATURES)
        if n_toxic and n_clean:
            share = np.where(y == 1, prior / n_toxic, (1 - prior) / n_clean)
            weight, intercept, _ = fit_converged(chunks, y, share, ratio, intercept, L2, TOLERANCE)
        weights = (weight * ratio).astype(np.float32).tobytes()
        yield pa.RecordBatch.from_pydict({"intercept": [intercept], "weights": [weights]})

    return train


def score_documents(
    docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, score, predicted of every row. Nothing but the text is looked at, whatever other columns are called. NULL and
    empty texts get the score of no n-gram, equal texts the same one, and repeated rows stay repeated. Whole
    texts count, also very long ones, which take some twenty times their size in a task. An empty table gives
    no rows."""
    scored = docs.select(F.col(id_col), model.score(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows whose text scores below the threshold, with the columns they came with, whatever these are called.
    Repeated rows stay or go together; NULL and empty texts stay unless most labels say toxic. An empty table gives no
    rows."""
    whole = docs.select(F.struct("*").alias("doc"), model.score(F.col(text_col)).alias("score"))
    return whole.where(F.col("score") < threshold).select("doc.*")
