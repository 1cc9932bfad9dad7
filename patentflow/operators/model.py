"""Random forest over the 18 encoded features."""

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentflow.operators.dictionary import encode_features
from patentflow.operators.labeling import ENERGY
from patentflow.operators.patents import feature_table
from patentflow.schemas import TRAIN_COLS


@dataclass
class Classifier:
    """A fitted pipeline and the dictionaries its features were encoded with."""

    model: PipelineModel
    dictionaries: DataFrame

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/forest")
        self.dictionaries.write.mode("overwrite").parquet(f"{path}/dictionaries")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Classifier":
        model = PipelineModel.load(f"{path}/forest")
        return cls(model, spark.read.parquet(f"{path}/dictionaries"))

    def predict(self, patents: DataFrame, *keep: str) -> DataFrame:
        """The kept columns and the predicted class of rows with the six code lists."""
        encoded = encode_features(feature_table(patents, *keep), self.dictionaries)
        return self.model.transform(encoded).select(*keep, "prediction")

    def energy_patents(self, patents: DataFrame) -> DataFrame:
        """Title, abstract and year of the patents predicted to be about energy."""
        predicted = self.predict(patents, "title", "abstract", "year")
        return predicted.where(F.col("prediction") == ENERGY).drop("prediction")


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=TRAIN_COLS, outputCol="features")


def fit_forest(
    encoded: DataFrame, trees: int = 100, depth: int = 30, bins: int | None = None, seed: int = 0
) -> PipelineModel:
    """100 fully grown trees over four features per split, the ids taken as ordered numbers.

    Depth 30 is the most the library allows. A split may fall between any two ids: unless `bins` is
    given, there is a bin for each id of the larger dictionary and one for unseen codes.
    """
    if bins is None:
        largest = encoded.agg(F.greatest(*[F.max(name) for name in TRAIN_COLS])).first()[0]
        bins = max(2, (largest or 0) + 2)
    forest = RandomForestClassifier(
        labelCol="target",
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        featureSubsetStrategy="sqrt",
        seed=seed,
    )
    return Pipeline(stages=[assembler(), forest]).fit(encoded)


def accuracy(predicted: DataFrame) -> DataFrame:
    """Share of rows whose prediction is the target, with the number of rows."""
    hit = (F.col("prediction") == F.col("target")).cast("int")
    return predicted.agg(F.count("*").alias("n_rows"), F.avg(hit).alias("accuracy"))
