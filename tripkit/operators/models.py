"""Service-type classifiers on Spark ML: hashed design vectors, linear and tree models, scoring.

Several classes are handled one against the rest: one binary Spark ML model per class. Their
probabilities are combined with column expressions, so scoring stays inside the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import FeatureHasher, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tripkit.operators.features import CATEGORICAL, CLASSES, HASH_SLOTS, NUMERIC
from tripkit.session import shared_dir

# Fixed value: the name under which results list all categories together.
HASHED_LABEL = "Borough categories (hashed total)"


def _hasher(slots: int) -> FeatureHasher:
    return FeatureHasher(inputCols=CATEGORICAL, categoricalCols=CATEGORICAL, outputCol="_hashed", numFeatures=slots)


def design(slots: int = HASH_SLOTS, kept: list[int] | None = None) -> Pipeline:
    """Scaled numeric columns followed by ``slots`` hashed category slots, or the ``kept`` ones of them, as ``features``."""
    last = [] if kept is None else [VectorSlicer(inputCol="_hashed", outputCol="_kept", indices=kept)]
    hashed = "_hashed" if kept is None else "_kept"
    return Pipeline(stages=[_hasher(slots), *last, VectorAssembler(inputCols=[*NUMERIC, hashed], outputCol="features")])


def filled_slots(df: DataFrame, slots: int = HASH_SLOTS) -> list[int]:
    """The hash slots that a category of any row falls into; the first one if there is none. A number per slot reaches the driver."""
    counts = _hasher(slots).transform(df).select(Summarizer.numNonZeros(F.col("_hashed")))
    return np.flatnonzero(counts.first()[0].toArray()).tolist() or [0]


def linear_model(epochs: int = 100, l1_ratio: float = 0.15, strength: float = 1e-4) -> LogisticRegression:
    """Logistic regression with an elastic-net penalty."""
    return LogisticRegression(maxIter=epochs, elasticNetParam=l1_ratio, regParam=strength, standardization=False)


def tree_model(rounds: int = 50, depth: int = 6, step: float = 0.1, subsample: float = 0.8, seed: int = 42) -> GBTClassifier:
    """Boosted trees."""
    return GBTClassifier(
        maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=subsample, featureSubsetStrategy="0.8", seed=seed
    )


@dataclass
class ServiceModel:
    """A design transformation, one binary model per class and the hash slots the models have columns for."""

    design: PipelineModel
    models: dict[str, Model]
    kept: list[int]

    @property
    def classes(self) -> list[str]:
        return list(self.models)

    @property
    def trees(self) -> bool:
        return isinstance(next(iter(self.models.values())), GBTClassificationModel)


def fit(
    train: DataFrame, estimator: Estimator, slots: int = HASH_SLOTS, classes: list[str] = CLASSES, label: str = "service"
) -> ServiceModel:
    """Train on a scaled feature frame. The vectors are kept between passes, spilling to disk.

    A slot that no training row fills tells nothing: its weight would be 0 and no tree would split by it. So the models only have
    columns for the filled slots, and an empty one costs nothing however many there are.
    """
    known = train.where(F.col(label).isin(*classes))
    kept = filled_slots(known, slots)
    shaped = design(slots, kept).fit(train)
    vectors = shaped.transform(known).select(label, "features").persist(StorageLevel.MEMORY_AND_DISK)
    models = {}
    for name in classes:
        binary = vectors.withColumn("_is", (F.col(label) == name).cast("double"))
        models[name] = estimator.copy({estimator.labelCol: "_is"}).fit(binary)
    vectors.unpersist()
    return ServiceModel(shaped, models, kept)


def score(model: ServiceModel, valid: DataFrame, label: str = "service") -> DataFrame:
    """Validation rows of known classes: predicted class and one probability per class."""
    df = model.design.transform(valid.where(F.col(label).isin(*model.classes)))
    for i, one in enumerate(model.models.values()):
        named = one.copy({one.probabilityCol: f"_p{i}", one.rawPredictionCol: f"_r{i}", one.predictionCol: f"_h{i}"})
        df = named.transform(df)
    each = [F.get(vector_to_array(f"_p{i}"), F.lit(1)) for i in range(len(model.models))]
    return class_shares(df, each, model.classes, [label])


def class_shares(df: DataFrame, each: list[Column], classes: list[str], keep: list[str]) -> DataFrame:
    """``keep``, a probability per class (``each`` scaled to sum 1; all zero: even shares) and the ``prediction``."""
    total = F.nullif(sum(each[1:], each[0]), F.lit(0.0))
    even = F.lit(1.0 / len(each))
    shares = df.select(*keep, *[F.coalesce(p / total, even).alias(f"p_{c}") for p, c in zip(each, classes)])
    # Highest probability; equal ones go to the class listed first.
    ranked = F.array_max(
        F.array(*[F.struct(F.col(f"p_{c}").alias("p"), F.lit(-i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(classes)])
    )
    return shares.withColumn("prediction", ranked["c"])


def split_gains(model: ServiceModel) -> DataFrame:
    """A row per split of a tree model: ``class``, ``tree``, ``node``, ``feature``, rows below (``rows``) and total ``gain``, from the saved node tables.

    The gain of a split is the fall of impurity it gives, times the rows it splits.
    """
    spark = SparkSession.getActiveSession()
    # At most as many rows as hash slots: the place of each column among all slots.
    wide = [*range(len(NUMERIC)), *[len(NUMERIC) + slot for slot in model.kept]]
    places = spark.createDataFrame(list(enumerate(wide)), "column int, feature int")
    frames = []
    for name, one in model.models.items():
        path = shared_dir(spark, "trees")
        one.save(path)
        node = F.col("nodeData")
        frames.append(
            spark.read.parquet(f"{path}/data").where(node["leftChild"] >= 0).select(
                F.lit(name).alias("class"), F.col("treeID").cast("int").alias("tree"), node["id"].cast("int").alias("node"),
                node["split"]["featureIndex"].cast("int").alias("column"), node["rawCount"].cast("bigint").alias("rows"),
                (node["gain"] * node["rawCount"]).alias("gain"),
            )
        )
    splits = reduce(lambda a, b: a.unionByName(b), frames)
    return splits.join(F.broadcast(places), "column").select("class", "tree", "node", "feature", "rows", "gain")


def feature_importance(model: ServiceModel) -> list[tuple[str, float]]:
    """Importance per numeric feature and of all hashed slots together, largest first.

    Linear models: length of the coefficient vector over the classes. Trees: total gain, summed over all splits of all trees.
    """
    parts = list(model.models.values())
    if model.trees:
        table = split_gains(model).groupBy(F.least("feature", F.lit(len(NUMERIC)))).agg(F.sum("gain"))
        weights = np.zeros(len(NUMERIC) + 1)
        for feature, gain in table.collect():  # a row per numeric feature and one of all slots
            weights[feature] = gain
    else:
        weights = sum(m.coefficients.toArray() ** 2 for m in parts) ** 0.5
    named = [(name, float(weights[i])) for i, name in enumerate(NUMERIC)]
    named.append((HASHED_LABEL, float(weights[len(NUMERIC):].sum())))
    return sorted(named, key=lambda item: -item[1])
