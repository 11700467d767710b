"""Boosted trees that go on batch by batch: each batch adds trees to the ensemble that the earlier ones left.

A batch is scored by the ensemble so far. At these margins the logistic loss of each class, one against the rest, is expanded to
second order, and Spark's boosted regression trees are fitted to the expansion: the target is gradient over curvature, the
weight the curvature, so leaves are Newton steps. Training and scoring stay inside the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tripkit.operators.features import CLASSES, NUMERIC
from tripkit.operators.models import HASHED_LABEL, class_shares, design
from tripkit.session import saved, shared_dir

ROUNDS, DEPTH, STEP, SUBSAMPLE = 2, 6, 0.3, 0.8
RATE = 0.5  # share of a batch's Newton step that is taken
SLOTS = 2**6  # hash slots of categories: each costs a histogram per tree node
_FLAT = 1e-3  # least curvature, so that rows far on the right side don't ask for endless steps


@dataclass
class Ensemble:
    """The trees of each batch, a model per class; later batches correct earlier ones."""

    classes: list[str] = field(default_factory=lambda: list(CLASSES))
    slots: int = SLOTS
    rate: float = RATE
    rows: int = 0
    batches: list[list[GBTRegressionModel]] = field(default_factory=list)
    design: PipelineModel = None


def _margins(model: Ensemble, shaped: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``shaped`` with a column per batch and class, and the margin of each class: their sum at the ensemble's rate."""
    columns = [[] for _ in model.classes]
    for b, parts in enumerate(model.batches):
        for j, one in enumerate(parts):
            name = f"_m{b}_{j}"
            shaped = one.copy({one.predictionCol: name}).transform(shaped)
            columns[j].append(F.col(name))
    return shaped, [sum((c * model.rate for c in own), F.lit(0.0)) for own in columns]


def _probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def train_batch(
    model: Ensemble, batch: DataFrame, *, label: str = "service", rounds: int = ROUNDS, depth: int = DEPTH, step: float = STEP,
    subsample: float = SUBSAMPLE, seed: int = 42,
) -> Ensemble:
    """The ensemble with ``rounds`` more trees per class, fitted to one more batch of scaled feature rows.

    A batch without known classes changes nothing; the given ensemble stays as it is. The vectors of the batch are kept between
    passes, spilling to disk. Only trees reach the driver.
    """
    known = batch.where(F.col(label).isin(*model.classes))
    shaper = model.design or design(model.slots).fit(known)
    shaped, margins = _margins(model, shaper.transform(known).select(label, "features"))
    vectors = shaped.select(label, "features", *[m.alias(f"_margin{j}") for j, m in enumerate(margins)]).persist(StorageLevel.MEMORY_AND_DISK)
    count = vectors.count()
    if not count:
        vectors.unpersist()
        return model
    parts = []
    for j, name in enumerate(model.classes):
        p = _probability(F.col(f"_margin{j}"))
        curve = F.greatest(p * (1 - p), F.lit(_FLAT))
        expanded = vectors.select("features", curve.alias("_weight"), (((F.col(label) == name).cast("double") - p) / curve).alias("_target"))
        trees = GBTRegressor(
            labelCol="_target", weightCol="_weight", maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=subsample,
            featureSubsetStrategy="0.8", seed=seed + len(model.batches),
        )
        parts.append(trees.fit(expanded))
    vectors.unpersist()
    return Ensemble(model.classes, model.slots, model.rate, model.rows + count, [*model.batches, parts], shaper)


def train(rows: DataFrame, batch: str, *, epochs: int = 1, model: Ensemble | None = None, classes: list[str] = CLASSES, slots: int = SLOTS, **settings) -> Ensemble:
    """All batches in the order of the ``batch`` column, ``epochs`` times, going on from ``model`` if given. Rows are saved once."""
    fixed = saved(rows.sparkSession, rows, "boosting-rows")
    model = model or Ensemble(list(classes), slots)
    names = sorted(r[0] for r in fixed.select(batch).distinct().collect() if r[0] is not None)  # months, not rows
    for _ in range(epochs):
        for name in names:
            model = train_batch(model, fixed.where(F.col(batch) == name), **settings)
    return model


def score_boosted(model: Ensemble, valid: DataFrame, label: str = "service", keep: list[str] = ()) -> DataFrame:
    """Rows of known classes: ``keep``, the label, one probability per class and the ``prediction``, as `models.score` gives them.

    An ensemble without trees gives every class the same probability.
    """
    known = valid.where(F.col(label).isin(*model.classes))
    if not model.batches:
        return class_shares(known, [F.lit(0.5) for _ in model.classes], model.classes, [*keep, label])
    shaped, margins = _margins(model, model.design.transform(known))
    return class_shares(shaped, [_probability(m) for m in margins], model.classes, [*keep, label])


def boosted_gains(model: Ensemble, spark: SparkSession) -> DataFrame:
    """A row per split: ``batch``, ``class``, ``tree``, ``node``, ``feature``, rows below (``rows``) and total ``gain``.

    The gain of a split is the fall of impurity it gives, times the weight of the rows it splits.
    """
    frames = []
    for b, parts in enumerate(model.batches):
        for name, one in zip(model.classes, parts):
            path = shared_dir(spark, "boosted-trees")
            one.save(path)
            node = F.col("nodeData")
            frames.append(spark.read.parquet(f"{path}/data").where(node["leftChild"] >= 0).select(
                F.lit(b).alias("batch"), F.lit(name).alias("class"), F.col("treeID").cast("int").alias("tree"), node["id"].cast("int").alias("node"),
                node["split"]["featureIndex"].cast("int").alias("feature"), node["rawCount"].cast("bigint").alias("rows"),
                (node["gain"] * node["impurityStats"][0]).alias("gain"),
            ))
    if not frames:
        return spark.createDataFrame([], "batch int, class string, tree int, node int, feature int, rows bigint, gain double")
    return reduce(lambda a, b: a.unionByName(b), frames)


def boosted_importance(gains: DataFrame) -> DataFrame:
    """``feature``, ``splits`` and total ``gain`` of `boosted_gains`, per numeric feature and of all hashed slots together."""
    names = F.array(*[F.lit(n) for n in NUMERIC])
    named = F.coalesce(F.get(names, F.col("feature")), F.lit(HASHED_LABEL))
    return gains.groupBy(named.alias("feature")).agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))
