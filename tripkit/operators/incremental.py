"""A linear classifier trained batch by batch with averaged weights, for data that arrives in months.

Each batch starts from the weights the last one left. Its rows are dealt to workers, which run stochastic gradient descent side by
side from the same start; their weights, and the averages over all their steps, are averaged by rows. Going through all
batches is an epoch. Categories are hashed; only weights that moved leave a worker.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.operators.features import CATEGORICAL, CLASSES, HASH_SLOTS, NUMERIC
from tripkit.session import saved

# Settings of the trained classifier.
EPOCHS, STEP, STRENGTH, L1_RATIO = 2, 0.03, 1e-4, 0.15
WORKER_ROWS = 100_000  # rows of a batch that one worker goes through in order
STEP_ROWS = 8  # rows whose gradients make one step
_BIAS = len(NUMERIC)
_MOVED = "place int, class int, last double, mean double, rows long"


def slot(name: str, slots: int) -> Column:
    """Weight number of a category: numeric features and the bias come first."""
    return (F.pmod(F.xxhash64(F.lit(name), F.col(name)), F.lit(slots)) + F.lit(_BIAS + 1)).cast("int")


@dataclass
class LinearModel:
    """``current`` weights, from which training goes on, and their average over all steps, which predicts. Row: feature; column: class."""

    classes: list[str] = field(default_factory=lambda: list(CLASSES))
    slots: int = HASH_SLOTS
    steps: int = 0  # rows the average is over
    batches: int = 0
    current: np.ndarray = None
    average: np.ndarray = None

    def __post_init__(self):
        if self.current is None:
            self.current = np.zeros((_BIAS + 1 + self.slots, len(self.classes)))
            self.average = self.current.copy()


def descend(frame: pd.DataFrame, start: np.ndarray, step: float, strength: float, l1_ratio: float, step_rows: int) -> pd.DataFrame:
    """How the weights of the features that occur move over the rows in order: at the end and on average over steps."""
    x = np.column_stack([frame[NUMERIC].to_numpy(float), np.ones(len(frame))])
    slots, local = np.unique(frame[[f"_{c}" for c in CATEGORICAL]].to_numpy(np.int64), return_inverse=True)
    local = local.reshape(len(frame), len(CATEGORICAL)) + x.shape[1]
    places = np.concatenate([np.arange(x.shape[1]), slots])
    begin = start[places]
    weights, total = begin.copy(), np.zeros_like(begin)
    targets = np.eye(begin.shape[1])[frame["y"].to_numpy()]
    free = np.ones((len(places), 1))
    free[_BIAS] = 0.0  # the bias is not shrunk
    for at in range(0, len(frame), step_rows):
        rows, groups = x[at : at + step_rows], local[at : at + step_rows]
        margin = rows @ weights[: x.shape[1]] + weights[groups].sum(axis=1)
        off = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))) - targets[at : at + step_rows]
        n = len(rows)
        shrunk = weights * (1.0 - step * strength * (1.0 - l1_ratio) * n * free)
        shrunk[: x.shape[1]] -= step * (rows.T @ off)
        for k in range(groups.shape[1]):
            np.subtract.at(shrunk, groups[:, k], step * off)
        cut = step * strength * l1_ratio * n * free
        weights = np.sign(shrunk) * np.maximum(np.abs(shrunk) - cut, 0.0)
        total += n * (weights - begin)
    k = begin.shape[1]
    return pd.DataFrame({
        "place": np.repeat(places, k).astype(np.int32), "class": np.tile(np.arange(k), len(places)).astype(np.int32),
        "last": ((weights - begin) * len(frame)).ravel(), "mean": total.ravel(), "rows": len(frame),
    })


def train_batch(
    model: LinearModel, batch: DataFrame, *, order: list[Column], label: str = "service", step: float = STEP, strength: float = STRENGTH, l1_ratio: float = L1_RATIO,
    step_rows: int = STEP_ROWS,
) -> LinearModel:
    """The model after one more batch of scaled feature rows; a batch without known classes changes nothing.

    ``order`` is the order of descent (say, a seeded hash of the row), so that a repeated run gives the same weights. Rows are dealt by it to as many
    workers as the batch needs. A row per moved weight reaches the driver: at most classes times hash slots.
    """
    rows = batch.withColumns({f"_o{i}": c for i, c in enumerate(order)})
    designed = rows.where(F.col(label).isin(*model.classes))
    count = designed.count()
    if not count:
        return model
    workers, keys = -(-count // WORKER_ROWS), [f"_o{i}" for i in range(len(order))]
    target = F.array_position(F.array(*[F.lit(c) for c in model.classes]), F.col(label)).cast("int") - 1
    ready = designed.select(
        (F.pmod(F.xxhash64(*keys), F.lit(workers))).cast("int").alias("worker"), target.alias("y"), *keys, *NUMERIC,
        *[slot(name, model.slots).alias(f"_{name}") for name in CATEGORICAL],
    )
    start = model.current

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        return descend(frame.sort_values(keys, kind="stable"), start, step, strength, l1_ratio, step_rows)

    moved = ready.groupBy("worker").applyInPandas(work, _MOVED)
    sums = moved.groupBy("place", "class").agg(F.sum("last").alias("last"), F.sum("mean").alias("mean")).toPandas()
    current, mean = start.copy(), start.copy()
    np.add.at(current, (sums["place"], sums["class"]), sums["last"] / count)
    np.add.at(mean, (sums["place"], sums["class"]), sums["mean"] / count)
    average = (model.average * model.steps + mean * count) / (model.steps + count)
    return LinearModel(model.classes, model.slots, model.steps + count, model.batches + 1, current, average)


def train(
    rows: DataFrame, batch: str, *, order: list[Column], epochs: int = EPOCHS, model: LinearModel | None = None, classes: list[str] = CLASSES, slots: int = HASH_SLOTS, **settings
) -> LinearModel:
    """All batches in the order of the ``batch`` column, ``epochs`` times, going on from ``model`` if given. Rows are saved once."""
    fixed = saved(rows.sparkSession, rows.withColumns({f"_s{i}": c for i, c in enumerate(order)}), "training-rows")
    again = [F.col(f"_s{i}") for i in range(len(order))]
    model = model or LinearModel(list(classes), slots)
    names = sorted(r[0] for r in fixed.select(batch).distinct().collect() if r[0] is not None)  # months, not rows
    for _ in range(epochs):
        for name in names:
            model = train_batch(model, fixed.where(F.col(batch) == name), order=again, **settings)
    return model


def score_linear(model: LinearModel, valid: DataFrame, label: str = "service", keep: list[str] = ()) -> DataFrame:
    """Rows of known classes: ``keep``, the label, one probability per class and the ``prediction``, as `models.score` gives them."""
    spark, weights = valid.sparkSession, model.average
    used = [i for i in np.flatnonzero(weights.any(axis=1)).tolist() if i > _BIAS]
    names = [f"_w{j}" for j in range(len(model.classes))]
    table = spark.createDataFrame([(i, *map(float, weights[i])) for i in used], ", ".join(["_slot int", *(f"{n} double" for n in names)]))
    df = valid.where(F.col(label).isin(*model.classes))
    sums = [sum((F.col(c).cast("double") * float(weights[i, j]) for i, c in enumerate(NUMERIC)), F.lit(float(weights[_BIAS, j]))) for j in range(len(names))]
    df = df.select(*keep, label, *[s.alias(f"_m{j}") for j, s in enumerate(sums)], *[slot(c, model.slots).alias(f"_{c}") for c in CATEGORICAL])
    for c in CATEGORICAL:  # at most as many rows as hash slots
        own = table.withColumnsRenamed({"_slot": f"_slot_{c}", **{n: f"{n}_{c}" for n in names}})
        df = df.join(F.broadcast(own), F.col(f"_{c}") == F.col(f"_slot_{c}"), "left")
    each = []
    for j in range(len(names)):
        margin = sum((F.coalesce(f"_w{j}_{c}", F.lit(0.0)) for c in CATEGORICAL), F.col(f"_m{j}"))
        each.append(1.0 / (1.0 + F.exp(-margin)))
    df = df.select(*keep, label, *[p.alias(f"_p{j}") for j, p in enumerate(each)])
    total = F.nullif(sum((F.col(f"_p{j}") for j in range(1, len(each))), F.col("_p0")), F.lit(0.0))
    shares = df.select(*keep, label, *[F.coalesce(F.col(f"_p{j}") / total, F.lit(1.0 / len(each))).alias(f"p_{c}") for j, c in enumerate(model.classes)])
    ranked = F.array_max(F.array(*[F.struct(F.col(f"p_{c}").alias("p"), F.lit(-j).alias("i"), F.lit(c).alias("c")) for j, c in enumerate(model.classes)]))
    return shares.withColumn("prediction", ranked["c"])


def linear_importance(model: LinearModel) -> list[tuple[str, float]]:
    """Length of the weights over the classes per numeric feature, and summed over all hashed slots, largest first."""
    from tripkit.operators.models import HASHED_LABEL

    lengths = np.linalg.norm(model.average, axis=1)
    named = [(name, float(lengths[i])) for i, name in enumerate(NUMERIC)] + [(HASHED_LABEL, float(lengths[_BIAS + 1 :].sum()))]
    return sorted(named, key=lambda item: -item[1])
