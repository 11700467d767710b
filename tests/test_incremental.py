"""The classifier trained batch by batch, and gains of trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripkit.operators import incremental as inc
from tripkit.operators.features import NUMERIC
from tripkit.operators.metrics import evaluate
from tripkit.operators.models import feature_importance, fit, score, split_gains, tree_model


def rows(spark, n=1500):
    """Two numeric features and a borough tell the classes apart; months have different mixes."""
    i = F.col("id")
    kind = F.when(i % 5 < 2, "Yellow").when(i % 5 < 4, "Green").otherwise("FHVHV")
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    frame = spark.range(n).select(
        i, (i % 4).cast("int").alias("month"), kind.alias("service"),
        (F.when(i % 5 < 2, 1.0).otherwise(-1.0) + noise).alias("trip_distance"), (F.when(i % 5 < 4, 1.0).otherwise(-1.0) - noise).alias("duration_min"),
        noise.alias("speed_mph"), F.lit(0.0).alias("hour"), F.lit(None).cast("double").alias("dow"),
        F.when(i % 5 == 4, "Bronx").otherwise("Queens").alias("pickup_borough"), F.lit("NA").alias("dropoff_borough"),
    )
    return frame.fillna(0.0, subset=["dow"])


def test_one_worker_equals_plain_descent(spark):
    data = rows(spark, 60)
    model = inc.train(data, "month", order=[F.col("id")], epochs=2, slots=64, step_rows=1)
    slots = data.select("id", *[inc.slot(c, 64).alias(c) for c in ("pickup_borough", "dropoff_borough")]).toPandas().set_index("id")
    frame = data.toPandas().set_index("id")
    weights = np.zeros((6 + 64, 3))
    total, steps = np.zeros_like(weights), 0
    for _ in range(2):
        for month in range(4):
            for i in sorted(frame.index[frame["month"] == month]):
                places = [*range(6), *slots.loc[i]]
                x = np.array([*frame.loc[i, NUMERIC], 1.0, 1.0, 1.0], float)
                y = np.array([frame.loc[i, "service"] == c for c in model.classes], float)
                off = 1 / (1 + np.exp(-(x @ weights[places]))) - y
                seen = sorted({*range(5), *(s for m in frame.index[frame["month"] == month] for s in slots.loc[m])})  # shrunk, the bias apart
                weights[seen] *= 1 - inc.STEP * inc.STRENGTH * (1 - inc.L1_RATIO)
                for p, v in zip(places, x):
                    weights[p] -= inc.STEP * off * v
                weights[seen] = np.sign(weights[seen]) * np.maximum(np.abs(weights[seen]) - inc.STEP * inc.STRENGTH * inc.L1_RATIO, 0)
                total, steps = total + weights, steps + 1
    assert model.steps == steps == 120 and model.batches == 8
    assert np.allclose(model.current, weights) and np.allclose(model.average, total / steps)


def test_many_workers_learn_and_go_on(spark, monkeypatch):
    monkeypatch.setattr(inc, "WORKER_ROWS", 100)
    data = rows(spark)
    order = [F.xxhash64("id"), F.col("id")]
    model = inc.train(data, "month", order=order, slots=256)
    assert np.array_equal(model.average, inc.train(data.repartition(7), "month", order=order, slots=256).average)
    scored = inc.score_linear(model, data, keep=["id"])
    found = evaluate(scored, model.classes).first()
    assert scored.count() == 1500 and found["macro_accuracy"] > 0.95
    sums = scored.select(F.abs(sum(F.col(f"p_{c}") for c in model.classes) - 1).alias("off"))
    assert sums.agg(F.max("off")).first()[0] < 1e-12
    longer = inc.train(data, "month", order=order, epochs=1, model=model)
    assert longer.batches == model.batches + 4 and longer.steps == 1500 * 3
    names = [n for n, _ in inc.linear_importance(model)]
    assert len(names) == 6 and set(names[:3]) & {"trip_distance", "duration_min"}
    assert inc.train_batch(model, data.where("id < 0"), order=order) is model


def test_gains_add_up(spark):
    data = rows(spark, 600)
    model = fit(data, tree_model(rounds=3, depth=2), slots=16)
    gains = split_gains(model)
    listed = dict(feature_importance(model))
    assert sum(listed.values()) == pytest.approx(gains.agg(F.sum("gain")).first()[0])
    assert gains.select("class").distinct().count() == 3 and gains.agg(F.min("gain")).first()[0] > 0
    assert gains.where("node = 0").agg(F.max("rows")).first()[0] <= 600
    assert score(model, data).count() == 600
