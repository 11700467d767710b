"""Boosted trees that go on batch by batch."""

import pytest
from pyspark.sql import functions as F

from test_incremental import rows
from tripkit.operators import boosting as boost
from tripkit.operators.metrics import evaluate


def loss(model, data):
    return evaluate(boost.score_boosted(model, data), model.classes).first()["log_loss"]


def test_later_batches_correct_earlier_ones(spark):
    classes = ["Yellow", "Green"]
    data = rows(spark, 300).where("month < 2").coalesce(1)
    known = data.where(F.col("service").isin(*classes))
    model = boost.train(data, "month", classes=classes, slots=4, depth=2, rounds=1, subsample=1.0)
    assert len(model.batches) == 2 and model.rows == known.count()
    fewer = boost.Ensemble(classes, 4, model.rate, 0, model.batches[:1], model.design)
    assert loss(model, data) < loss(fewer, data) < loss(boost.Ensemble(classes, 4), data)
    scored = boost.score_boosted(model, data, keep=["id"])
    assert scored.count() == model.rows and evaluate(scored, classes).first()["macro_accuracy"] > 0.95
    assert scored.select(F.max(F.abs(sum(F.col(f"p_{c}") for c in classes) - 1))).first()[0] < 1e-12
    longer = boost.train_batch(model, data, depth=2, rounds=1)
    assert len(longer.batches) == 3 and longer.batches[:2] == model.batches and len(model.batches) == 2 and loss(longer, data) < loss(model, data)
    assert boost.train_batch(model, data.where("id < 0")) is model
    gains = boost.boosted_gains(model, spark)
    assert sorted(r[0] for r in gains.select("batch").distinct().collect()) == [0, 1]
    assert gains.agg(F.min("gain")).first()[0] > 0
    listed = {r["feature"]: r["gain"] for r in boost.boosted_importance(gains).collect()}
    assert sum(listed.values()) == pytest.approx(gains.agg(F.sum("gain")).first()[0])
    assert max(listed, key=listed.get) == "trip_distance"
    assert boost.boosted_gains(boost.Ensemble(), spark).count() == 0


def test_first_batch_takes_newton_steps(spark):
    """With one tree of one split on an empty ensemble, a leaf is gradient over curvature of its rows."""
    data = rows(spark, 100).where("month = 0").coalesce(1)
    model = boost.train_batch(boost.Ensemble(["Yellow", "Green"], 4), data, rounds=1, depth=1, subsample=1.0)
    margins = boost._margins(model, model.design.transform(data))
    found = margins[0].select("id", "service", margins[1][0].alias("m")).toPandas()
    found = found[found["service"].isin(["Yellow", "Green"])]
    for value, leaf in found.groupby(found["m"].round(9)):
        y = (leaf["service"] == "Yellow").astype(float)
        assert value == pytest.approx(model.rate * (y - 0.5).sum() / (0.25 * len(leaf)))
