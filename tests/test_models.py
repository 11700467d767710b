"""The classifiers of the queries: their settings, and models that have columns for the filled hash slots only."""

import pytest
from pyspark.sql import functions as F

from tripkit.operators import models
from tripkit.operators.features import CLASSES, HASH_SLOTS, NUMERIC
from workload import learning


def rows(spark, n=400):
    """Four boroughs, some of which tell the classes apart, and numeric columns that do so in part."""
    i = F.col("id")
    noise = [F.pmod(F.xxhash64(i, F.lit(c)), F.lit(1000)) / 500.0 - 1.0 for c in NUMERIC]
    kind = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), (i % 3 + 1).cast("int"))
    place = F.element_at(F.array(*[F.lit(f"place {k}") for k in range(4)]), (F.pmod(F.xxhash64(i), F.lit(2)) + i % 3 + 1).cast("int"))
    numbers = [(x + (i % 3) * (k % 2)).alias(c) for k, (c, x) in enumerate(zip(NUMERIC, noise))]
    return spark.range(0, n, 1, 2).select(kind.alias("service"), *numbers, place.alias("pickup_borough"), F.lit("NA").alias("dropoff_borough"))


def trained_by(spark, monkeypatch, query):
    """The estimator and the number of slots that a query trains with."""
    seen = []

    def spy(train, estimator, slots=HASH_SLOTS, **rest):
        seen.append((estimator, slots))
        return models.fit(train, estimator.copy({estimator.maxIter: 1}), slots=16, **rest)

    monkeypatch.setattr(learning, "_split", lambda spark, sf: (rows(spark), rows(spark, 90)))
    monkeypatch.setattr(learning, "fit", spy)
    query(spark, "").collect()
    return seen[0]


@pytest.mark.parametrize("query", [learning.importance, learning.linear_classifier])
def test_linear_queries_train_at_the_settings_of_the_library(spark, monkeypatch, query):
    """Before, they stopped after 5 iterations and hashed into 2^10 slots."""
    estimator, slots = trained_by(spark, monkeypatch, query)
    assert (estimator.getMaxIter(), slots) == (100, 2**15)


def test_tree_query_trains_at_the_settings_of_the_library(spark, monkeypatch):
    """Before, it grew 2 rounds of depth 3 on 2^4 slots."""
    estimator, slots = trained_by(spark, monkeypatch, learning.tree_classifier)
    assert (estimator.getMaxIter(), estimator.getMaxDepth(), slots) == (50, 6, 2**15)


def test_empty_slots_change_no_linear_model(spark, monkeypatch):
    data = rows(spark).coalesce(1)
    model = models.fit(data, models.linear_model(epochs=4), slots=64)
    assert 1 < len(model.kept) <= 5 and {m.numFeatures for m in model.models.values()} == {len(NUMERIC) + len(model.kept)}
    monkeypatch.setattr(models, "filled_slots", lambda df, slots: list(range(slots)))
    wide = models.fit(data, models.linear_model(epochs=4), slots=64)
    assert dict(models.feature_importance(model)) == pytest.approx(dict(models.feature_importance(wide)), rel=1e-6)
    new = rows(spark, 90).coalesce(1).withColumn("dropoff_borough", F.lit("never seen"))
    both = [models.score(m, new).select(*[f"p_{c}" for c in CLASSES]).collect() for m in (model, wide)]
    assert [tuple(r) for r in both[0]] == [pytest.approx(tuple(r), rel=1e-6) for r in both[1]]


def test_gains_name_the_places_of_all_slots(spark):
    data = rows(spark).withColumns({c: F.lit(0.0) for c in NUMERIC})
    model = models.fit(data, models.tree_model(rounds=1, depth=2))
    gains = models.split_gains(model)
    assert {r["feature"] for r in gains.select("feature").distinct().collect()} <= {len(NUMERIC) + k for k in model.kept}
    listed = dict(models.feature_importance(model))
    assert listed[models.HASHED_LABEL] == pytest.approx(gains.agg(F.sum("gain")).first()[0]) and listed[models.HASHED_LABEL] > 0


def test_rows_without_categories(spark):
    data = rows(spark).withColumns({c: F.lit(None).cast("string") for c in ("pickup_borough", "dropoff_borough")})
    model = models.fit(data, models.linear_model(epochs=3), slots=8)
    assert models.score(model, data).count() == 400 and dict(models.feature_importance(model))[models.HASHED_LABEL] == 0.0
