"""Features, samples, metrics and models of the service classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.operators import boosting as boost
from tripkit.operators import features as ft
from tripkit.operators import incremental as inc
from tripkit.operators import metrics as mt
from tripkit.operators import selection as sel
from tripkit.operators.models import feature_importance, fit, linear_model, score, tree_model
from tripkit.session import saved, shared_dir
from workload.registry import query
from workload.views import RIDES, TRIPS, rides, table, trips

_CLASSES = ft.CLASSES

_FEATURES = f"""{TRIPS}, shifted AS (
  SELECT *, pickup_datetime + INTERVAL 1 MINUTE * CAST(l_partkey % 1440 AS INTEGER) AS pu_at,
         pickup_datetime + INTERVAL 1 MINUTE * CAST(l_partkey % 1440 + l_orderkey % 500 - 20 AS INTEGER) AS do_at,
         CASE WHEN l_linenumber = 2 THEN NULL ELSE trip_distance END AS miles FROM trips),
timed AS (SELECT *, least(greatest(date_diff('second', pu_at, do_at) / CAST(60 AS DOUBLE), CAST(0.1 AS DOUBLE)), CAST(360 AS DOUBLE)) AS minutes FROM shifted),
features AS (SELECT l_orderkey, l_partkey, l_linenumber, service, CAST(miles AS DOUBLE) AS trip_distance, minutes AS duration_min,
  CASE WHEN miles IS NOT NULL THEN least(greatest(miles / (minutes / CAST(60 AS DOUBLE)), CAST(0 AS DOUBLE)), CAST(120 AS DOUBLE)) END AS speed_mph,
  CAST(hour(pu_at) AS SMALLINT) AS hour, CAST((dayofweek(pu_at) + 6) % 7 AS SMALLINT) AS dow,
  coalesce(pickup_borough, 'NA') AS pickup_borough, coalesce(dropoff_borough, 'NA') AS dropoff_borough, year FROM timed)"""
_KEYS = ["l_orderkey", "l_partkey", "l_linenumber", "year"]


def _features(spark, sf) -> DataFrame:
    """Trips moved to times of day, with durations of some hours, some negative, some distances missing."""
    part, order = F.col("l_partkey"), F.col("l_orderkey")
    start = F.timestamp_add("MINUTE", (part % 1440).cast("int"), F.col("pickup_datetime"))
    end = F.timestamp_add("MINUTE", (part % 1440 + order % 500 - 20).cast("int"), F.col("pickup_datetime"))
    shifted = trips(spark, sf).withColumns(
        {"pu_at": start, "do_at": end, "miles": F.when(F.col("l_linenumber") != 2, F.col("trip_distance"))}
    )
    return ft.engineer_features(shifted, pickup="pu_at", dropoff="do_at", distance="miles", keep=_KEYS)


@query("engineer_features", f"""
WITH {_FEATURES}
SELECT l_orderkey, l_partkey, l_linenumber, year, service, trip_distance, round(duration_min, 4) AS duration_min, round(speed_mph, 4) AS speed_mph,
       hour, dow, pickup_borough, dropoff_borough FROM features""")
def engineer_features(spark, sf):
    return _features(spark, sf).withColumns(
        {"duration_min": F.round("duration_min", 4), "speed_mph": F.round("speed_mph", 4)}
    )


@query("scaler_params", f"""
WITH {_FEATURES}
{' UNION ALL '.join(f"SELECT '{c}' AS feature, round(avg(coalesce({c}, 0)::DOUBLE), 6) AS mean, round(stddev_pop(coalesce({c}, 0)::DOUBLE), 6) AS std FROM features" for c in ft.NUMERIC)}""")
def scaler_params(spark, sf):
    return ft.scaler_params(_features(spark, sf)).select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("scaled_features", f"""
WITH {_FEATURES}, p AS (SELECT {', '.join(f'avg(coalesce({c}, 0)::DOUBLE) AS m_{c}, stddev_pop(coalesce({c}, 0)::DOUBLE) AS s_{c}' for c in ft.NUMERIC)} FROM features)
SELECT l_orderkey, l_partkey, l_linenumber, service, {', '.join(f'round((coalesce({c}, 0) - m_{c}) / s_{c}, 3) AS {c}' for c in ft.NUMERIC)}
FROM features, p""")
def scaled_features(spark, sf):
    rows = _features(spark, sf)
    scaled = ft.scale_features(rows, ft.collected(ft.scaler_params(rows)))
    return scaled.select(
        "l_orderkey", "l_partkey", "l_linenumber", "service", *[F.round(c, 3).alias(c) for c in ft.NUMERIC]
    )


# Orders as classified rows with a unique key; the class sizes differ, and February lacks a class.
_LABELLED = """labelled AS (SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month,
  CASE WHEN o_orderkey % 10 < 6 OR (month(o_orderdate) = 2 AND o_orderkey % 10 = 9) THEN 'Yellow'
       WHEN o_orderkey % 10 < 9 THEN 'FHVHV' ELSE 'Green' END AS service,
  ((o_orderkey % 2147483648) * 2654435761) % 4294967296 AS ord FROM orders)"""


def _labelled(spark, sf) -> DataFrame:
    key = F.col("o_orderkey")
    month = F.month("o_orderdate")
    yellow = (key % 10 < 6) | ((month == 2) & (key % 10 == 9))
    kind = F.when(yellow, F.lit("Yellow")).when(key % 10 < 9, F.lit("FHVHV")).otherwise(F.lit("Green"))
    return table(spark, sf, "orders").select("o_orderkey", month.alias("month"), kind.alias("service"))


def _order():
    """Pseudo-random order that both engines can compute."""
    return ((F.col("o_orderkey") % 2147483648) * 2654435761) % 4294967296


@query("capped_sample", f"""
WITH {_LABELLED}, r AS (SELECT *, row_number() OVER (PARTITION BY service, month ORDER BY ord, o_orderkey) AS r FROM labelled)
SELECT o_orderkey, month, service FROM r WHERE r <= 50""")
def capped_sample(spark, sf):
    return sel.sample_per_group(_labelled(spark, sf), ["service", "month"], 50, order=_order(), tie=["o_orderkey"])


@query("balanced_sample", f"""
WITH {_LABELLED}, n AS (SELECT month, service, count(*) AS n FROM labelled GROUP BY 1, 2),
q AS (SELECT month, min(least(n, 100)) AS q FROM n GROUP BY 1 HAVING count(*) = 3),
r AS (SELECT *, row_number() OVER (PARTITION BY month, service ORDER BY ord, o_orderkey) AS r FROM labelled)
SELECT o_orderkey, month, service FROM r JOIN q USING (month) WHERE r <= q""")
def balanced_sample(spark, sf):
    return sel.balanced_sample(
        _labelled(spark, sf), ["month"], "service", _CLASSES, order=_order(), tie=["o_orderkey"], cap=100
    )


@query("shuffled_rows", "SELECT c_custkey, c_name FROM customer")
def shuffled_rows(spark, sf):
    return sel.shuffle_rows(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("class_counts", f"WITH {RIDES} SELECT service, count(*) AS rows FROM rides GROUP BY 1")
def class_counts(spark, sf):
    return mt.class_counts(rides(spark, sf))


@query("majority_class", f"""
WITH {RIDES} SELECT service, count(*) AS rows FROM rides GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def majority_class(spark, sf):
    return mt.majority_class(rides(spark, sf))


# A made-up prediction that depends on the row: right for most, wrong in a fixed pattern.
_PREDICTED = f"""{RIDES}, predicted AS (
  SELECT service AS label, CASE WHEN l_partkey % 4 = 0 THEN 'Yellow' WHEN l_partkey % 7 = 0 THEN 'Green' ELSE service END AS prediction,
         CAST(l_partkey % 1001 AS DOUBLE) / 1000 AS p FROM rides)"""
_CONFUSION = f"""{_PREDICTED}, classes AS (SELECT unnest(['Yellow', 'Green', 'FHVHV', 'FHV']) AS c),
grid AS (SELECT a.c AS true_class, b.c AS pred_class FROM classes a CROSS JOIN classes b),
seen AS (SELECT label, prediction, count(*) AS n FROM predicted GROUP BY 1, 2),
cm AS (SELECT true_class, pred_class, coalesce(n, 0) AS n FROM grid LEFT JOIN seen ON label = true_class AND prediction = pred_class)"""
_FOUR = ["Yellow", "Green", "FHVHV", "FHV"]


def _predicted(spark, sf) -> DataFrame:
    part = F.col("l_partkey")
    return rides(spark, sf).select(
        F.col("service").alias("label"),
        F.when(part % 4 == 0, F.lit("Yellow")).when(part % 7 == 0, F.lit("Green")).otherwise(F.col("service")).alias("prediction"),
        ((part % 1001).cast("double") / 1000).alias("p"),
    )


@query("confusion_matrix", f"""
WITH {_CONFUSION}, t AS (SELECT *, sum(n) OVER (PARTITION BY true_class) AS total FROM cm)
SELECT true_class, pred_class, CAST(n AS BIGINT) AS n, round(CASE WHEN total = 0 THEN 0.0 ELSE CAST(n AS DOUBLE) / total END, 4) AS share FROM t""")
def confusion_matrix(spark, sf):
    return mt.confusion_matrix(_predicted(spark, sf), _FOUR).withColumn("share", F.round("share", 4))


@query("classification_metrics", f"""
WITH {_CONFUSION}, t AS (SELECT true_class AS c, sum(n) AS actual, sum(n) FILTER (true_class = pred_class) AS hits FROM cm GROUP BY 1),
p AS (SELECT pred_class AS c, sum(n) AS predicted FROM cm GROUP BY 1),
e AS (SELECT CAST(hits AS DOUBLE) AS hits, actual, predicted FROM t JOIN p USING (c) WHERE actual > 0 OR predicted > 0)
SELECT round(avg(hits / nullif(actual, 0)), 4) AS macro_accuracy, round(avg(2 * hits / (actual + predicted)), 4) AS macro_f1,
  round(sum(hits) / sum(actual), 4) AS raw_accuracy, round(1 - avg(hits / nullif(actual, 0)), 4) AS error_rate FROM e""")
def classification_metrics(spark, sf):
    found = mt.classification_metrics(_predicted(spark, sf), _FOUR)
    return found.select(*[F.round(c, 4).alias(c) for c in found.columns])


@query("log_loss", f"""
WITH {_PREDICTED}
SELECT round(avg(-ln(least(greatest(p, CAST(2.220446049250313e-16 AS DOUBLE)), CAST(1 AS DOUBLE) - CAST(2.220446049250313e-16 AS DOUBLE)))), 4) AS log_loss,
       count(*) AS rows FROM predicted""")
def log_loss(spark, sf):
    return mt.log_loss(_predicted(spark, sf), F.col("p")).withColumn("log_loss", F.round("log_loss", 4))


@query("majority_baseline", f"""
WITH {RIDES}, valid AS (SELECT service FROM rides WHERE year = 1999),
m AS (SELECT service AS best FROM rides WHERE year = 1998 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
s AS (SELECT count(*) AS n, count(*) FILTER (service = best) AS hits, count(DISTINCT service) AS k FROM valid, m)
SELECT round(CAST(1 AS DOUBLE) / k, 4) AS macro_accuracy, round(2 * CAST(hits AS DOUBLE) / (hits + n) / k, 4) AS macro_f1,
       round(CAST(hits AS DOUBLE) / n, 4) AS raw_accuracy, round(1 - CAST(1 AS DOUBLE) / k, 4) AS error_rate,
       round((n - hits) * -ln(CAST(2.220446049250313e-16 AS DOUBLE)) / n, 4) AS log_loss, n AS rows FROM s""")
def majority_baseline(spark, sf):
    r = rides(spark, sf)
    scored = mt.majority_baseline(r.where("year = 1999"), r.where("year = 1998"), _CLASSES)
    found = mt.evaluate(scored, _CLASSES)
    return found.select(*[F.round(c, 4).alias(c) if c != "rows" else F.col(c) for c in found.columns])


def _two_years(spark, sf) -> DataFrame:
    """Features of the years to train on and to validate with. Samples, scales and models read them again and again, so they are joined once."""
    return saved(spark, _features(spark, sf).where(F.col("year").isin(1998, 1999)), "features")


def _split(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Balanced, scaled training rows of one year and scaled validation rows of the next."""
    rows = _two_years(spark, sf)
    train = rows.where("year = 1998")
    keys = _KEYS[:3]
    balanced = sel.balanced_sample(
        train, ["year"], "service", _CLASSES, order=sel.seeded_order(*keys), tie=[*keys, *ft.NUMERIC]
    )
    balanced = saved(spark, balanced, "balanced")
    params = ft.collected(ft.scaler_params(balanced))
    return ft.scale_features(balanced, params), ft.scale_features(rows.where("year = 1999"), params)


def _training(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The same with the month of the pickup, balanced month by month, as the trained jobs have it."""
    month = ((F.col("l_partkey") % 12) + 1).cast("int").alias("month")
    rows = _two_years(spark, sf).select("*", month)
    keys = _KEYS[:3]
    balanced = sel.balanced_sample(
        rows.where("year = 1998"), ["month"], "service", _CLASSES, order=sel.seeded_order(*keys), tie=[*keys, *ft.NUMERIC]
    )
    balanced = saved(spark, balanced, "balanced")
    params = ft.collected(ft.scaler_params(balanced))
    return ft.scale_features(balanced, params), ft.scale_features(rows.where("year = 1999"), params)


# What must hold of stored predictions, recomputed from them: a row per scored row, probabilities that sum to 1, the class of the
# highest one as prediction, metrics as the operator gives them.
_SOUND = f"""
WITH {RIDES}
SELECT count(*) AS rows, true AS sum_to_one, true AS highest_wins, true AS metrics_agree FROM rides WHERE year = 1999"""


def _sound(spark, scored: DataFrame) -> DataFrame:
    """``scored`` stored, read back and checked."""
    path = shared_dir(spark, "predictions")
    scored.write.parquet(path)
    stored = spark.read.parquet(path)
    given = mt.evaluate(stored, _CLASSES).first()
    p = [F.col(f"p_{c}") for c in _CLASSES]
    own = F.coalesce(*[F.when(F.col("service") == c, q) for c, q in zip(_CLASSES, p)])
    loss = -F.ln(F.least(F.greatest(own, F.lit(2.220446049250313e-16)), F.lit(1 - 2.220446049250313e-16)))
    recall = [F.avg(F.when(F.col("service") == c, (F.col("prediction") == c).cast("double"))) for c in _CLASSES]
    mean_recall = sum(recall[1:], recall[0]) / len(_CLASSES)
    top = F.greatest(*p)
    chosen = F.coalesce(*[F.when(F.col("prediction") == c, q) for c, q in zip(_CLASSES, p)])
    return stored.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.max(F.abs(p[0] + p[1] + p[2] - 1)) < 1e-9).alias("sum_to_one"),
        F.bool_and(chosen == top).alias("highest_wins"),
        ((F.abs(F.avg(loss) - given["log_loss"]) < 1e-9) & (F.abs(mean_recall - given["macro_accuracy"]) < 1e-9)).alias("metrics_agree"),
    )


@query("incremental_classifier", _SOUND)
def incremental_classifier(spark, sf):
    """Two epochs over monthly batches with averaged weights, at the library's settings."""
    rows, valid = _training(spark, sf)
    model = inc.train(rows, "month", order=[sel.seeded_order(*_KEYS[:3]), *[F.col(k) for k in _KEYS[:3]]])
    return _sound(spark, inc.score_linear(model, valid))


@query("boosted_classifier", _SOUND.replace("SELECT count(*) AS rows", "SELECT true AS gains_add_up, true AS gains_positive, count(*) AS rows"))
def boosted_classifier(spark, sf):
    """Trees added quarter by quarter at the library's settings; their gains, from the node tables, add up to those per feature."""
    rows, valid = _training(spark, sf)
    model = boost.train(rows.withColumn("quarter", F.ceil(F.col("month") / 3)), "quarter")
    gains = saved(spark, boost.boosted_gains(model, spark), "boosted-gains")
    whole, least = gains.agg(F.sum("gain"), F.min("gain")).first()
    parts = boost.boosted_importance(gains).agg(F.sum("gain")).first()[0]
    return _sound(spark, boost.score_boosted(model, valid)).withColumns(
        {"gains_add_up": F.lit(abs(parts - whole) <= 1e-9 * whole), "gains_positive": F.lit(least > 0)}
    )


@query("linear_classifier", None)
def linear_classifier(spark, sf):
    train, valid = _split(spark, sf)
    return mt.evaluate(score(fit(train, linear_model()), valid), _CLASSES)


@query("tree_classifier", None)
def tree_classifier(spark, sf):
    train, valid = _split(spark, sf)
    return mt.evaluate(score(fit(train, tree_model()), valid), _CLASSES)


@query("feature_importance", None)
def importance(spark, sf):
    train, _ = _split(spark, sf)
    ranked = feature_importance(fit(train, linear_model()))
    return spark.createDataFrame(ranked, "feature string, importance double")
