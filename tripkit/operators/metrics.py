"""Classifier metrics from a frame of labels, predictions and probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: probabilities are clipped to this distance from 0 and 1 (double epsilon).
EPSILON = 2.220446049250313e-16


def _cells(df: DataFrame, classes: list[str], label: str, prediction: str, loss: Column) -> DataFrame:
    """Rows and summed loss per (true, predicted): the only pass over the data."""
    known = df.where(F.col(label).isin(*classes) & F.col(prediction).isin(*classes))
    return known.groupBy(F.col(label).alias("true_class"), F.col(prediction).alias("pred_class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(loss).alias("loss")
    )


def _on_grid(cells: DataFrame, classes: list[str]) -> DataFrame:
    """Counts for every pair of classes, 0 where no row fell. The grid is spelled out as literals."""
    pairs = F.array(*[F.struct(F.lit(t).alias("true_class"), F.lit(p).alias("pred_class")) for t in classes for p in classes])
    grid = cells.sparkSession.range(1).select(F.inline(pairs))
    seen = cells.select("true_class", "pred_class", "n")
    return grid.join(seen, ["true_class", "pred_class"], "left").fillna(0, subset=["n"])


def confusion_counts(df: DataFrame, classes: list[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (true, predicted) over the full grid of classes."""
    return _on_grid(_cells(df, classes, label, prediction, F.lit(0.0)), classes)


def confusion_matrix(df: DataFrame, classes: list[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Row-normalised confusion matrix in long form; a class without rows gives zeros."""
    total = F.sum("n").over(Window.partitionBy("true_class"))
    return confusion_counts(df, classes, label, prediction).select(
        "true_class", "pred_class", "n",
        F.coalesce(F.col("n") / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("share"),
    )


def _metrics(counts: DataFrame) -> DataFrame:
    per_true = counts.groupBy(F.col("true_class").alias("class")).agg(
        F.sum("n").alias("actual"), F.sum(F.when(F.col("true_class") == F.col("pred_class"), F.col("n"))).alias("hits")
    )
    per_pred = counts.groupBy(F.col("pred_class").alias("class")).agg(F.sum("n").alias("predicted"))
    each = per_true.join(per_pred, "class").where((F.col("actual") > 0) | (F.col("predicted") > 0))
    recall = F.col("hits") / F.nullif(F.col("actual"), F.lit(0))
    f1 = F.lit(2.0) * F.col("hits") / (F.col("actual") + F.col("predicted"))
    macro = F.avg(recall)
    return each.agg(
        macro.alias("macro_accuracy"),
        F.avg(f1).alias("macro_f1"),
        (F.sum("hits") / F.nullif(F.sum("actual"), F.lit(0))).alias("raw_accuracy"),
        (F.lit(1.0) - macro).alias("error_rate"),
    )


def classification_metrics(
    df: DataFrame, classes: list[str], label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Macro accuracy (mean recall of the classes present), macro F1, raw accuracy, error rate."""
    return _metrics(confusion_counts(df, classes, label, prediction))


def _loss(true_probability: Column) -> Column:
    return -F.ln(F.least(F.greatest(true_probability, F.lit(EPSILON)), F.lit(1.0 - EPSILON)))


def evaluate(scored: DataFrame, classes: list[str], label: str = "service") -> DataFrame:
    """One row: macro accuracy, macro F1, raw accuracy, error rate, log loss, rows.

    ``scored`` has a ``prediction`` and one probability column ``p_<class>`` per class.
    """
    of_true = F.coalesce(*[F.when(F.col(label) == c, F.col(f"p_{c}")) for c in classes])
    cells = _cells(scored, classes, label, "prediction", _loss(of_true))
    loss = cells.agg((F.sum("loss") / F.nullif(F.sum("n"), F.lit(0))).alias("log_loss"), F.sum("n").alias("rows"))
    one_row = F.broadcast(loss.withColumn("_one", F.lit(1)))
    return _metrics(_on_grid(cells, classes)).withColumn("_one", F.lit(1)).join(one_row, "_one").drop("_one")


def log_loss(df: DataFrame, true_probability: Column) -> DataFrame:
    """Mean negative log of the probability given to the true class."""
    return df.agg(F.avg(_loss(true_probability)).alias("log_loss"), F.count(F.lit(1)).alias("rows"))


def class_counts(df: DataFrame, label: str = "service") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def majority_class(df: DataFrame, label: str = "service") -> DataFrame:
    """The most frequent class and its rows; ties go to the smaller name."""
    return class_counts(df, label).orderBy(F.col("rows").desc(), label).limit(1)


def majority_baseline(valid: DataFrame, train: DataFrame, classes: list[str], label: str = "service") -> DataFrame:
    """Validation rows with the majority class of the training rows as prediction.

    Probability is 1 for that class and 0 for the others.
    """
    winner = F.broadcast(majority_class(train, label).select(F.col(label).alias("prediction"), F.lit(1).alias("_one")))
    predicted = valid.withColumn("_one", F.lit(1)).join(winner, "_one").drop("_one")
    return predicted.withColumns(
        {f"p_{c}": (F.col("prediction") == c).cast("double") for c in classes}
    )
