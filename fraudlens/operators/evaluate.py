"""Class distributions, class weights and evaluation tables.

Windows without a key here run over one row per class (or pair of classes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fraudlens.schema import CLASS_WEIGHT_DIVISOR, WORST_CLASS_F1


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def top_classes(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    return class_distribution(df, column).orderBy(F.desc("count"), column).limit(k)


def class_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("classes"))


def class_weights(df: DataFrame, column: str, divisor: int = CLASS_WEIGHT_DIVISOR) -> DataFrame:
    """total / (divisor * rows of the class)."""
    return class_distribution(df, column).withColumn(
        "class_weight",
        F.sum("count").over(Window.partitionBy(F.lit(1))) / (divisor * F.col("count")),
    )


def top_class_weights(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    return class_weights(df, column).orderBy(F.desc("class_weight"), column).limit(k)


def with_class_weight(df: DataFrame, column: str, divisor: int = CLASS_WEIGHT_DIVISOR) -> DataFrame:
    """Attach the weight of each row's class; one small row per class on the other side."""
    weights = class_weights(df, column, divisor).select(F.col(column).alias("_class"), "class_weight")
    return (
        df.join(weights, F.col(column).eqNullSafe(F.col("_class")), "left")
        .withColumn("class_weight", F.coalesce("class_weight", F.lit(1.0)))
        .drop("_class")
    )


def confusion_counts(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predicted.groupBy(label, prediction).agg(F.count("*").alias("count"))


def confusion_matrix(
    predicted: DataFrame, classes: list[str] | None = None, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """The matrix in wide form: one row per label, one column per predicted class.

    Without ``classes`` every predicted class gets a column, so the cells add up to the rows.
    """
    wide = predicted.groupBy(label).pivot(prediction, classes).agg(F.count(F.lit(1)))
    return wide.na.fill(0)


def per_class_metrics(
    predicted: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall and F1 of every class, from one pass of counts."""
    counts = confusion_counts(predicted, label, prediction)
    sides = F.explode(
        F.array(
            F.struct(F.col(label).alias("class"), F.col("count").alias("actual"), F.lit(0).cast("long").alias("guessed")),
            F.struct(F.col(prediction).alias("class"), F.lit(0).cast("long").alias("actual"), F.col("count").alias("guessed")),
        )
    )
    hit = F.when(F.col(label) == F.col(prediction), F.col("side.actual")).otherwise(0)
    summed = (
        counts.withColumn("side", sides)
        .groupBy(F.col("side.class").alias("class"))
        .agg(
            F.sum(hit).alias("hits"),
            F.sum("side.actual").alias("actual"),
            F.sum("side.guessed").alias("guessed"),
        )
    )
    hits, actual, guessed = F.col("hits"), F.col("actual"), F.col("guessed")
    zero = F.lit(0.0)
    return summed.select(
        "class", "actual", "guessed", "hits",
        F.coalesce(F.try_divide(hits, guessed), zero).alias("precision"),
        F.coalesce(F.try_divide(hits, actual), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * hits, actual + guessed), zero).alias("f1"),
    )


def worst_classes(metrics: DataFrame, below: float = WORST_CLASS_F1) -> DataFrame:
    return metrics.filter(F.col("f1") < below).select("class", "f1").orderBy("f1", "class")


def accuracy_and_f1(metrics: DataFrame) -> DataFrame:
    """Accuracy and the F1 weighted by class size, from the per-class table."""
    return metrics.agg(
        F.try_divide(F.sum("hits"), F.sum("actual")).alias("accuracy"),
        F.try_divide(F.sum(F.col("f1") * F.col("actual")), F.sum("actual")).alias("f1"),
    )
