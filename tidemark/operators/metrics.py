"""Accuracy, confusion matrix and per-class report of a classification.

Input rows have ``label`` (true) and ``pred``; everything after the first count is class-sized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(predicted: DataFrame) -> DataFrame:
    """Share of rows whose prediction is right."""
    return predicted.agg(F.avg((F.col("pred") == F.col("label")).cast("int")).alias("accuracy"))


def confusion(predicted: DataFrame) -> DataFrame:
    """L8, long form: a count for every (true, predicted) pair of classes, zeros included.

    Rows without a prediction are no part of it, nor of the accuracy.
    """
    counts = predicted.where("pred is not null").groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"))
    classes = counts.agg(
        F.array_union(F.collect_set("label"), F.collect_set("pred")).alias("classes")
    )
    grid = classes.select(F.explode("classes").alias("label"), "classes").select(
        "label", F.explode("classes").alias("pred"), F.lit(0).cast("bigint").alias("n")
    )
    return counts.unionByName(grid).groupBy("label", "pred").agg(F.sum("n").alias("n"))


def report(confusion_long: DataFrame) -> DataFrame:
    """Precision, recall, f1 and support per class, then their plain and weighted averages.

    0/0 counts as 0.
    """
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("support"), zero.alias("predicted")
        ),
        F.struct(
            F.col("pred").alias("class"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")
        ),
    )
    per_class = (
        confusion_long.select(F.explode(sides).alias("s"))
        .select("s.*")
        .groupBy("class")
        .agg(
            F.sum("tp").alias("tp"),
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
        )
    )
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    scored = (
        per_class.withColumn("precision", share(F.col("tp"), F.col("predicted")))
        .withColumn("recall", share(F.col("tp"), F.col("support")))
        .withColumn(
            "f1",
            share(
                2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
            ),
        )
    )
    scores = ["precision", "recall", "f1"]
    rows = scored.select(F.col("class").cast("string").alias("class"), *scores, "support")
    weighted = lambda c: share(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c)
    support = F.sum("support").alias("support")
    return rows.unionByName(
        scored.agg(*[F.avg(c).alias(c) for c in scores], support).withColumn("class", F.lit("macro avg"))
    ).unionByName(
        scored.agg(*[weighted(c) for c in scores], support).withColumn("class", F.lit("weighted avg"))
    )
