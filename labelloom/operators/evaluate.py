"""Scores to predictions, confusion matrices, metrics and ranked examples.

Everything but the per-row columns follows from one aggregation, the confusion cells; what
comes after is class-sized.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.scratch import small
from ..plans.select import top_per_group
from .vocab import share


def softmax(scores: str | Column = "scores") -> Column:
    """Array of probabilities; the largest score is subtracted first. Null for null scores."""
    s = F.transform(scores, lambda x: x.cast("double"))
    top = F.array_max(scores).cast("double")
    e = F.transform(s, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


def predict(scores: str | Column = "scores") -> Column:
    """Index of the largest score, the first of equal ones."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("bigint")


def top1(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """df(key, scores): key, label and probability of the prediction."""
    x = df.select("key", predict().alias("y_pred"), F.array_max(softmax()).alias("prob"))
    return x.join(small(vocab), F.col("y_pred") == F.col("idx"), "left").select("key", "label", "prob")


def probability_table(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """(key, label, prob, rank): a row for each item and class, ranked by probability, then index."""
    x = df.select("key", F.posexplode(softmax()).alias("idx", "prob"))
    x = x.withColumn("rank", F.row_number().over(W.partitionBy("key").orderBy(F.desc("prob"), "idx")).cast("bigint"))
    return x.join(small(vocab.withColumnRenamed("idx", "_idx")), F.col("idx") == F.col("_idx"), "left").select("key", "label", "prob", "rank")


def cells(df: DataFrame) -> DataFrame:
    """(y_true, y_pred, n) of pairs that occur; rows with a null on either side are left out."""
    return df.where("y_true is not null and y_pred is not null").groupBy("y_true", "y_pred").agg(F.count("*").alias("n"))


def confusion(df: DataFrame) -> DataFrame:
    """(y_true, y_pred, n) over all pairs of labels that occur as true or predicted, zeros included."""
    c = cells(df)
    labels = c.select(F.col("y_true").alias("label")).union(c.select("y_pred")).distinct()
    grid = labels.withColumnRenamed("label", "y_true").crossJoin(small(labels.withColumnRenamed("label", "y_pred")))
    return grid.join(c, ["y_true", "y_pred"], "left").select("y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def confusion_normalized(df: DataFrame) -> DataFrame:
    """confusion() with each row divided by its sum; an empty row is 0."""
    return confusion(df).withColumn("share", share(F.col("n"), F.sum("n").over(W.partitionBy("y_true"))))


def class_tallies(df: DataFrame) -> DataFrame:
    """(label, support, predicted, hits): row, column and diagonal sums of the confusion cells."""
    sides = cells(df).select(F.explode(F.array(F.struct(F.col("y_true").alias("label"), F.col("n").alias("row"), F.lit(0).cast("bigint").alias("col"), F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0).cast("bigint")).alias("hit")), F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("bigint").alias("row"), F.col("n").alias("col"), F.lit(0).cast("bigint").alias("hit")))).alias("s")).select("s.*")
    return sides.groupBy("label").agg(F.sum("row").alias("support"), F.sum("col").alias("predicted"), F.sum("hit").alias("hits"))


def _metrics(x: DataFrame) -> DataFrame:
    x = x.withColumns({"precision": share(F.col("hits"), F.col("predicted")), "recall": share(F.col("hits"), F.col("support"))})
    f1 = share(2 * F.col("hits"), F.col("predicted") + F.col("support"))
    return x.select("label", "precision", "recall", f1.alias("f1"), "support", "hits")


def per_class_metrics(df: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support) over the labels that occur as true or predicted; 0 where a denominator is."""
    return _metrics(class_tallies(df)).drop("hits")


def accuracy(df: DataFrame) -> DataFrame:
    """One row: acc and samples."""
    return cells(df).agg(F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("hits"), F.sum("n").alias("samples")).select(share(F.col("hits"), F.col("samples")).alias("acc"), "samples")


def macro_metrics(df: DataFrame) -> DataFrame:
    """One row: unweighted means of the classes' metrics."""
    return per_class_metrics(df).agg(F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"), F.avg("f1").alias("f1_macro"))


def classification_report(df: DataFrame, vocab: DataFrame, places: int = 3) -> DataFrame:
    """(name, precision, recall, f1, support): each class by name, then accuracy, macro avg and support-weighted avg."""
    per = per_class_metrics(df)
    named = per.join(small(vocab.withColumnRenamed("label", "name")), F.col("label") == F.col("idx"), "left").withColumn("name", F.coalesce("name", F.col("label").cast("string")))
    metrics = ("precision", "recall", "f1")
    macro = per.agg(*[F.avg(m).alias(m) for m in metrics], F.sum("support").alias("support")).withColumn("name", F.lit("macro avg"))
    weighted = per.agg(*[share(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in metrics], F.sum("support").alias("support")).withColumn("name", F.lit("weighted avg"))
    acc = accuracy(df).select(F.lit("accuracy").alias("name"), *[F.col("acc").alias(m) for m in metrics], F.col("samples").alias("support"))
    columns = ["name", *metrics, "support"]
    rows = named.select(columns).unionByName(acc.select(columns)).unionByName(macro.select(columns)).unionByName(weighted.select(columns))
    return rows.select("name", *[F.round(m, places).alias(m) for m in metrics], "support")


def top_mistakes(df: DataFrame, k: int = 6) -> DataFrame:
    """df(key, y_true, y_pred, scores): per true class the k wrong rows with the highest probability of the predicted class, ties by key."""
    x = df.where("y_pred <> y_true").select("key", "y_true", "y_pred", F.element_at(softmax(), (F.col("y_pred") + 1).cast("int")).alias("conf"))
    return top_per_group(x, "y_true", k, F.desc("conf"), F.asc("key"))


def top_correct(df: DataFrame, k: int = 6) -> DataFrame:
    """Per class the k right rows with the highest probability of the class, ties by key."""
    x = df.where("y_pred = y_true").select("key", "y_true", "y_pred", F.element_at(softmax(), (F.col("y_true") + 1).cast("int")).alias("conf"))
    return top_per_group(x, "y_true", k, F.desc("conf"), F.asc("key"))


def prediction_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """(key, true_a, true_b, pred_a, pred_b) where two sets of predictions disagree; a key that one lacks has nulls on that side. No rows: they agree."""
    x = a.select("key", F.col("y_true").alias("true_a"), F.col("y_pred").alias("pred_a"), F.lit(1).alias("_a"))
    y = b.select("key", F.col("y_true").alias("true_b"), F.col("y_pred").alias("pred_b"), F.lit(1).alias("_b"))
    both = x.join(y, "key", "full_outer")
    same = F.col("_a").eqNullSafe(F.col("_b")) & F.col("true_a").eqNullSafe(F.col("true_b")) & F.col("pred_a").eqNullSafe(F.col("pred_b"))
    return both.where(~same).select("key", "true_a", "true_b", "pred_a", "pred_b")


def evaluate(df: DataFrame) -> DataFrame:
    """One row: acc, precision_macro, recall_macro, f1_macro, samples."""
    per = _metrics(class_tallies(df))
    return per.agg(share(F.sum("hits"), F.sum("support")).alias("acc"), F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"), F.avg("f1").alias("f1_macro"), F.sum("support").alias("samples"))
