"""Class vocabularies, class sets and counts per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.scratch import small


def display_name(df: DataFrame, names: DataFrame, label: str = "label") -> DataFrame:
    """df with display: names(label, display), or the label itself where there is none."""
    named = small(names.select(F.col("label").alias("_label"), F.col("display").alias("_display")))
    return df.join(named, F.col(label) == F.col("_label"), "left").withColumn("display", F.coalesce("_display", label)).drop("_label", "_display")


def class_set_diff(df: DataFrame, expected: DataFrame, by: str) -> DataFrame:
    """(by, label, side) for each subset: labels of expected(label) that it lacks are missing, others that it has are extra. No rows: all agree."""
    found = df.select(by, "label").where("label is not null").distinct()
    wanted = df.select(by).distinct().crossJoin(small(expected.select("label").distinct()))
    both = wanted.withColumn("w", F.lit(1)).join(found.withColumn("f", F.lit(1)), [by, "label"], "full_outer")
    return both.where("w is null or f is null").select(by, "label", F.when(F.col("w").isNull(), "extra").otherwise("missing").alias("side"))


def verify_classes(found: DataFrame, expected: DataFrame, strict: bool = False) -> DataFrame:
    """One row (ok, n_wrong): found and expected(idx, label) are the same list, in order. strict: unequal lists raise when the row is read."""
    both = found.select("idx", F.col("label").alias("a")).join(expected.select("idx", F.col("label").alias("b")), "idx", "full_outer")
    out = both.agg(F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_wrong")).select((F.col("n_wrong") == 0).alias("ok"), "n_wrong")
    return out.withColumn("ok", F.when(F.col("ok"), True).otherwise(F.raise_error(F.lit("the class lists differ")).cast("boolean"))) if strict else out


def build_vocab(df: DataFrame) -> DataFrame:
    """(idx, label): the distinct labels in lexicographic order, numbered from 0. A table without labels is an error when the rows are read."""
    labels = df.select("label").where("label is not null").distinct()
    return labels.select((F.row_number().over(W.partitionBy(F.lit(1)).orderBy("label")) - 1).cast("int").alias("idx"), "label")


def require_classes(vocab: DataFrame) -> DataFrame:
    if vocab.isEmpty():
        raise ValueError("there are no classes")
    return vocab


def check_vocab(df: DataFrame) -> DataFrame:
    """df(key, value): (problem, key, value) for keys that are not all digits and values that are null or empty; an empty table is a problem of its own."""
    key = F.coalesce(F.col("key").rlike("^[0-9]+$"), F.lit(False))
    value = F.coalesce(F.length("value") > 0, F.lit(False))
    wrong = df.select(F.explode(F.array_compact(F.array(F.when(~key, "bad_key"), F.when(~value, "bad_value")))).alias("problem"), "key", "value")
    empty = df.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("empty").alias("problem"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value"))
    return wrong.unionByName(empty)


def normalize_vocab(df: DataFrame, entries: str = "entries") -> DataFrame:
    """A map column from index to name or name to index: rows (idx, label), by number. If all keys are digits they are the indices, else if all values are; anything else raises when read."""
    digits = lambda c: F.forall(c, lambda x: F.coalesce(x.cast("string").rlike("^[0-9]+$"), F.lit(False)))
    pairs = F.map_entries(entries)
    by_key = F.transform(pairs, lambda e: F.struct(e["key"].cast("string").alias("i"), e["value"].cast("string").alias("label")))
    by_value = F.transform(pairs, lambda e: F.struct(e["value"].cast("string").alias("i"), e["key"].cast("string").alias("label")))
    rows = F.when(digits(F.map_keys(entries)), by_key).when(digits(F.map_values(entries)), by_value).otherwise(F.raise_error(F.lit("neither keys nor values are indices")).cast("array<struct<i:string,label:string>>"))
    others = [c for c in df.columns if c != entries]
    return df.select(*others, F.inline(rows)).select(*others, F.col("i").cast("int").alias("idx"), "label")


def encode_labels(df: DataFrame, vocab: DataFrame, label: str = "label") -> DataFrame:
    """df with idx; null for a label that the vocabulary lacks."""
    codes = small(vocab.select(F.col("label").alias("_label"), F.col("idx")))
    return df.join(codes, F.col(label) == F.col("_label"), "left").drop("_label")


def remap_indices(preds: DataFrame, from_vocab: DataFrame, to_vocab: DataFrame, column: str = "y_true") -> DataFrame:
    """preds with `column` moved from one vocabulary's index to the other's by class name.

    Applied only if both have the same names (in whatever order); else, or for an index
    without a name, the index stays. remapped says whether the vocabularies agreed.
    """
    a, b = from_vocab.select(F.col("idx").alias("_from"), F.col("label").alias("_name")), to_vocab.select(F.col("idx").alias("_to"), F.col("label").alias("_name2"))
    same = a.join(b, F.col("_name") == F.col("_name2"), "full_outer").agg((F.count_if(F.col("_name").isNull() | F.col("_name2").isNull()) == 0).alias("remapped"))
    moves = small(a.join(b, F.col("_name") == F.col("_name2")).select("_from", "_to"))
    out = preds.join(moves, F.col(column) == F.col("_from"), "left").crossJoin(F.broadcast(same))
    return out.withColumn(column, F.when(F.col("remapped"), F.coalesce(F.col("_to").cast("bigint"), F.col(column))).otherwise(F.col(column))).drop("_from", "_to")


def class_counts(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """(label, n) for each class of the vocabulary, zeros included."""
    counts = df.groupBy("label").agg(F.count("*").alias("n"))
    return vocab.select("label").join(counts, "label", "left").select("label", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def empty_classes(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Classes of the vocabulary without a row."""
    return vocab.select("label").join(df.select("label").distinct(), "label", "left_anti")


def class_distribution(df: DataFrame, by: str) -> DataFrame:
    """(by, label, n, percent of the subset). Only class-sized rows go through the window."""
    counts = df.groupBy(by, "label").agg(F.count("*").alias("n"))
    return counts.withColumn("percent", F.col("n") * F.lit(100.0) / F.sum("n").over(W.partitionBy(by)))


def share(n: Column, of: Column) -> Column:
    """n / of, 0 where of is 0."""
    return F.when(of == 0, F.lit(0.0)).otherwise(n / of)
