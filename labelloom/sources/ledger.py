"""Append-only records: every write is kept as history, and "latest" is a query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import split_dataset_key

#: What a record of each kind must have.
REQUIRED = {"fetch": ("dataset", "dataset_root", "fetched_at_utc"), "mapping": ("classes", "path", "written_at_utc")}
#: A run's stages in order.
STAGES = ("fetch", "split", "resize", "validate", "train", "evaluate")


def append_pointer(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def latest_pointer(history: DataFrame, *order: str) -> DataFrame:
    """The newest row of history(kind, dataset, written_at, ...) for each (kind, owner, slug), by written_at, then order; an unparseable dataset counts as unknown."""
    owner, slug = split_dataset_key("dataset")
    keyed = history.withColumns({"owner": owner, "slug": slug})
    rest = [c for c in keyed.columns if c not in ("kind", "owner", "slug")]
    return keyed.groupBy("kind", "owner", "slug").agg(F.max_by(F.struct(*rest), F.struct("written_at", *order)).alias("r")).select("kind", "owner", "slug", "r.*")


def pointer_violations(kind: str, columns: list[str]) -> Column:
    """Array of what is wrong with a record: missing required values, and num_classes that is not the number of classes. Columns that the table lacks count as missing."""
    value = lambda c: F.col(c) if c in columns else F.lit(None)
    wrong = [F.when(value(c).isNull(), F.lit(f"missing:{c}")) for c in REQUIRED[kind]]
    if kind == "mapping" and {"num_classes", "classes"} <= set(columns):
        wrong.append(F.when(F.col("num_classes") != F.size("classes"), F.lit("num_classes")))
    return F.array_compact(F.array(*wrong))


def validate_pointer(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn("violations", pointer_violations(kind, df.columns))


def training_summary(epochs: DataFrame, counts: DataFrame) -> DataFrame:
    """A record per run of epochs(run_id, epoch, val_f1): best_f1 (6 places), best_epoch, epochs, class list and distribution of counts(label, n)."""
    best = epochs.groupBy("run_id").agg(F.max_by(F.struct("val_f1", "epoch"), F.struct("val_f1", -F.col("epoch"))).alias("b"), F.count("*").alias("epochs"))
    classes = counts.groupBy().agg(F.array_sort(F.collect_list(F.struct("label", "n"))).alias("c"))
    return best.crossJoin(F.broadcast(classes)).select("run_id", F.round("b.val_f1", 6).alias("best_f1"), F.col("b.epoch").alias("best_epoch"), "epochs", F.col("c.label").alias("classes"), F.to_json(F.map_from_entries("c")).alias("class_distribution"))


def append_summary(summary: DataFrame, path: str, dataset: Column | str, written_at: Column, checkpoint: Column | None = None, class_to_idx: Column | None = None) -> None:
    """Add the rows of training_summary() or eval_summary() to the history at path, with the data set, the time, the checkpoint that they are of and the class numbering, null where not given."""
    null = lambda c, t: (F.lit(None) if c is None else c).cast(t)
    dataset = F.lit(dataset) if isinstance(dataset, str) else dataset
    summary.withColumns({"dataset": dataset, "written_at": written_at, "checkpoint": null(checkpoint, "string"), "class_to_idx": null(class_to_idx, "map<string,int>")}).write.mode("append").parquet(path)


def latest_summary(history: DataFrame, *by: str) -> DataFrame:
    """The newest row of each (dataset, by...): by written_at, then checkpoint."""
    keys = ("dataset", *by)
    rest = [c for c in history.columns if c not in keys]
    order = F.struct("written_at", F.coalesce("checkpoint", F.lit("")))
    return history.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def eval_summary(evaluation: DataFrame) -> DataFrame:
    """A record of evaluate()'s row, metrics to 6 places."""
    return evaluation.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in evaluation.dtypes])


def run_ledger(stages: DataFrame) -> DataFrame:
    """stages(run_id, ord, exit_code, duration): a row per run with its stages in order, their total, and the overall code: 0 or that of the first that failed. Later stages of a failed run do not count.

    ord counts from 1 in the order of STAGES; in_order says that a run has each stage from the first up to its last once, and no other.
    """
    first = stages.where("exit_code <> 0").groupBy("run_id").agg(F.min(F.struct("ord", "exit_code")).alias("f"))
    ran = stages.join(first, "run_id", "left").where("f is null or ord <= f.ord")
    out = ran.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("ord", "exit_code", "duration"))).alias("stages"), F.coalesce(F.max("f.exit_code"), F.lit(0)).cast("bigint").alias("code"), F.sum("duration").alias("seconds"))
    right = F.transform("stages", lambda x: x["ord"].cast("bigint")) == F.sequence(F.lit(1).cast("bigint"), F.size("stages").cast("bigint"))
    named = F.transform("stages", lambda x: F.struct(F.get(F.array(*map(F.lit, STAGES)), (x["ord"] - 1).cast("int")).alias("stage"), *[x[c].alias(c) for c in ("ord", "exit_code", "duration")]))
    return out.withColumns({"n_stages": F.size("stages").cast("bigint"), "in_order": right & (F.size("stages") <= len(STAGES))}).withColumn("stages", named)
