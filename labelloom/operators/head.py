"""A softmax head over feature vectors: training with gradients summed over partitions, and scoring."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HeadConfig:
    epochs: int = 20
    lr: float = 1e-1
    weight_decay: float = 1e-4
    step: int = 10
    gamma: float = 0.1
    patience: int = 0


#: Partial gradients that one task adds up.
FAN_IN = 16


def _batch(b: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Features, with a constant after them, and classes of rows without nulls: the lists' values, end to end, are one array."""
    x = pc.list_flatten(b.column(0)).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return np.hstack([x, np.ones((len(x), 1))]), b.column(1).to_numpy(zero_copy_only=False)


def _probabilities(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    z = x @ w.T
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def _gradient(df: DataFrame, w: np.ndarray) -> tuple[np.ndarray, float, int]:
    """Sum of gradients, of losses, and the number of rows of df(features, y_true): a row from each partition, FAN_IN of which are added up at a time, in order, until there is one."""
    dim = w.shape[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, loss, n = np.zeros_like(w), 0.0, 0
        for b in batches:
            if b.num_rows:
                x, y = _batch(b, dim)
                p = _probabilities(x, w)
                loss -= np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum()
                p[np.arange(len(y)), y] -= 1
                g += p.T @ x
                n += len(y)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([g.ravel()], pa.list_(pa.float64())), pa.array([loss]), pa.array([n])], ["part", "g", "loss", "n"])

    def add(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        g = np.zeros(w.size)
        for x in t["g"].to_pylist():
            g += x
        return pa.table({"part": [key[0].as_py()], "g": pa.array([g], pa.list_(pa.float64())), "loss": [float(sum(t["loss"].to_pylist()))], "n": [pc.sum(t["n"]).as_py()]})

    schema = "part bigint, g array<double>, loss double, n bigint"
    sums, parts = df.mapInArrow(run, schema), df.rdd.getNumPartitions()
    while True:
        sums, parts = sums.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("part").applyInArrow(add, schema), -(-parts // FAN_IN)
        if parts <= 1:
            r = sums.first()
            return np.array(r["g"]).reshape(w.shape), r["loss"], r["n"]


def confusion_counts(scored: DataFrame) -> list[tuple[int, int, int]]:
    return [(r["y_true"], r["y_pred"], r["count"]) for r in scored.groupBy("y_true", "y_pred").count().collect()]


def macro_f1(counts: list[tuple[int, int, int]]) -> float:
    labels = {c[0] for c in counts} | {c[1] for c in counts}
    f = []
    for k in labels:
        hit = sum(n for t, p, n in counts if t == p == k)
        both = sum(n * ((t == k) + (p == k)) for t, p, n in counts)
        f.append(2 * hit / both if both else 0.0)
    return float(np.mean(f)) if f else 0.0


def fit_softmax_head(train: DataFrame, val: DataFrame, classes: int, cfg: HeadConfig = HeadConfig()) -> tuple[np.ndarray, list[dict]]:
    """Weights (classes x dim + 1) of the epoch with the best validation macro F1, and a record per epoch.

    train, val (features, y_true), rows with nulls left out. One full-batch step an epoch:
    cross entropy, AdamW with decoupled weight decay, step schedule. The plan does not grow:
    weights live on the driver, which gets one row of gradients an epoch.
    """
    train, val = (d.select("features", F.col("y_true").cast("bigint").alias("y_true")).dropna().persist(StorageLevel.MEMORY_AND_DISK) for d in (train, val))
    try:
        return _fit(train, val, classes, cfg)
    finally:
        train.unpersist()
        val.unpersist()


def _fit(train: DataFrame, val: DataFrame, classes: int, cfg: HeadConfig) -> tuple[np.ndarray, list[dict]]:
    first = train.select(F.size("features").alias("d")).first()
    if first is None:
        raise ValueError("there are no training rows")
    w = np.zeros((classes, first["d"] + 1))
    m, v, best, history, bad = np.zeros_like(w), np.zeros_like(w), (-1.0, w), [], 0
    for epoch in range(1, cfg.epochs + 1):
        lr = cfg.lr * cfg.gamma ** ((epoch - 1) // cfg.step)
        g, loss, n = _gradient(train, w)
        g /= n
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w * (1 - lr * cfg.weight_decay) - lr * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-8)
        counts = confusion_counts(score(val, w).select("y_true", (F.array_position("scores", F.array_max("scores")) - 1).alias("y_pred")))
        total, hits = sum(c[2] for c in counts), sum(c[2] for c in counts if c[0] == c[1])
        f1 = macro_f1(counts)
        history.append({"epoch": epoch, "lr": lr, "train_loss": loss / n, "val_acc": hits / total if total else 0.0, "val_f1": f1})
        if f1 > best[0]:
            best, bad = (f1, w), 0
        else:
            bad += 1
            if cfg.patience and bad >= cfg.patience:
                break
    return best[1], history


def score(df: DataFrame, weights: np.ndarray) -> DataFrame:
    """df(features, ...) with scores: weights (classes x dim + 1) times the features and 1; null for null features."""
    shared = df.sparkSession.sparkContext.broadcast(weights)
    keep = [c for c in df.columns if c != "scores"]
    source = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("features").alias("f"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            f, dim = b.column(1), w.shape[1] - 1
            # the values of the lists that are there, end to end, are one array
            x = pc.list_flatten(f).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            flat = pa.array((x @ w[:, :-1].T + w[:, -1]).ravel())
            there = np.asarray(f.is_valid())
            ends = pa.array(np.concatenate([[0], np.cumsum(there)]) * len(w), pa.int32(), mask=np.append(~there, False))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, flat)], ["row", "scores"])

    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, scores array<double>").select("row.*", "scores")
