"""Analytics over training runs, many short ones or few long ones: order within a run is worked on in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scan import before, blocked, kept, placed, with_first, with_values
from ..plans.scratch import saved, small


def best_epoch(epochs: DataFrame) -> DataFrame:
    """(run_id, best_epoch, best_f1): the highest val_f1 of epochs(run_id, epoch, val_f1), the earliest of equal ones. Null metrics never win."""
    x = epochs.where("val_f1 is not null").groupBy("run_id").agg(F.max_by(F.struct("epoch", "val_f1"), F.struct("val_f1", -F.col("epoch"))).alias("b"))
    return x.select("run_id", F.col("b.epoch").alias("best_epoch"), F.col("b.val_f1").alias("best_f1"))


def _placed(epochs: DataFrame) -> tuple[DataFrame, int]:
    """epochs with _at, their place by run and epoch, and its bound."""
    return placed(epochs, ["run_id"], "epoch", name="_at")


def _chain(values: np.ndarray, delta: float) -> tuple[np.ndarray, np.ndarray]:
    """For each of a run's ascending records, which of them is the next gain after it, and the value of the last gain from it on."""
    after, last = np.searchsorted(values, values + delta, "right"), values.copy()
    for j in range(len(values) - 1, -1, -1):
        if after[j] < len(values):
            last[j] = last[after[j]]
    return after, last


def _gains(records: DataFrame, delta: float) -> DataFrame:
    """(_g, _at) of the records (run_id, _at, m, _top) that are gains: above the gain before them by more than delta > 0.

    What a block does to the best value so far is a step function: it begins a chain at the
    first record above best + delta. As best lies within delta below the highest value before
    the block, only the records up to the first that is more than delta above it can begin
    one. Blocks give these and where their chains end, a run's blocks are gone through in order,
    and each block marks its chain from the best value that it is entered with.
    """
    ordered = F.array_sort(F.collect_list(F.struct("_at", "m", "_top")))
    part = lambda c: F.transform("rs", lambda r: r[c])
    blocks = blocked(records, ["run_id"], "_at").groupBy("_g", "_block").agg(ordered.alias("rs")).select("_g", "_block", part("_at").alias("at"), part("m").alias("m"), F.coalesce(F.element_at("rs", 1)["_top"], F.lit(float("-inf"))).alias("top"))
    blocks = saved(blocks)
    group = blocks.schema["_g"].dataType.simpleString()

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            begins, ends = [], []
            for m, top in zip(b.column("m").to_pylist(), b.column("top").to_pylist()):
                m = np.array(m)
                n = int(np.searchsorted(m, top + delta, "right")) + 1
                begins.append(m[:n])
                ends.append(_chain(m, delta)[1][:n])
            yield pa.RecordBatch.from_arrays([b.column("_g"), b.column("_block"), pa.array(begins, pa.list_(pa.float64())), pa.array(ends, pa.list_(pa.float64()))], ["_g", "_block", "begins", "ends"])

    def entered(t: pa.Table) -> pa.Table:
        t = t.sort_by("_block")
        best, out = float("-inf"), []
        for begins, ends in zip(t["begins"].to_pylist(), t["ends"].to_pylist()):
            out.append(best)
            j = int(np.searchsorted(begins, best + delta, "right"))
            best = ends[j] if j < len(ends) else best
        return pa.table({"_g": t["_g"], "_block": t["_block"], "best": pa.array(out, pa.float64())})

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, of = [], []
            for i, (at, m, best) in enumerate(zip(*[b.column(c).to_pylist() for c in ("at", "m", "best")])):
                m = np.array(m)
                after, _ = _chain(m, delta)
                j = int(np.searchsorted(m, best + delta, "right"))
                while j < len(m):
                    out.append(at[j])
                    of.append(i)
                    j = int(after[j])
            yield pa.RecordBatch.from_arrays([b.column("_g").take(pa.array(of, pa.int64())), pa.array(out, pa.int64())], ["_g", "_at"])

    summaries = blocks.select("_g", "_block", "m", "top").mapInArrow(steps, f"_g {group}, _block bigint, begins array<double>, ends array<double>")
    bests = summaries.groupBy("_g").applyInArrow(entered, f"_g {group}, _block bigint, best double")
    return blocks.join(bests, ["_g", "_block"]).select("_g", "at", "m", "best").mapInArrow(marked, f"_g {group}, _at bigint")


def _stops(epochs: DataFrame, span: int, patience: int, min_delta: float, monitor: str) -> DataFrame:
    """(run_id, stop_epoch, _stop_at) of each run of _placed() epochs."""
    low, m = F.lit(float("-inf")), F.col(monitor).cast("double")
    x = epochs.select("run_id", "epoch", "_at", F.when(F.isnan(m), low).otherwise(F.coalesce(m, low)).alias("m"))
    x = before(x, ["run_id"], "_at", "m", "max", "_top", span).withColumn("gain", F.col("m") > F.coalesce("_top", low))
    x = kept(x, span)
    if min_delta > 0:
        chosen = _gains(x.where("gain").select("run_id", "_at", "m", "_top"), float(min_delta)).withColumn("_chosen", F.lit(True))
        x = x.withColumn("_g", F.struct("run_id")).join(chosen, ["_g", "_at"], "left").withColumn("gain", F.col("_chosen").isNotNull()).drop("_chosen", "_g")
    x = kept(with_first(x.drop("_top").withColumn("_won", F.when(F.col("gain"), F.col("_at"))), ["run_id"], "_at", "_first", span), span)
    x = before(x, ["run_id"], "_at", "_won", "max", "_last", span)
    bad = F.col("_at") - F.coalesce("_last", F.col("_first") - 1)
    over = F.when(~F.col("gain") & (bad >= patience), F.col("_at"))
    return x.groupBy("run_id").agg(F.min_by(F.col("epoch").cast("bigint"), over).alias("stop_epoch"), F.min(over).alias("_stop_at"))


def early_stop(epochs: DataFrame, patience: int = 5, min_delta: float = 0.0, monitor: str = "val_f1", enabled: bool = True) -> DataFrame:
    """(run_id, stop_epoch): the first epoch with `patience` epochs without a gain over best + min_delta; null if there is none or stopping is off.

    A missing metric counts as the lowest, so does one that is not a number. A run may have any
    share of all epochs: where one is large, gains are found from running maxima over blocks of epochs, with
    min_delta > 0 from chains of records, and the epochs since the last gain from running
    maxima of places. Where min_delta is negative the best value may fall, and a run is folded as a whole.
    """
    if not enabled:
        return epochs.select("run_id").distinct().withColumn("stop_epoch", F.lit(None).cast("bigint"))
    if min_delta < 0:
        return _folded(epochs, patience, min_delta, monitor)
    return _stops(*_placed(epochs.select("run_id", "epoch", monitor)), patience, min_delta, monitor).drop("_stop_at")


def _folded(epochs: DataFrame, patience: int, min_delta: float, monitor: str) -> DataFrame:
    """early_stop() by one fold a run, in order."""
    low, m = F.lit(float("-inf")), F.col(monitor).cast("double")
    rows = epochs.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("epoch", F.when(F.isnan(m), low).otherwise(F.coalesce(m, low)).alias("m")))).alias("es"))
    start = F.struct(low.alias("best"), F.lit(0).alias("bad"), F.lit(None).cast("bigint").alias("stop"))

    def step(a, e):
        gain = e["m"] > a["best"] + F.lit(float(min_delta))
        bad = F.when(gain, 0).otherwise(a["bad"] + 1)
        stop = F.coalesce(a["stop"], F.when(~gain & (bad >= patience), e["epoch"].cast("bigint")))
        return F.struct(F.when(gain, e["m"]).otherwise(a["best"]).alias("best"), bad.cast("int").alias("bad"), stop.alias("stop"))

    return rows.select("run_id", F.aggregate("es", start, step)["stop"].alias("stop_epoch"))


def effective_epochs(epochs: DataFrame, patience: int = 5, min_delta: float = 0.0, monitor: str = "val_f1", enabled: bool = True) -> DataFrame:
    """The epochs that ran: up to the stop, where there is one."""
    if not enabled:
        return epochs
    x, span = _placed(epochs)
    if min_delta < 0:
        stops = x.join(small(_folded(x, patience, min_delta, monitor)), "run_id").where("epoch = stop_epoch").groupBy("run_id").agg(F.min("_at").alias("_stop_at"))
    else:
        stops = _stops(x, span, patience, min_delta, monitor).drop("stop_epoch")
    return with_values(x, ["run_id"], "_at", stops, span).where("_stop_at is null or _at <= _stop_at").select(epochs.columns)


def checkpoint_plan(epochs: DataFrame, save_best: bool = True, save_last: bool = True, every_n: int = 0) -> DataFrame:
    """(run_id, epoch, kind, name): best where val_f1 is above all before it, last at each epoch, periodic at each multiple of every_n. Running maxima are taken over blocks of epochs, then over blocks."""
    x, span = _placed(epochs.select("run_id", "epoch", "val_f1"))
    x = before(x, ["run_id"], "_at", "val_f1", "max", "_top", span)
    best = F.coalesce(F.col("val_f1") > F.coalesce("_top", F.lit(float("-inf"))), F.lit(False)) & F.lit(save_best)
    epoch = F.col("epoch").cast("string")
    kinds = [
        F.when(best, F.struct(F.lit("best").alias("kind"), F.concat(F.lit("best_valF1_"), F.format_string("%.4f", "val_f1"), F.lit("_epoch"), epoch).alias("name"))),
        F.when(F.lit(save_last), F.struct(F.lit("last").alias("kind"), F.lit("last").alias("name"))),
        F.when((F.lit(every_n) > 0) & (F.pmod("epoch", F.lit(max(every_n, 1))) == 0), F.struct(F.lit("periodic").alias("kind"), F.concat(F.lit("epoch"), epoch).alias("name"))),
    ]
    return x.select("run_id", "epoch", F.inline(F.array_compact(F.array(*kinds))))


def lr_history(epochs: DataFrame, lr0: float = 1e-3, step: int = 10, gamma: float = 0.1) -> DataFrame:
    """(run_id, epoch, lr): lr0 * gamma ** floor((epoch - 1) / step), the rate at the epoch's start."""
    return epochs.select("run_id", "epoch", (F.lit(lr0) * F.pow(F.lit(gamma), F.floor((F.col("epoch") - 1) / step).cast("double"))).alias("lr"))


def epoch_loss(batches: DataFrame, *by: str) -> DataFrame:
    """train_loss: the mean of batch losses(loss, n), weighted by the batches' sizes."""
    return batches.groupBy(*by).agg((F.sum(F.col("loss") * F.col("n")) / F.nullif(F.sum("n"), F.lit(0))).alias("train_loss"))
