"""Pooling, de-duplication, splitting, sampling, ordering and batching of labelled files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.hashing import key_hash
from ..plans.scan import before, placed, with_first, with_values, written
from ..plans.select import numbered, within_quota


def pool(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both."""
    return a.unionByName(b)


def dedupe_paths(df: DataFrame) -> DataFrame:
    """One row for each (label, path); contents are not compared."""
    return df.dropDuplicates(["label", "path"])


def test_quotas(df: DataFrame, frac: float) -> DataFrame:
    """(label, quota): at least one of each class, else n * frac in doubles, cut off."""
    return df.groupBy("label").agg(F.greatest(F.lit(1).cast("bigint"), F.floor(F.count("*").cast("double") * F.lit(float(frac)))).alias("quota"))


def stratified_split(df: DataFrame, frac: float, seed: int = 42, key: str = "path") -> DataFrame:
    """df(label, path, ...) with split: test for max(1, int(n * frac)) of each class's n rows, in the order of their hash, else train. A class of one is test only."""
    return within_quota(df, "label", test_quotas(df, frac), key_hash(seed, key), key, flag="_test").withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def val_quotas(df: DataFrame, frac: float) -> DataFrame:
    """(label, quota) of training rows for a stratified split with global sizes: n_val = ceil(frac * N), the rest is for training, dealt to the classes by largest remainder; ties go by label.

    It is an error, raised when rows are read, if a class has fewer than two members or a side fewer rows than there are classes.
    """
    counts = df.groupBy("label").agg(F.count("*").alias("n"))
    all_ = W.partitionBy(F.lit(1))
    x = counts.withColumns({"total": F.sum("n").over(all_), "classes": F.count("*").over(all_), "least": F.min("n").over(all_)})
    x = x.withColumn("n_val", F.ceil(F.lit(float(frac)) * F.col("total"))).withColumn("n_train", F.col("total") - F.col("n_val"))
    fault = F.when(F.col("least") < 2, "a class has fewer than two members").when(F.least("n_val", "n_train") < F.col("classes"), "a side is smaller than the number of classes")
    # whole shares, then the remainders in integers: exact at any size
    x = x.withColumns({"base": F.expr("(n * n_train) div total"), "rest": F.expr("(n * n_train) % total")})
    x = x.withColumn("over", F.col("n_train") - F.sum("base").over(all_)).withColumn("place", F.row_number().over(all_.orderBy(F.desc("rest"), "label")))
    quota = F.col("base") + F.when(F.col("place") <= F.col("over"), 1).otherwise(0)
    return x.select("label", F.when(fault.isNull(), quota).otherwise(F.raise_error(fault).cast("bigint")).alias("quota"))


def stratified_val_split(df: DataFrame, frac: float, seed: int = 42, key: str = "path") -> DataFrame:
    """df with split: train for the quota of each class in the order of their hash, else val."""
    return within_quota(df, "label", val_quotas(df, frac), key_hash(seed, key), key, flag="_train").withColumn("split", F.when(F.col("_train"), "train").otherwise("val")).drop("_train")


#: Fixed value: a numbered name: its stem, its number without leading zeros, and its extension.
_NUMBERED = r"^(.+)__([1-9][0-9]{0,17})(\.[^.]*|)$"


def _free_numbers(df: DataFrame, natural: DataFrame, name: list[str], at: str, k: str, span: int) -> DataFrame:
    """df with _free: the k-th number that natural(split, label, name) leaves free for the row's stem and extension.

    The i-th taken number b, in order, is passed over by all k of b - i + 1 or more. So taken
    numbers are counted by the k at which they begin to matter, which meets one row a name and
    k, and running sums over a name's rows say how many come before each.
    """
    folder = ["split", "label"]
    part = lambda i: F.regexp_extract("name", _NUMBERED, i)
    taken = natural.where(F.col("name").rlike(_NUMBERED)).select(*folder, F.concat(part(1), part(3)).alias("name"), part(2).cast("bigint").alias("_b"))
    taken, places = placed(taken, name, "_b", name="_p")
    taken = with_first(taken, name, "_p", "_first", places)
    begins = taken.groupBy(*name, (F.col("_b") - (F.col("_p") - F.col("_first"))).alias(k)).agg(F.count("*").alias("_begin"))
    x = before(df.join(begins, [*name, k], "left"), name, at, "_begin", "sum", "_passed", span)
    return x.withColumn("_free", F.col(k) + F.coalesce("_passed", F.lit(0)) + F.coalesce("_begin", F.lit(0))).drop("_begin", "_passed")


def assign_unique_names(df: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """df(split, label, name, path) with dest_name: no two of a folder (split, label) are the same.

    By path, the first row of a name keeps it; the others take stem__1.ext, stem__2.ext, ...,
    leaving out numbers whose name is a natural name of the folder or in taken(split, label,
    name); a name that is itself taken is not kept by anyone. What is to be known of a name, which may be any share of a folder's, comes to them by
    blocks. Split, label, name and path are not null.
    """
    name = ["split", "label", "name"]
    # a row's place among its name's: where a name is very frequent, its position in one sorted table, less the first one's
    df, span = placed(df, name, "path", name="_at")
    df = written(df, span)
    natural = df.select(*name).distinct()
    if taken is not None:
        natural = natural.unionByName(taken.select(*name)).distinct()
    first = df.groupBy(*name).agg(F.min("_at").alias("_first")).withColumn("_keeps", F.lit(1))
    if taken is not None:
        first = first.join(taken.select(*name).distinct().withColumn("_taken", F.lit(1)), name, "left").withColumn("_keeps", F.when(F.col("_taken").isNull(), 1).otherwise(0)).drop("_taken")
    df = with_values(df, name, "_at", first, span)
    df = df.withColumn("_extra", (F.col("_at") - F.col("_first") + 1 - F.col("_keeps")).cast("bigint"))  # 0: keeps its name
    x = _free_numbers(df, natural, name, "_at", "_extra", span)
    stem, ext = F.regexp_replace("name", r"(?<=.)\.[^.]+$", ""), F.regexp_extract("name", r"^.+?(\.[^.]+)$", 1)
    dest = F.when(F.col("_extra") == 0, F.col("name")).otherwise(F.concat(stem, F.lit("__"), F.col("_free").cast("string"), ext))
    return x.withColumn("dest_name", dest).drop("_extra", "_free", "_at", "_first", "_keeps")


def split_summary(df: DataFrame) -> DataFrame:
    """(label, n_train, n_test)."""
    return df.groupBy("label").agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))


def sample_per_class(df: DataFrame, k: int, seed: int = 42, key: str = "path") -> DataFrame:
    """min(k, n) rows of each class, the first by their hash."""
    quotas = df.select("label").distinct().withColumn("quota", F.lit(k).cast("bigint"))
    return within_quota(df, "label", quotas, key_hash(seed, key), key).where("selected").drop("selected")


def round_robin_sample(df: DataFrame, n: int, seed: int = 42, key: str = "path") -> DataFrame:
    """n rows, one class after the other in the order of labels, with turn (from 1); classes that have no more rows are passed over. All rows if there are fewer than n."""
    picked = sample_per_class(df, n, seed, key)  # at most n of each class
    turn = F.row_number().over(W.partitionBy("label").orderBy(key_hash(seed, key), key)).cast("bigint")
    return picked.withColumn("turn", turn).orderBy("turn", "label").limit(n)


def epoch_shuffle(df: DataFrame, seed: int = 42, epoch: int = 0, key: str = "path", train: bool = True) -> DataFrame:
    """Rows in the order of a hash of seed, epoch and key, another one each epoch; for evaluation in the order of the key."""
    return df.withColumn("order_hash", key_hash(f"{seed}:{epoch}", key)).orderBy("order_hash", key) if train else df.withColumn("order_hash", F.lit("")).orderBy(key)


def assign_batches(df: DataFrame, batch_size: int, seed: int = 42, epoch: int = 0, key: str = "path") -> DataFrame:
    """df with position (from 0, in the epoch's order) and batch_id; the last batch may be short."""
    placed = numbered(df.withColumn("order_hash", key_hash(f"{seed}:{epoch}", key)), "order_hash", key)
    return placed.drop("order_hash").withColumn("batch_id", F.expr(f"position div {batch_size}"))

