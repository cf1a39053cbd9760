"""Running aggregates, places and lookups within groups of any size: where groups are large, over blocks of rows, then over blocks of blocks, so that no task gets a whole group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import saved
from .select import numbered

#: Positions of a block: what one task sorts, or gets by one key, at most.
BLOCK = 1 << 16


def blocked(df: DataFrame, groups: list[str], at: str) -> DataFrame:
    """df with _g, the group as a struct, in which nulls equal each other, and _block, BLOCK positions each."""
    return df.withColumns({"_g": F.struct(*groups), "_block": F.expr(f"`{at}` div {BLOCK}")})


def placed(df: DataFrame, groups: list[str], *order: str, name: str) -> tuple[DataFrame, int]:
    """df with a place, and the bound that places are below.

    Where a count shows that no group has more than BLOCK rows, it is the place within the
    group, and everything else may be done by group; else it is the place in one sorted and
    written table, and groups are worked on in blocks. The bound tells which: it is at most
    BLOCK in the first case only.
    """
    largest = df.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
    if largest <= BLOCK:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*groups).orderBy(*order)).cast("bigint") - 1), largest
    x = numbered(df, *groups, *order, name=name)
    return x, x.count()


def _sum(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


_KINDS: dict[str, tuple[Callable, Callable]] = {"max": (F.max, F.greatest), "sum": (F.sum, _sum)}


def _before(df: DataFrame, at: str, name: str, value: str, kind: str, span: int) -> DataFrame:
    """df(_g, at, value) with name; span: positions are below it."""
    total, both = _KINDS[kind]
    if span <= BLOCK:
        return df.withColumn(name, total(value).over(W.partitionBy("_g").orderBy(at).rowsBetween(W.unboundedPreceding, -1)))
    block, ahead = f"{at}_block", f"{name}_ahead"
    df = df.withColumn(block, F.expr(f"`{at}` div {BLOCK}"))
    sums = _before(df.groupBy("_g", block).agg(total(value).alias("_total")), block, ahead, "_total", kind, span // BLOCK + 1).select("_g", block, ahead)
    own = total(value).over(W.partitionBy("_g", block).orderBy(at).rowsBetween(W.unboundedPreceding, -1))
    return df.withColumn(name, own).join(sums, ["_g", block]).withColumn(name, both(F.col(name), F.col(ahead))).drop(block, ahead)


def before(df: DataFrame, groups: list[str], at: str, value: str, kind: str, name: str, span: int) -> DataFrame:
    """df with name: the max or sum of value over the group's rows of smaller `at`; null (for sums perhaps 0) where there is none.

    at, span: as placed() gives them. df is read once a level. Each level works on BLOCK positions a task and hands on a row
    for each of them, as many levels as it takes until all positions are one block.
    """
    return _before(df.withColumn("_g", F.struct(*groups)), at, name, value, kind, span).drop("_g")


def with_values(df: DataFrame, groups: list[str], at: str, values: DataFrame, span: int) -> DataFrame:
    """df with the other columns of values(groups..., ...), one row a group; null where a group has none. Values are joined to blocks, and blocks to rows, so that no key has more than BLOCK rows; to rows at once where groups have no more."""
    values = values.select(F.struct(*groups).alias("_g"), *[c for c in values.columns if c not in groups])
    if span <= BLOCK:
        return df.withColumn("_g", F.struct(*groups)).join(values, "_g", "left").drop("_g")
    df = blocked(df, groups, at)
    return df.join(df.select("_g", "_block").distinct().join(values, "_g"), ["_g", "_block"], "left").drop("_g", "_block")


def with_first(df: DataFrame, groups: list[str], at: str, name: str, span: int) -> DataFrame:
    """df, from placed(), with the smallest `at` of each row's group."""
    if span <= BLOCK:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    return with_values(df, groups, at, df.groupBy(*groups).agg(F.min(at).alias(name)), span)


def written(df: DataFrame, span: int) -> DataFrame:
    """df from placed(), written if it is not already."""
    return df if span > BLOCK else saved(df)


def kept(df: DataFrame, span: int) -> DataFrame:
    """df, written where groups are worked on in blocks, and so read several times."""
    return saved(df) if span > BLOCK else df


def left_join_by_group(df: DataFrame, groups: DataFrame, key: str, size: str, spread: Column, most: int = 10_000) -> DataFrame:
    """df with the other columns of groups(key, size, ...), one row a key that is not null, each with the number of df's rows; left.

    groups is read several times, so it should be saved. Groups of more than the `most`-th part
    of all grouped rows, of which there are at most `most`, are broadcast, and their rows go to the
    shuffled join of the others under a key of their own, by the hash of spread.
    """
    bound = (groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] // most) + 1
    rest = [c for c in groups.columns if c != key]
    hot = F.broadcast(groups.where(F.col(size) > bound).select(F.col(key).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in rest]))
    cold = groups.where(F.col(size) <= bound).select(F.struct(F.col(key), F.lit(None).cast("bigint").alias("own")).alias("_key"), *[F.col(c).alias(f"_cold_{c}") for c in rest])
    df = df.join(hot, F.col(key) == F.col("_hot"), "left")
    own = F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), F.xxhash64(spread))
    df = df.withColumn("_key", F.struct(F.when(own.isNull(), F.col(key)).alias(key), own.alias("own"))).join(cold, "_key", "left")
    return df.withColumns({c: F.coalesce(f"_hot_{c}", f"_cold_{c}") for c in rest}).drop("_hot", "_key", *[f"{p}{c}" for p in ("_hot_", "_cold_") for c in rest])
