"""What several operators share: word shingles, samples, connected components, and the library's scratch tables."""

from __future__ import annotations

from itertools import accumulate

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.scratch import discard, remove_path, saved, scratch_dir  # noqa: F401

#: ASCII white space, as a class for Java's and DuckDB's regular expressions.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: No table above this many bytes is broadcast, by a count made beforehand.
BROADCAST_BYTES = 64 << 20
#: The most groups that joined_by_group() broadcasts.
MOST_HOT = 10_000


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str | Column = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, *new: str) -> list[str]:
    """The columns of df whose names are not among new, in whatever case: names that Spark could not tell apart."""
    taken = {n.lower() for n in new}
    return [c for c in df.columns if c.lower() not in taken]


def packed(df: DataFrame, columns: list[str] | None = None, **more: Column) -> DataFrame:
    """One column `row`, a struct of df's columns (all by default), and more columns beside it. Work on the latter cannot meet names of the caller's; select("row.*") gives them back as they were."""
    return df.select(F.struct(*[quoted(c) for c in (df.columns if columns is None else columns)]).alias("row"), *[c.alias(name) for name, c in more.items()])


def with_types(df: DataFrame, more: str) -> StructType:
    """The schema of df with more columns, as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def joined_by_group(rows: DataFrame, groups: DataFrame, key: str, size: str, count: int) -> DataFrame:
    """rows(key, ...), `count` of them, with the columns of groups(key, size, ...), one row a key, inner. Both are read several times, so they should be saved.

    Groups of more than count / MOST_HOT rows, at most MOST_HOT of them, are broadcast; so a
    key that is shuffled has few rows, and no task gets a hot group.
    """
    bound = count // MOST_HOT + 1
    hot = groups.where(F.col(size) > bound)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(groups.where(F.col(size) <= bound), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def sampled(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` rows of df, those with the smallest hash of key.

    Where there are many more, only rows below a hash that about twice as many reach are
    sorted, so that what a task sends on does not grow with the number of tasks.
    """
    rows = df.count()
    h = F.xxhash64(key)
    if rows > 4 * most:
        df = df.where(h < F.lit(-(1 << 63) + int(2.0**64 * (2 * most + 64) / rows)))
    return df.orderBy(h, key).limit(most)


def words(text: str | None) -> list[bytes]:
    """UTF-8 words between ASCII white space, A-Z in lower case; both as bytes methods define them."""
    return (text or "").encode().lower().split()


def shingles(ws: list[bytes], k: int) -> list[bytes]:
    """Runs of k words joined by spaces, repeats included; fewer words give the whole sequence, none gives nothing."""
    if not ws:
        return []
    joined = b" ".join(ws)
    if len(ws) <= k:
        return [joined]
    ends = list(accumulate(len(w) + 1 for w in ws))
    return [joined[s : e - 1] for s, e in zip([0, *ends], ends[k - 1 :])]


def shingle_hashes(ws: list[bytes], k: int, seed: int = 42) -> list[int]:
    """XXH64 of each shingle, unsigned."""
    h = xxhash.xxh64_intdigest
    return [h(x, seed) for x in shingles(ws, k)]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a long, b long): rows (node, root), root the smallest node reachable.

    Alternates large-star and small-star steps, each a minimum per node (combined before
    the shuffle) joined back to the edges; no neighbour list is ever collected, and rounds
    grow with the logarithm of a component's size. Every round is written to the shared
    folder. Nodes without an edge do not appear. Self loops and repeated edges are allowed.
    """
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = saved(small.distinct())
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
