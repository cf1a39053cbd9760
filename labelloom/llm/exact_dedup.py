"""Operator 7: exact de-duplication by two-pass Bloom filtering.

Pass 1 hashes every normalised text to PROBES positions of a bit array and counts, with
partial sums, how often each position is hit; positions hit twice or more form the filter.
A text whose positions are all in the filter is possibly repeated. Pass 2 probes every row:
rows that are surely unique pass straight through, the others alone are shuffled, without
their texts, by the SHA-256 of their normalised text, which decides exactly. The filter takes
BITS_PER_ROW bits a row up to MAX_BITS, its proven bound for the broadcast; beyond that more
rows are taken for possible repeats, and the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, joined_by_group, others, packed, quoted, saved, text_of

BITS_PER_ROW = 16
MAX_BITS = 1 << 29
PROBES = 2
#: Bits of one bitmap that Spark's bitmap functions build.
BITMAP = 32768


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", "")


def _positions(key: Column, bits: int) -> list[Column]:
    """PROBES positions from a 64-bit hash."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(PROBES)]


def repeated_filter(keys: DataFrame, rows: int) -> tuple[np.ndarray, int]:
    """keys(key): the positions hit twice or more, as packed bits (at most MAX_BITS / 8 bytes), and their number of bits."""
    bits = BITMAP
    while bits < min(MAX_BITS, BITS_PER_ROW * rows):
        bits *= 2
    hit = keys.select(F.explode(F.array(*_positions(F.col("key"), bits))).alias("p")).groupBy("p").agg(F.count("*").alias("n")).where("n > 1")
    maps = hit.groupBy(F.expr(f"p div {BITMAP}").alias("bucket")).agg(F.expr(f"bitmap_construct_agg(pmod(p, {BITMAP}))").alias("bitmap"))
    packed = np.zeros(bits // 8, np.uint8)
    for r in maps.toLocalIterator():
        at = r["bucket"] * (BITMAP // 8)
        packed[at : at + BITMAP // 8] = np.frombuffer(bytes(r["bitmap"]), np.uint8)
    return packed, bits


def _decided(docs: DataFrame, columns: list[str], narrow: bool) -> tuple[DataFrame, DataFrame]:
    """(alone, again): rows (row, id, key) that are surely unique, and possible repeats with keep_id, group_size and kept beside them.

    narrow: rows are few bytes, and written once with their keys, so that texts are read
    once; otherwise only the possible repeats are written.
    """
    spark: SparkSession = docs.sparkSession
    rows = packed(docs, columns, id=F.col("doc_id"), chars=F.length(text_of()).cast("bigint"), key=F.sha2(normalised(text_of()), 256))
    rows = saved(rows) if narrow else rows
    bits_of, bits = repeated_filter(rows.select("key"), rows.count())
    shared = spark.sparkContext.broadcast(bits_of)

    @F.pandas_udf("boolean")
    def repeated(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        have = shared.value
        for positions in parts:
            yield pd.Series(np.logical_and.reduce([(have[p.to_numpy() >> 3] >> (p.to_numpy() & 7).astype(np.uint8)) & 1 for p in positions]).astype(bool))

    probed = rows.withColumn("maybe", repeated(*_positions(F.col("key"), bits)))
    again = saved(probed.where("maybe").drop("maybe").withColumn("rid", F.monotonically_increasing_id()))
    # the best: most code points, an id before null, smallest id, then any one row
    order = F.struct((-F.col("chars")).alias("chars"), F.col("id").isNull().alias("none"), F.col("id").alias("id"), "rid")
    best = saved(again.groupBy("key").agg(F.count("*").alias("group_size"), F.min(order).alias("best")))
    marks = joined_by_group(again.select("rid", "key"), best, "key", "group_size", again.count())
    marks = marks.select("rid", F.col("best.id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept"))
    return probed.where(~F.col("maybe")), again.join(saved(marks), "rid")


def exact_dedup(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Every row of docs(doc_id, text, ...) with keep_id, group_size, kept and text_sha256.

    Of rows whose texts are identical without ASCII white space, the one with the most code
    points, then the smallest doc_id (null last) stays; of rows equal in both, one stays.
    carry: the columns to return, all by default; those named like the four new ones, in
    whatever case, are replaced. Null text counts as empty, so empty, blank and null texts are
    one group. An empty table gives an empty table. No group is gathered: the best row of each
    is a minimum with partial sums, and goes back to narrow rows, large groups by broadcast.
    """
    alone, again = _decided(docs, others(docs if carry is None else docs.select(*map(quoted, carry)), "keep_id", "group_size", "kept", "text_sha256"), carry is not None)
    alone = alone.select("row.*", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), F.col("key").alias("text_sha256"))
    return alone.unionByName(again.select("row.*", "keep_id", "group_size", "kept", F.col("key").alias("text_sha256")))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """docs with the row that stays of each group of equal texts, as in exact_dedup(). All columns are kept as they are, whatever their names."""
    alone, again = _decided(docs, docs.columns, False)
    return alone.select("row.*").unionByName(again.where("kept").select("row.*"))
