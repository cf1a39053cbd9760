"""Operator 1: mixing sources to target weights by a multivariate hypergeometric splitting tree.

1. Targets: source weights are shared out over all sizes, stopped at MOST times a source.
2. Blocks: each source is cut into blocks of documents by hash, some BLOCK_WORDS words each
   (more where that would make over MAX_BLOCKS blocks). A block's place in its source's
   permuted order is the order of its hash. A source's quota is its whole passes and then
   the first blocks of one more pass, the last of them in part.
3. Tree: the quotas' units are halved again and again until there is a node for each output
   shard. At each node a random half of the units goes left, so what each source sends left
   is multivariate hypergeometric, and both halves are exact in number.
4. Draws: each shard takes, from every source, the next disjoint run of the source's
   permuted blocks, as many as its quota. Documents meet their blocks' draws where they
   are; inside a shard they are ordered by hash.

Only DataFrame functions; windows run over sources, over at most MAX_BLOCKS times MOST
narrow units, or inside one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, others, packed, saved, text_of

WEIGHTS = (5, 2, 1)
#: No document is taken more often than this.
MOST = 3
BLOCK_WORDS, MAX_BLOCKS = 1 << 16, 1 << 14
#: Blocks of a shard, about; there are a power of two of shards.
SHARD_BLOCKS = 16
#: Tables with a row or a few for each source or block are broadcast up to so many sources.
SMALL_SOURCES = 100_000
SEED = 17


def word_count(text: str | Column = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes(source, source_size): with target double.

    Sources by code point, null last, have the weights in turn. Shares above most times
    their source stop there and the excess goes to the others by weight: with sources in
    the order of limit / weight, a source is at its limit if that is below the level which
    the others would reach, sum left / weight left.
    """
    order = W.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    w = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    w = w.withColumn("limit", F.col("source_size") * F.lit(float(most))).withColumn("ratio", F.col("limit") / F.col("w"))
    everything = W.partitionBy(F.lit(1))
    before = everything.orderBy("ratio", F.col("source").isNull(), F.encode("source", "utf-8")).rowsBetween(W.unboundedPreceding, -1)
    w = w.withColumns({"total": F.sum("source_size").over(everything), "all_w": F.sum("w").over(everything), "used": F.coalesce(F.sum("limit").over(before), F.lit(0.0)), "used_w": F.coalesce(F.sum("w").over(before), F.lit(0.0))})
    w = w.withColumn("level", (F.col("total") - F.col("used")) / (F.col("all_w") - F.col("used_w"))).withColumn("free", F.col("level") < F.col("ratio"))
    level = F.min(F.when(F.col("free"), F.struct("ratio", F.col("source").isNull(), F.encode("source", "utf-8").alias("s"), "level"))).over(everything)["level"]
    return w.withColumn("flat", level).select("source", "source_size", F.when(F.col("free"), F.least(F.col("flat") * F.col("w"), F.col("limit"))).otherwise(F.col("limit")).alias("target"))


def _units(plan: DataFrame) -> DataFrame:
    """A row (sid, unit) for each block that a source gives, whole passes and the last one together."""
    return plan.where("quota > 0").select("sid", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("quota") - 1)).alias("unit"))


def splitting_tree(units: DataFrame, levels: int, seed: int = SEED) -> DataFrame:
    """Shard quotas (sid, shard, n, first): halves of the units at each node; first is where the shard's run of the source begins."""
    tree = units.withColumn("shard", F.lit(0))
    for level in range(levels):
        at = W.partitionBy("shard")
        place = F.row_number().over(at.orderBy(F.xxhash64(F.lit(seed), F.lit(level), "sid", "unit"), "sid", "unit"))
        half = F.ceil(F.count("*").over(at) / 2)
        # an odd unit goes to either side by chance
        half = half - F.when((F.count("*").over(at) % 2 == 1) & (F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "shard"), F.lit(2)) == 1), 1).otherwise(0)
        tree = tree.select("sid", "unit", (F.col("shard") * 2 + F.when(place <= half, 0).otherwise(1)).alias("shard"))
    quotas = tree.groupBy("sid", "shard").agg(F.count("*").alias("n"))
    run = W.partitionBy("sid").orderBy("shard")
    return quotas.withColumn("first", F.sum("n").over(run) - F.col("n"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED, shards_log2: int | None = None) -> DataFrame:
    """docs(doc_id, text, source, ...) with size, source_size, target, taken and draws.

    size: words of the whole text, null text 0. draws: array of (shard, pass, words, place),
    one for each copy that the mix takes, to be read in the order of place in its shard;
    taken: the sum of their words. A source's taken is its target rounded to a word: one
    document of a source at most is taken in part, its first words (rows of that document
    that are repeated share what is left evenly, and lose less than a word each). Null is a
    source of its own. Documents without words and sources without words have target or
    taken 0. Repeated rows and null doc_ids each count. There are 2 ** shards_log2 shards, or
    one for each SHARD_BLOCKS blocks or so. Reruns give the same rows, and columns of the new
    names, in whatever case, are replaced. An empty table gives an empty table.

    Texts are read twice and never shuffled: blocks and cuts come from a narrow table, and
    the blocks' draws (at most MAX_BLOCKS and one a source) meet the documents in a broadcast.
    """
    names = others(docs, "size", "source_size", "target", "taken", "draws")
    size, h = word_count(), F.xxhash64(F.lit(seed), "doc_id", text_of())
    narrow = saved(docs.select(F.col("source").alias("src"), size.alias("size"), h.alias("h")))
    sums = saved(narrow.groupBy(F.col("src").alias("source")).agg(F.sum("size").alias("source_size")))
    goal = targets(sums, weights)
    # sid: a number for each source; the block size holds the number of blocks below its bound
    everything = W.partitionBy(F.lit(1))
    plan = goal.withColumn("sid", F.row_number().over(everything.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))))
    plan = plan.withColumn("block_words", F.greatest(F.lit(float(BLOCK_WORDS)), F.sum("source_size").over(everything) / F.lit(MAX_BLOCKS)))
    plan = plan.withColumn("blocks", F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("source_size") / F.col("block_words"))))
    plan = saved(plan.withColumn("goal", F.round("target").cast("bigint")).drop("block_words"))
    sources, blocks = plan.agg(F.count("*"), F.sum("blocks")).first()
    small = F.broadcast if sources <= SMALL_SOURCES else (lambda x: x)
    if shards_log2 is None:
        shards_log2 = max(1, ((blocks or 0) // SHARD_BLOCKS).bit_length())

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(small(plan.select("source", "sid", "blocks", "source_size", "target")), F.col("src").eqNullSafe(F.col("source"))).withColumn("block", F.pmod(F.col("h"), F.col("blocks")))

    # blocks in their permuted order, with the words before each; then what the last pass takes of each
    sizes = placed(narrow).groupBy("sid", "block").agg(F.sum("size").alias("block_size"))
    order = W.partitionBy("sid").orderBy(F.xxhash64(F.lit(seed), "sid", "block"), "block")
    cut = sizes.join(small(plan.select("sid", "source_size", "goal")), "sid").where("block_size > 0").withColumns({"rank": (F.row_number().over(order) - 1).cast("bigint"), "before": F.sum("block_size").over(order) - F.col("block_size"), "n_blocks": F.count("*").over(W.partitionBy("sid"))})
    cut = cut.withColumns({"passes": F.expr("goal div source_size"), "rest": F.expr("goal % source_size")})
    cut = saved(cut.withColumn("last", F.least("block_size", F.greatest(F.lit(0).cast("bigint"), F.col("rest") - F.col("before")))))
    quota = cut.groupBy("sid").agg((F.first("n_blocks") * F.first("passes") + F.count_if(F.col("last") > 0)).alias("quota"))
    quotas = splitting_tree(_units(quota), shards_log2, seed)

    # of a source's block that is taken in part: the hash up to which documents are whole, and the words of the one there
    part = cut.where("last > 0 and last < block_size").select("sid", "block", "last")
    tied = placed(narrow).join(small(part), ["sid", "block"]).groupBy("sid", "last", "h").agg(F.sum("size").alias("words"), F.count("*").alias("times"))
    tied = tied.withColumn("ahead", F.sum("words").over(W.partitionBy("sid").orderBy("h")) - F.col("words"))
    edge = tied.where("ahead < last and last <= ahead + words").select("sid", F.col("h").alias("edge"), F.expr("(last - ahead) div times").alias("edge_words"))

    # a unit is a pass over a ranked block; each shard's run of units is disjoint from the others'
    runs = quotas.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("first", "n", "shard"))).alias("runs"))
    drawn = cut.join(runs, "sid").select("sid", "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("passes"))).alias("pass"), "rank", "n_blocks", "passes", "block_size", "last", "runs")
    drawn = drawn.withColumn("limit", F.when(F.col("pass") < F.col("passes"), F.col("block_size")).otherwise(F.col("last"))).where("limit > 0")
    drawn = drawn.withColumn("unit", F.col("pass") * F.col("n_blocks") + F.col("rank"))
    shard = F.element_at(F.filter("runs", lambda r: (F.col("unit") >= r["first"]) & (F.col("unit") < r["first"] + r["n"])), 1)["shard"]
    draws = drawn.select("sid", "block", F.struct("pass", shard.alias("shard"), (F.col("limit") == F.col("block_size")).alias("whole")).alias("d")).groupBy("sid", "block").agg(F.array_sort(F.collect_list("d")).alias("ds"))
    draws = saved(draws.join(edge, "sid", "left"))

    rows = packed(docs, names, src=F.col("source"), size=size, h=h)
    taken = placed(rows).join(small(draws), ["sid", "block"], "left")
    words = lambda d: F.when(d["whole"] | (F.col("h") < F.col("edge")), F.col("size")).when(F.col("h") == F.col("edge"), F.col("edge_words")).otherwise(F.lit(0).cast("bigint"))
    share = F.transform(F.coalesce("ds", F.array()), lambda d: F.struct(d["shard"].alias("shard"), d["pass"].alias("pass"), words(d).alias("words"), F.xxhash64(F.lit(seed), d["shard"], d["pass"], F.col("h")).alias("place")))
    got = taken.select("row", "size", "source_size", "target", F.filter(share, lambda d: d["words"] > 0).alias("draws"))
    return got.select("row.*", "size", "source_size", "target", F.aggregate("draws", F.lit(0).cast("bigint"), lambda a, d: a + d["words"]).alias("taken"), "draws")
