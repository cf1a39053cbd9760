"""Operator 3: chat formatting of preferences.

The longest common turn prefix of the chosen and the rejected conversation is rendered once,
as the prompt; the turns after it are the two completions. Only what the assistant says
there is trained on: masks are spans of code points in each completion. DataFrame functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands before and after a turn's text.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n<|end|>\n"
TRAINED = "assistant"
_TURN = "array<struct<turn:bigint,role:string,text:string>>"


def turns(rows: DataFrame, key: str) -> DataFrame:
    """rows(key, turn, role, text): one array of turns a conversation, by turn, then role, then text. Null role and text are empty."""
    one = F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("turns"))


def _same(a: Column, b: Column) -> Column:
    return a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]) & (a.isNull() == b.isNull())


def common_turns(a: str, b: str) -> Column:
    """How many turns the arrays of columns a and b share from the first on."""
    same = F.zip_with(a, b, _same)
    return F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(same).cast("bigint"))


def _rendered(t: Column) -> Column:
    return F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))


def _masks(col: str) -> Column:
    """Spans "start:end" of trained text and its end mark in the rendered turns of array column col, comma-joined."""
    head = lambda t: F.length(F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE)))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    step = lambda a, t: F.struct((a["at"] + F.length(_rendered(t))).cast("bigint").alias("at"), F.when(t["role"] == TRAINED, F.concat(a["out"], F.when(a["out"] == "", "").otherwise(","), (a["at"] + head(t)).cast("string"), F.lit(":"), (a["at"] + F.length(_rendered(t))).cast("string"))).otherwise(a["out"]).alias("out"))
    return F.aggregate(col, zero, step)["out"]


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """chosen, rejected (key, turn, role, text): a row for each key that both have.

    n_prompt turns are shared; prompt, chosen and rejected are rendered; chosen_mask and
    rejected_mask say what of the completions is trained on. Turns are compared by their
    place in order, so gaps in numbers do not matter and repeated turns each count. If one
    conversation is the beginning of the other, its completion is empty; equal ones have both
    empty. A null key, or a key that one side lacks, gives no row. A conversation is a row.
    """
    a, b = turns(chosen, key).withColumnRenamed("turns", "a"), turns(rejected, key).withColumnRenamed("turns", "b")
    x = a.join(b, key).withColumn("n_prompt", common_turns("a", "b"))
    rest = lambda c: F.slice(c, (F.col("n_prompt") + 1).cast("int"), F.greatest(F.size(c), F.lit(1)))
    x = x.withColumns({"p": F.slice("a", F.lit(1), F.col("n_prompt").cast("int")), "a": rest("a"), "b": rest("b")})
    text = lambda c: F.array_join(F.transform(c, _rendered), "")
    return x.select(key, "n_prompt", text("p").alias("prompt"), text("a").alias("chosen"), text("b").alias("rejected"), _masks("a").alias("chosen_mask"), _masks("b").alias("rejected_mask"))


def stale_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From conversations(conv_id, turn, role, text), a preference: each conversation up to its last assistant turn, and the same with that turn answered as the assistant did the time before (the first time: not at all).

    Of repeated rows of a turn the largest (role, text) counts.
    """
    x = conversations.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.max(F.struct("role", "text")).alias("m")).select("conv_id", "turn", "m.role", "m.text")
    ours = F.col("role") == TRAINED
    last = x.where(ours).groupBy("conv_id").agg(F.max("turn").alias("last"))
    x = x.join(last, "conv_id").where("turn <= last")
    before = x.where(ours & (F.col("turn") < F.col("last"))).groupBy("conv_id").agg(F.max_by(F.struct("text"), "turn").alias("old"))
    swapped = x.join(before, "conv_id", "left").select("conv_id", "turn", "role", F.when(F.col("turn") < F.col("last"), F.col("text")).otherwise(F.coalesce(F.col("old.text"), F.lit(""))).alias("text"))
    return x.select("conv_id", "turn", "role", "text"), swapped
