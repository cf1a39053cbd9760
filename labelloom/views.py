"""What the queries read: corpora, predictions, runs and records derived from the given tables, and the same in SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans.scan import placed, with_first

PIXEL_SIDE = 8


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def v_files(spark: SparkSession, d: str) -> DataFrame:
    """A corpus of files by root and class; names collide and bodies repeat."""
    root = F.when(F.col("doc_id") % 5 == 0, "Testing").otherwise("Training")
    name = F.concat("source", F.lit(".txt"))
    return table(spark, d, "documents").select("doc_id", root.alias("root"), F.col("lang").alias("label"), F.concat_ws("/", root, "lang", F.col("doc_id").cast("string"), name).alias("path"), name.alias("name"), F.octet_length("text").cast("bigint").alias("bytes"), F.sha1("text").alias("digest"))


def v_preds(spark: SparkSession, d: str) -> DataFrame:
    """Scored items of ten classes."""
    x = table(spark, d, "embeddings").select(F.col("vec_id").alias("key"), F.col("label").cast("bigint").alias("y_true"), F.slice("embedding", 1, 10).alias("scores"))
    return x.withColumn("y_pred", (F.array_position("scores", F.array_max("scores")) - 1).cast("bigint"))


def v_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Two-class predictions."""
    return table(spark, d, "labels").select("doc_id", F.col("quality").cast("bigint").alias("y_true"), F.col("toxic").cast("bigint").alias("y_pred"))


def v_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Small one-channel images; some black, white, flat or unreadable."""
    kind = F.col("vec_id") % 50
    flat = lambda v: F.array_repeat(F.lit(v).cast("bigint"), PIXEL_SIDE**2)
    px = F.transform("embedding", lambda x: F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), (x.cast("double") + 0.5) * 255))))
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("key"), F.col("label").cast("bigint").alias("label"), F.when(kind == 0, flat(0)).when(kind == 1, flat(255)).when(kind == 2, flat(128)).when(kind != 3, px).alias("px"))


def v_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Heights and widths of images."""
    lines, parts = table(spark, d, "lineitem"), table(spark, d, "part")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("bigint").alias("line"), (F.col("l_quantity").cast("bigint") * 3).alias("h"), (F.col("p_size").cast("bigint") * 5).alias("w"))


def _numbered(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Events with their place, from 1, among those of their user."""
    x, span = placed(table(spark, d, "events").withColumnRenamed("user_id", "run_id"), ["run_id"], "ts", "event_id", name="_at")
    return with_first(x, ["run_id"], "_at", "_first", span).withColumn(name, F.col("_at") - F.col("_first") + 1).drop("_at", "_first")


def v_epochs(spark: SparkSession, d: str) -> DataFrame:
    """Many training runs."""
    return _numbered(spark, d, "epoch").select("run_id", "epoch", (F.col("value") / 500).alias("val_f1"))


def v_stages(spark: SparkSession, d: str) -> DataFrame:
    """Each six events of a user in turn as the stages of a run, the last run perhaps cut short; the ledger leaves out what follows a failure."""
    at = F.col("n") - 1
    run, ord_ = F.concat_ws("/", F.col("run_id").cast("string"), F.floor(at / 6).cast("string")), (at % 6 + 1).cast("bigint")
    return _numbered(spark, d, "n").select(run.alias("run_id"), ord_.alias("ord"), F.when(F.col("event_type") == "error", 1).otherwise(0).cast("bigint").alias("exit_code"), F.col("value").alias("duration"))


def v_pointers(spark: SparkSession, d: str) -> DataFrame:
    """A history of records; rev breaks ties in time."""
    dataset = F.when(F.col("o_custkey") % 11 == 0, "noslash").otherwise(F.concat(F.lit("owner"), (F.col("o_custkey") % 7).cast("string"), F.lit("/"), F.lower("o_orderpriority")))
    return table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 2 == 0, "fetch").otherwise("mapping").alias("kind"), dataset.alias("dataset"), F.col("o_orderkey").alias("rev"), F.col("o_orderdate").alias("written_at"))


_FLAT = "list_transform(range(64), lambda x: CAST({} AS BIGINT))"
SQL = {
    "v_files": """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'Testing' ELSE 'Training' END AS root, lang AS label,
  concat(CASE WHEN doc_id % 5 = 0 THEN 'Testing' ELSE 'Training' END, '/', lang, '/', CAST(doc_id AS VARCHAR), '/', source, '.txt') AS path,
  concat(source, '.txt') AS name, CAST(strlen(text) AS BIGINT) AS bytes, sha1(text) AS digest FROM documents""",
    "v_preds": """SELECT vec_id AS key, CAST(label AS BIGINT) AS y_true,
  CAST(list_position(embedding[1:10], list_max(embedding[1:10])) - 1 AS BIGINT) AS y_pred, embedding[1:10] AS scores FROM embeddings""",
    "v_pairs": "SELECT doc_id, CAST(quality AS BIGINT) AS y_true, CAST(toxic AS BIGINT) AS y_pred FROM labels",
    "v_pixels": f"""SELECT vec_id AS key, CAST(label AS BIGINT) AS label, CASE vec_id % 50 WHEN 0 THEN {_FLAT.format(0)} WHEN 1 THEN {_FLAT.format(255)}
  WHEN 2 THEN {_FLAT.format(128)} WHEN 3 THEN NULL
  ELSE list_transform(embedding, lambda x: CAST(floor(least(255e0, greatest(0e0, (CAST(x AS DOUBLE) + 0.5e0) * 255e0))) AS BIGINT)) END AS px FROM embeddings""",
    "v_sizes": """SELECT l_orderkey AS id, CAST(l_linenumber AS BIGINT) AS line, CAST(l_quantity AS BIGINT) * 3 AS h, CAST(p_size AS BIGINT) * 5 AS w
  FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_epochs": """SELECT user_id AS run_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS epoch, value / 500e0 AS val_f1 FROM events""",
    "v_stages": """SELECT concat(run_id, '/', (n - 1) // 6) AS run_id, CAST((n - 1) % 6 + 1 AS BIGINT) AS ord, exit_code, duration
  FROM (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
  CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS exit_code, value AS duration FROM events)""",
    "v_pointers": """SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'fetch' ELSE 'mapping' END AS kind,
  CASE WHEN o_custkey % 11 = 0 THEN 'noslash' ELSE concat('owner', CAST(o_custkey % 7 AS VARCHAR), '/', lower(o_orderpriority)) END AS dataset,
  o_orderkey AS rev, o_orderdate AS written_at FROM orders""",
}


def sql(body: str, *views: str) -> str:
    """body with the named views in front."""
    return "WITH " + ",\n".join(f"{v} AS ({SQL[v]})" for v in views) + ("" if body.lstrip().startswith(",") else "\n") + body
