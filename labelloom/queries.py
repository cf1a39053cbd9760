"""A query for each operator over the given tables, and the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import views as v
from .functions import paths
from .functions.kernels import MEAN, STD
from .operators import audit, evaluate, head, images, runs, split, vocab
from .plans.scratch import scratch_dir
from .sources import ledger, tree

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, *needs: str) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL over the named views."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = v.sql(sql, *needs) if needs else sql
        return f

    return add


def r6(*columns: str) -> list:
    return [F.round(c, 6).alias(c) for c in columns]


def class_names(spark: SparkSession, d: str) -> DataFrame:
    """A vocabulary of customers."""
    return v.table(spark, d, "customer").select(F.col("c_custkey").cast("int").alias("idx"), F.col("c_name").alias("label"))


NAMES = "SELECT CAST(c_custkey AS INTEGER) AS idx, c_name AS label FROM customer"
H = "md5(concat('42:', path))"

# ---- sources and sinks ----


@query("SELECT doc_id, root, split_part(path, '/', 2) AS label, name, '.txt' AS ext FROM v_files", "v_files")
def a1_class_files(spark: SparkSession, d: str) -> DataFrame:
    both = [tree.class_files(v.v_files(spark, d).drop("root", "label"), r) for r in ("Testing", "Training")]
    return both[0].unionByName(both[1]).select("doc_id", "root", "label", "name", "ext")


@query(r"SELECT page_id, url FROM pages WHERE lower(regexp_extract(url, '[^/]+(\.[^./]+)$', 1)) IN ('.html', '.htm', '.php')")
def a2_filter_ext(spark: SparkSession, d: str) -> DataFrame:
    return tree.filter_ext(v.table(spark, d, "pages"), "html,htm,.PHP", "url").select("page_id", "url")


def _image_tree(spark: SparkSession, d: str) -> str:
    """A folder of images by class; every eleventh is of a class that no vocabulary has."""
    root, x = scratch_dir(spark), images.from_pixels(v.v_pixels(spark, d), v.PIXEL_SIDE)
    label = F.when(F.col("key") % 11 == 0, "zz").otherwise(F.col("label").cast("string"))
    tree.write_images(x.select(label.alias("label"), F.col("key").alias("name"), "height", "width", "data"), root)
    return root


_TREE = "tree AS (SELECT key, px, lab, concat(lab, '/', key, '.png') AS path FROM (SELECT *, CASE WHEN key % 11 = 0 THEN 'zz' ELSE CAST(label AS VARCHAR) END AS lab FROM v_pixels))"


@query(f", {_TREE} SELECT lab AS label, concat(key, '.png') AS name, '.png' AS ext FROM tree", "v_pixels")
def a1_scan_class_tree(spark: SparkSession, d: str) -> DataFrame:
    return tree.scan_class_tree(spark, _image_tree(spark, d), "PNG").select("label", "name", "ext")


@query("""SELECT key, px IS NOT NULL AS readable, CASE WHEN px IS NULL THEN -1 ELSE 8 END AS height, CASE WHEN px IS NULL THEN -1 ELSE 8 END AS width, CASE WHEN px IS NOT NULL THEN 3 ELSE -1 END AS n_channels,
  sha1(unhex(array_to_string(list_transform(px, lambda x: repeat(printf('%02x', x), 3)), ''))) AS digest FROM v_pixels""", "v_pixels")
def a3_decode_images(spark: SparkSession, d: str) -> DataFrame:
    """Images written as files by class and read back; those without pixels are files that cannot be read."""
    root = _image_tree(spark, d)
    key = F.regexp_extract("path", r"([0-9]+)\.png$", 1).cast("bigint").alias("key")
    return tree.decode_images(spark, root).select(key, "readable", "height", "width", "n_channels", F.when(F.col("readable"), F.sha1("data")).alias("digest"))


@query("""SELECT root, CAST(count(doc_id) AS BIGINT) AS n FROM (SELECT unnest(['Training', 'Testing', 'Missing']) AS root) LEFT JOIN v_files USING (root) GROUP BY root""", "v_files")
def a4_count_by_root(spark: SparkSession, d: str) -> DataFrame:
    return tree.count_by_root(v.v_files(spark, d), ["Training", "Testing", "Missing"])


_SPLIT = f"""s AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {H}, path) <= greatest(1, floor(count(*) OVER (PARTITION BY label) * 0.2e0)) THEN 'test' ELSE 'train' END AS split FROM v_files)"""


@query(f", {_SPLIT} SELECT split, label, CAST(count(*) AS BIGINT) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM s GROUP BY split, label", "v_files")
def a5_write_split(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    tree.write_split(split.stratified_split(v.v_files(spark, d), 0.2), path, clear=True)
    return spark.read.parquet(path).groupBy("split", "label").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


_KEY = "CASE WHEN regexp_full_match(trim(dataset), '[^/]+/[^/]+') THEN split_part(trim(dataset), '/', {}) ELSE '_unknown_' END"


@query(f"""SELECT kind, owner, slug, dataset, rev, strftime(written_at, '%Y-%m-%dT%H:%M:%SZ') AS written_at_utc FROM (SELECT *, row_number() OVER (PARTITION BY kind, owner, slug ORDER BY written_at DESC, rev DESC) AS r
 FROM (SELECT *, {_KEY.format(1)} AS owner, {_KEY.format(2)} AS slug FROM v_pointers)) WHERE r = 1""", "v_pointers")
def a6_latest_pointer(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark)
    ledger.append_pointer(v.v_pointers(spark, d), path)
    return ledger.latest_pointer(spark.read.parquet(path), "rev").select("kind", "owner", "slug", "dataset", "rev", F.date_format("written_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("written_at_utc"))


@query("""SELECT rev, array_to_string(list_filter([CASE WHEN rev % 5 = 0 THEN 'missing:classes' END, CASE WHEN rev % 3 = 0 THEN 'missing:path' END,
  CASE WHEN written_at IS NULL THEN 'missing:written_at_utc' END, CASE WHEN rev % 5 <> 0 AND rev % 7 <> 3 THEN 'num_classes' END], lambda x: x IS NOT NULL), ',') AS violations FROM v_pointers""", "v_pointers")
def a7_validate_pointer(spark: SparkSession, d: str) -> DataFrame:
    rev = F.col("rev")
    x = v.v_pointers(spark, d).withColumns({"classes": F.when(rev % 5 != 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))), "num_classes": rev % 7, "path": F.when(rev % 3 != 0, F.col("dataset")), "written_at_utc": F.col("written_at").cast("string")})
    return ledger.validate_pointer(x, "mapping").select("rev", F.array_join("violations", ",").alias("violations"))


_BEST = """SELECT run_id, round(val_f1, 6) AS best_f1, epoch AS best_epoch, n AS epochs, (SELECT string_agg(label, ',' ORDER BY label) FROM (SELECT DISTINCT label FROM v_files)) AS classes
 FROM (SELECT *, CAST(count(*) OVER (PARTITION BY run_id) AS BIGINT) AS n, row_number() OVER (PARTITION BY run_id ORDER BY val_f1 DESC, epoch) AS r FROM {}) WHERE r = 1"""


@query(f""", early AS (SELECT * FROM v_epochs WHERE epoch <= 10), a AS ({_BEST.format("early")}), b AS ({_BEST.format("v_epochs")})
SELECT *, CAST('2024-01-03' AS VARCHAR) AS written FROM a WHERE run_id % 3 = 0 UNION ALL SELECT *, '2024-01-02' FROM b WHERE run_id % 3 <> 0""", "v_epochs", "v_files")
def a8_training_summary(spark: SparkSession, d: str) -> DataFrame:
    """Two records a run, of its first ten epochs and of all, appended to a history; of every third run the former was written last."""
    path, epochs = scratch_dir(spark), v.v_epochs(spark, d)
    counts = v.v_files(spark, d).groupBy("label").agg(F.count("*").alias("n"))
    early = F.when(F.col("run_id") % 3 == 0, "2024-01-03").otherwise("2024-01-01").cast("timestamp")
    ledger.append_summary(ledger.training_summary(epochs.where("epoch <= 10"), counts), path, "owner/files", early)
    ledger.append_summary(ledger.training_summary(epochs, counts), path, "owner/files", F.lit("2024-01-02").cast("timestamp"), checkpoint=F.lit("best.pt"))
    last = ledger.latest_summary(spark.read.parquet(path), "run_id")
    return last.select("run_id", "best_f1", "best_epoch", "epochs", F.array_join("classes", ",").alias("classes"), F.date_format("written_at", "yyyy-MM-dd").alias("written"))


_EVAL = """c AS (SELECT y_true, y_pred, count(*) AS n FROM {view} WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY 1, 2),
l AS (SELECT y_true AS label FROM c UNION SELECT y_pred FROM c),
m AS (SELECT label, coalesce((SELECT sum(n) FROM c WHERE y_true = label), 0) AS support, coalesce((SELECT sum(n) FROM c WHERE y_pred = label), 0) AS predicted,
  coalesce((SELECT sum(n) FROM c WHERE y_true = label AND y_pred = label), 0) AS hits FROM l),
p AS (SELECT label, CAST(support AS BIGINT) AS support, hits, CASE WHEN predicted = 0 THEN 0e0 ELSE hits / predicted END AS precision, CASE WHEN support = 0 THEN 0e0 ELSE hits / support END AS recall,
  CASE WHEN predicted + support = 0 THEN 0e0 ELSE 2e0 * hits / (predicted + support) END AS f1 FROM m)"""
_HEADLINE = "SELECT round(sum(hits) / sum(support), 6) AS acc, round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro, CAST(sum(support) AS BIGINT) AS samples FROM p"


@query(f", {_EVAL.format(view='v_pairs')} {_HEADLINE}", "v_pairs")
def a8_eval_summary(spark: SparkSession, d: str) -> DataFrame:
    """The record written last of two, the first of which is of other predictions; at the same time the checkpoint decides."""
    path, at = scratch_dir(spark), F.lit("2024-01-02").cast("timestamp")
    for view, checkpoint in ((v.v_preds, "best_1.pt"), (v.v_pairs, "best_2.pt")):
        ledger.append_summary(ledger.eval_summary(evaluate.evaluate(view(spark, d))), path, "owner/files", at, checkpoint=F.lit(checkpoint))
    return ledger.latest_summary(spark.read.parquet(path)).select("acc", "precision_macro", "recall_macro", "f1_macro", "samples")


# ---- projections and relabelling ----


@query("SELECT doc_id, CAST(doc_id AS VARCHAR) AS parent FROM v_files", "v_files")
def b1_label_parent(spark: SparkSession, d: str) -> DataFrame:
    return v.v_files(spark, d).select("doc_id", paths.label_parent("path").alias("parent"))


@query("""SELECT c_custkey, coalesce(n_name, CAST(c_nationkey % 30 AS VARCHAR)) AS display FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey % 30""")
def b2_display_name(spark: SparkSession, d: str) -> DataFrame:
    names = v.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("label"), F.col("n_name").alias("display"))
    raw = v.table(spark, d, "customer").select("c_custkey", (F.col("c_nationkey") % 30).cast("string").alias("label"))
    return vocab.display_name(raw, names).select("c_custkey", "display")


@query(f"SELECT rev, {_KEY.format(1)} AS owner, {_KEY.format(2)} AS slug FROM v_pointers", "v_pointers")
def b3_split_dataset_key(spark: SparkSession, d: str) -> DataFrame:
    owner, slug = paths.split_dataset_key("dataset")
    return v.v_pointers(spark, d).select("rev", owner.alias("owner"), slug.alias("slug"))


# ---- pooling and sets ----


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x = v.v_files(spark, d)
    return x.where("doc_id % 3 <> 0"), x.where("doc_id % 3 <> 1")


@query("SELECT label, CAST(sum(CASE WHEN doc_id % 3 = 2 THEN 2 ELSE 1 END) AS BIGINT) AS n FROM v_files GROUP BY label", "v_files")
def c1_pool(spark: SparkSession, d: str) -> DataFrame:
    return split.pool(*_halves(spark, d)).groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT label, path FROM v_files", "v_files")
def c2_dedupe_paths(spark: SparkSession, d: str) -> DataFrame:
    return split.dedupe_paths(split.pool(*_halves(spark, d))).select("label", "path")


@query(""", e AS (SELECT unnest(['de', 'en', 'xx']) AS label), f AS (SELECT DISTINCT root, label FROM v_files)
SELECT root, label, 'extra' AS side FROM f WHERE label NOT IN (SELECT label FROM e)
UNION ALL SELECT root, label, 'missing' FROM (SELECT DISTINCT root FROM f) CROSS JOIN e WHERE (root, label) NOT IN (SELECT (root, label) FROM f)""", "v_files")
def c3_class_set_diff(spark: SparkSession, d: str) -> DataFrame:
    expected = spark.createDataFrame([("de",), ("en",), ("xx",)], "label string")
    return vocab.class_set_diff(v.v_files(spark, d), expected, "root")


@query(f"""WITH a AS ({NAMES}), b AS (SELECT idx, CASE WHEN idx % 7 = 0 THEN concat(label, '?') ELSE label END AS label FROM a WHERE idx % 11 <> 0)
SELECT count(*) FILTER (a.label IS DISTINCT FROM b.label) = 0 AS ok, CAST(count(*) FILTER (a.label IS DISTINCT FROM b.label) AS BIGINT) AS n_wrong FROM a FULL JOIN b USING (idx)""")
def c4_verify_classes(spark: SparkSession, d: str) -> DataFrame:
    names = class_names(spark, d)
    return vocab.verify_classes(names, names.where("idx % 11 <> 0").withColumn("label", F.when(F.col("idx") % 7 == 0, F.concat("label", F.lit("?"))).otherwise(F.col("label"))))


# ---- splitting, sampling, ordering, batches ----


@query(f", {_SPLIT} SELECT path, label, split FROM s", "v_files")
def d1_stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return split.stratified_split(v.v_files(spark, d), 0.2).select("path", "label", "split")


@query(f""", c AS (SELECT label, count(*) AS n FROM v_files GROUP BY label), t AS (SELECT *, sum(n) OVER () AS total FROM c), u AS (SELECT *, CAST(total - ceil(0.2e0 * total) AS BIGINT) AS n_train FROM t),
b AS (SELECT label, n_train, (n * n_train) // total AS base, (n * n_train) % total AS rest FROM u),
q AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM b)
SELECT path, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {H}, path) <= quota THEN 'train' ELSE 'val' END AS split FROM v_files JOIN q USING (label)""", "v_files")
def d2_stratified_val_split(spark: SparkSession, d: str) -> DataFrame:
    return split.stratified_val_split(v.v_files(spark, d), 0.2).select("path", "label", "split")


@query(f""", {_SPLIT}, r AS (SELECT path, split, label, name, row_number() OVER (PARTITION BY split, label, name ORDER BY path) - 1 AS k FROM s)
SELECT path, CASE WHEN k = 0 THEN name ELSE concat(regexp_replace(name, '\\.txt$', ''), '__', CAST(k AS VARCHAR), '.txt') END AS dest_name FROM r""".replace("\\\\", "\\"), "v_files")
def d3_unique_names(spark: SparkSession, d: str) -> DataFrame:
    return split.assign_unique_names(split.stratified_split(v.v_files(spark, d), 0.2)).select("path", "dest_name")


@query(f""", {_SPLIT}, f AS (SELECT path, split, label, CASE WHEN doc_id % 6 = 1 THEN replace(name, '.txt', concat('__', doc_id % 23 + 1, '.txt')) ELSE name END AS name FROM s),
t AS (SELECT DISTINCT split, label, name FROM f WHERE length(path) % 7 = 3 UNION SELECT DISTINCT split, label, replace(name, '.txt', '__2.txt') FROM f),
u AS (SELECT DISTINCT split, label, name FROM f UNION SELECT * FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY split, label, name ORDER BY path) - CASE WHEN (split, label, name) IN (SELECT (split, label, name) FROM t) THEN 0 ELSE 1 END AS k FROM f),
g AS (SELECT split, label, name, max(k) AS k FROM r GROUP BY ALL), n AS (SELECT *, unnest(range(1, k + 60)) AS i FROM g),
o AS (SELECT *, row_number() OVER (PARTITION BY split, label, name ORDER BY i) AS place FROM (SELECT *, regexp_replace(name, '\\.txt$', concat('__', i, '.txt')) AS dest FROM n) WHERE (split, label, dest) NOT IN (SELECT (split, label, name) FROM u))
SELECT path, CASE WHEN r.k = 0 THEN r.name ELSE dest END AS dest_name FROM r LEFT JOIN o ON r.split = o.split AND r.label = o.label AND r.name = o.name AND r.k = o.place""".replace("\\\\", "\\"), "v_files")
def d3_unique_names_taken(spark: SparkSession, d: str) -> DataFrame:
    """Many names that look like numbered ones, and folders that have names already."""
    x = split.stratified_split(v.v_files(spark, d), 0.2)
    numbered = F.replace("name", F.lit(".txt"), F.concat(F.lit("__"), (F.col("doc_id") % 23 + 1).cast("string"), F.lit(".txt")))
    x = x.withColumn("name", F.when(F.col("doc_id") % 6 == 1, numbered).otherwise(F.col("name")))
    second = x.select("split", "label", F.replace("name", F.lit(".txt"), F.lit("__2.txt")).alias("name"))
    return split.assign_unique_names(x, x.where(F.length("path") % 7 == 3).select("split", "label", "name").unionByName(second)).select("path", "dest_name")


@query(f", {_SPLIT} SELECT label, CAST(count(*) FILTER (split = 'train') AS BIGINT) AS n_train, CAST(count(*) FILTER (split = 'test') AS BIGINT) AS n_test FROM s GROUP BY label", "v_files")
def d4_split_summary(spark: SparkSession, d: str) -> DataFrame:
    return split.split_summary(split.stratified_split(v.v_files(spark, d), 0.2))


@query(f"SELECT label, path FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {H}, path) AS r FROM v_files) WHERE r <= 2", "v_files")
def d5_sample_per_class(spark: SparkSession, d: str) -> DataFrame:
    return split.sample_per_class(v.v_files(spark, d), 2).select("label", "path")


@query(f"SELECT label, path, CAST(r AS BIGINT) AS turn FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {H}, path) AS r FROM v_files) ORDER BY r, label LIMIT 12", "v_files")
def d6_round_robin(spark: SparkSession, d: str) -> DataFrame:
    return split.round_robin_sample(v.v_files(spark, d), 12).select("label", "path", "turn")


@query("SELECT path, md5(concat('42:3:', path)) AS order_hash FROM v_files ORDER BY 2, 1", "v_files")
def d7_epoch_shuffle(spark: SparkSession, d: str) -> DataFrame:
    return split.epoch_shuffle(v.v_files(spark, d), 42, 3).select("path", "order_hash")


@query("SELECT path, position, position // 32 AS batch_id FROM (SELECT path, CAST(row_number() OVER (ORDER BY md5(concat('42:0:', path)), path) - 1 AS BIGINT) AS position FROM v_files)", "v_files")
def d8_assign_batches(spark: SparkSession, d: str) -> DataFrame:
    return split.assign_batches(v.v_files(spark, d), 32).select("path", "position", "batch_id")


# ---- vocabulary ----


@query("SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx, label FROM (SELECT DISTINCT label FROM v_files WHERE root = 'Training')", "v_files")
def e1_build_vocab(spark: SparkSession, d: str) -> DataFrame:
    return vocab.build_vocab(v.v_files(spark, d).where("root = 'Training'"))


@query("""WITH k AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN concat('k', c_custkey) ELSE CAST(c_custkey AS VARCHAR) END AS key, CASE WHEN c_custkey % 70 = 0 THEN '' WHEN c_custkey % 110 = 1 THEN NULL ELSE c_mktsegment END AS value FROM customer)
SELECT 'bad_key' AS problem, key, value FROM k WHERE NOT regexp_full_match(key, '[0-9]+') UNION ALL SELECT 'bad_value', key, value FROM k WHERE coalesce(value, '') = ''""")
def e2_check_vocab(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return vocab.check_vocab(v.table(spark, d, "customer").select(F.when(k % 50 == 0, F.concat(F.lit("k"), k)).otherwise(k.cast("string")).alias("key"), F.when(k % 70 == 0, "").when(k % 110 != 1, F.col("c_mktsegment")).alias("value")))


@query("SELECT (c_custkey // 50) % 2 = 0 AS by_index, CAST(c_custkey // 50 AS BIGINT) AS part, CAST(c_custkey AS INTEGER) AS idx, c_name AS label FROM customer")
def e3_normalize_vocab(spark: SparkSession, d: str) -> DataFrame:
    """A map for each fifty customers, from number to name or from name to number."""
    part = F.expr("c_custkey div 50").cast("bigint")
    n = v.table(spark, d, "customer").select(part.alias("part"), (part % 2 == 0).alias("by_index"), F.col("c_custkey").cast("string").alias("a"), F.col("c_name").alias("b"))
    entry = F.struct(F.when(F.col("by_index"), F.col("a")).otherwise(F.col("b")), F.when(F.col("by_index"), F.col("b")).otherwise(F.col("a")))
    return vocab.normalize_vocab(n.groupBy("by_index", "part").agg(F.map_from_entries(F.collect_list(entry)).alias("entries")))


@query(", l AS (SELECT DISTINCT label FROM v_files WHERE label <> 'fr'), w AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx FROM l) SELECT doc_id, idx FROM v_files LEFT JOIN w USING (label)", "v_files")
def e4_encode_labels(spark: SparkSession, d: str) -> DataFrame:
    x = v.v_files(spark, d)
    return vocab.encode_labels(x, vocab.build_vocab(x.where("label <> 'fr'"))).select("doc_id", "idx")


@query(f"""WITH a AS ({NAMES}), b AS (SELECT 2 * idx + 1 AS new, label FROM a), m AS (SELECT idx, new FROM a JOIN b USING (label)),
p AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 9 = 0 THEN -1 ELSE o_custkey END AS y_true FROM orders)
SELECT key, CAST(coalesce(new, y_true) AS BIGINT) AS y_true, (SELECT count(*) FROM a) = (SELECT count(*) FROM m) AS remapped FROM p LEFT JOIN m ON y_true = idx""")
def e5_remap_indices(spark: SparkSession, d: str) -> DataFrame:
    """Customers renumbered; some orders are of none."""
    names = class_names(spark, d)
    y = F.when(F.col("o_orderkey") % 9 == 0, F.lit(-1)).otherwise(F.col("o_custkey")).cast("bigint")
    preds = v.table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), y.alias("y_true"))
    return vocab.remap_indices(preds, names, names.withColumn("idx", 2 * F.col("idx") + 1)).select("key", "y_true", "remapped")


@query(f"WITH a AS ({NAMES}) SELECT o_orderkey AS key, CAST(o_custkey AS BIGINT) AS y_true, (SELECT count(*) FROM a WHERE idx % 5 = 0) = 0 AS remapped FROM orders")
def e5_remap_other_names(spark: SparkSession, d: str) -> DataFrame:
    """Vocabularies that do not have the same names leave indices as they are."""
    names = class_names(spark, d)
    preds = v.table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").cast("bigint").alias("y_true"))
    return vocab.remap_indices(preds, names, names.where("idx % 5 <> 0").withColumn("idx", F.col("idx") + 7)).select("key", "y_true", "remapped")


# ---- per-class aggregates ----


def _vocab_and_more(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x = v.v_files(spark, d)
    return x, vocab.build_vocab(x.select("label").unionByName(spark.createDataFrame([("zz",)], "label string")))


@query("SELECT label, CAST(count(doc_id) AS BIGINT) AS n FROM (SELECT DISTINCT label FROM v_files UNION SELECT 'zz') LEFT JOIN v_files USING (label) GROUP BY label", "v_files")
def f1_class_counts(spark: SparkSession, d: str) -> DataFrame:
    return vocab.class_counts(*_vocab_and_more(spark, d))


@query("SELECT label FROM (SELECT DISTINCT label FROM v_files UNION SELECT 'zz') WHERE label NOT IN (SELECT label FROM v_files)", "v_files")
def f2_empty_classes(spark: SparkSession, d: str) -> DataFrame:
    return vocab.empty_classes(*_vocab_and_more(spark, d))


@query("SELECT root, label, CAST(count(*) AS BIGINT) AS n, round(count(*) * 100e0 / sum(count(*)) OVER (PARTITION BY root), 6) AS percent FROM v_files GROUP BY root, label", "v_files")
def f3_class_distribution(spark: SparkSession, d: str) -> DataFrame:
    return vocab.class_distribution(v.v_files(spark, d), "root").select("root", "label", "n", *r6("percent"))


# ---- images ----


@query(""", g AS (SELECT *, 224e0 / greatest(h, w) AS scale FROM v_sizes), n AS (SELECT *, CAST(floor(h * scale) AS BIGINT) AS new_h, CAST(floor(w * scale) AS BIGINT) AS new_w FROM g)
SELECT id, line, h, w, new_h, new_w, CASE WHEN scale < 1 THEN 'AREA' ELSE 'LINEAR' END AS interp, (224 - new_h) // 2 AS top, 224 - new_h - (224 - new_h) // 2 AS bottom,
  (224 - new_w) // 2 AS left, 224 - new_w - (224 - new_w) // 2 AS right, new_h = 0 OR new_w = 0 AS degenerate FROM n""".replace(" AS left", ' AS "left"').replace(" AS right", ' AS "right"'), "v_sizes")
def g1_letterbox_geometry(spark: SparkSession, d: str) -> DataFrame:
    return images.letterbox_geometry(v.v_sizes(spark, d), 224)


def _images(spark: SparkSession, d: str) -> DataFrame:
    return images.from_pixels(v.v_pixels(spark, d), v.PIXEL_SIDE).drop("px")


def _resampled(side: int) -> str:
    """SQL for digests of v_pixels at side x side: between the two nearest pixels each way, held at the borders."""
    return f""", spots AS (SELECT i, least(greatest((i + 0.5e0) * ({v.PIXEL_SIDE}e0 / {side}) - 0.5e0, 0e0), {v.PIXEL_SIDE - 1}e0) AS p FROM range({side}) t(i)),
w AS (SELECT i, CAST(floor(p) AS BIGINT) AS low, least(CAST(floor(p) AS BIGINT) + 1, {v.PIXEL_SIDE - 1}) AS high, p - floor(p) AS f FROM spots),
x AS (SELECT key, y.i AS r, c.i AS n, floor((1 - c.f) * ((1 - y.f) * px[y.low * {v.PIXEL_SIDE} + c.low + 1] + y.f * px[y.high * {v.PIXEL_SIDE} + c.low + 1])
  + c.f * ((1 - y.f) * px[y.low * {v.PIXEL_SIDE} + c.high + 1] + y.f * px[y.high * {v.PIXEL_SIDE} + c.high + 1]) + 0.5e0) AS value FROM v_pixels, w AS y, w AS c)
"""


DIGEST = "sha1(unhex(string_agg(repeat(printf('%02x', CAST(value AS BIGINT)), 3), '' ORDER BY r, n))) AS digest"


@query(_resampled(12) + f"SELECT key, 12 AS height, 12 AS width, {DIGEST} FROM x WHERE value IS NOT NULL GROUP BY key", "v_pixels")
def g2_letterbox(spark: SparkSession, d: str) -> DataFrame:
    return images.letterbox(_images(spark, d), 12).select("key", "height", "width", F.sha1("data").alias("digest"))


@query(_resampled(12) + f"SELECT key, 12 AS height, 12 AS width, {DIGEST} FROM x WHERE value IS NOT NULL GROUP BY key", "v_pixels")
def g2_resize_tree(spark: SparkSession, d: str) -> DataFrame:
    """A folder of images read, letterboxed, written by class as another folder, and read back; unreadable ones are left out."""
    source, target = _image_tree(spark, d), scratch_dir(spark)
    key = lambda c: F.regexp_extract(c, r"([0-9]+)\.png$", 1)
    tree.write_images(images.letterbox(tree.decode_images(spark, source).select(paths.label_parent("path").alias("label"), key("path").alias("name"), "height", "width", "data"), 12), target)
    return tree.decode_images(spark, target).select(key("path").cast("bigint").alias("key"), "height", "width", F.sha1("data").alias("digest"))


@query("SELECT label, CAST(count(*) AS BIGINT) AS found, CAST(count(px) AS BIGINT) AS resized FROM v_pixels GROUP BY label", "v_pixels")
def g2_letterbox_tally(spark: SparkSession, d: str) -> DataFrame:
    x = _images(spark, d)
    return images.letterbox_tally(x, images.letterbox(x, 12), "label")


@query("""SELECT key, sha1(unhex(array_to_string(list_transform(px, lambda x: repeat(printf('%02x', CAST(floor((299 * x + 587 * x + 114 * x) / 1000e0 + 0.5e0) AS BIGINT)), 3)), ''))) AS digest
FROM v_pixels""", "v_pixels")
def g3_to_grayscale(spark: SparkSession, d: str) -> DataFrame:
    return images.to_grayscale(_images(spark, d)).select("key", F.sha1("data").alias("digest"))


@query(f"SELECT key, round(list_sum(list_transform(px, lambda x: (x / 255e0 - {MEAN[0]}e0) / {STD[0]}e0)), 4) AS total, round((px[1] / 255e0 - {MEAN[0]}e0) / {STD[0]}e0, 6) AS first FROM v_pixels", "v_pixels")
def g4_normalize(spark: SparkSession, d: str) -> DataFrame:
    x = v.v_pixels(spark, d).withColumn("f", images.normalize_pixels("px"))
    return x.select("key", F.round(F.aggregate("f", F.lit(0.0), lambda a, p: a + p), 4).alias("total"), F.round(F.element_at("f", 1), 6).alias("first"))


def _unit(what: str) -> str:
    """SQL for a key's number in [0, 1) that augmentation takes for something."""
    return f"CAST(concat('0x', substr(md5(concat('42:0:{what}:0:', key)), 1, 12)) AS BIGINT) / 281474976710656e0"


def _factor(what: str, x: float) -> str:
    low = max(0.0, 1.0 - x)
    return f"{low!r}e0 + ({_unit(what)}) * {1.0 + x - low!r}e0"


def _rotated(source: str, degrees: int) -> str:
    """SQL that turns px of a table around the middle: for each pixel, the one that it comes from, or black."""
    row, col = "(i // 8 - 3.5e0)", "(i % 8 - 3.5e0)"
    sy, sx = f"CAST(floor(cos(t) * {row} - sin(t) * {col} + 3.5e0 + 0.5e0) AS BIGINT)", f"CAST(floor(sin(t) * {row} + cos(t) * {col} + 3.5e0 + 0.5e0) AS BIGINT)"
    return f"""(SELECT * REPLACE (CASE WHEN px IS NOT NULL THEN list_transform(range(64), lambda i: CASE WHEN {sy} BETWEEN 0 AND 7 AND {sx} BETWEEN 0 AND 7 THEN px[{sy} * 8 + {sx} + 1] ELSE 0 END) END AS px)
  FROM (SELECT *, (({_unit("angle")}) * 2 - 1) * {degrees}e0 * (pi() / 180e0) AS t FROM {source}))"""


def _jittered(source: str, brightness: float, contrast: float) -> str:
    """SQL that changes px of a table by brightness and contrast in the key's order, cut off after each."""
    bright = lambda p: f"list_transform({p}, lambda x: floor(least(255e0, greatest(0e0, x * b))))"
    contr = lambda p, m: f"list_transform({p}, lambda x: floor(least(255e0, greatest(0e0, {m} + (x - {m}) * c))))"
    mean = lambda p: f"floor(list_sum({p}) / 64e0 + 0.5e0)"
    return f"""(SELECT * REPLACE (CASE WHEN first THEN {contr("p1", "m")} ELSE {bright("p1")} END AS px) FROM (SELECT *, {mean("p1")} AS m FROM (
  SELECT *, CASE WHEN first THEN {bright("px")} ELSE {contr("px", "m0")} END AS p1 FROM (SELECT *, {mean("px")} AS m0, {_unit("order")} < 0.5e0 AS first, {_factor("brightness", brightness)} AS b, {_factor("contrast", contrast)} AS c FROM {source}))))"""


_BYTES = "sha1(unhex(array_to_string(list_transform(px, lambda x: repeat(printf('%02x', CAST(x AS BIGINT)), 3)), ''))) AS digest"


@query(f"SELECT key, {_BYTES} FROM {_rotated('v_pixels', 15)}", "v_pixels")
def g5_augment_rotate(spark: SparkSession, d: str) -> DataFrame:
    return images.augment_rotate(_images(spark, d), 15).select("key", F.sha1("data").alias("digest"))


@query(""", u AS (SELECT *, CAST(concat('0x', substr(md5(concat('42:0:flip:0:', key)), 1, 12)) AS BIGINT) / 281474976710656e0 < 0.5e0 AS f FROM v_pixels)
SELECT key, CASE WHEN px IS NOT NULL THEN array_to_string(CASE WHEN f THEN flatten(list_transform(range(8), lambda r: list_reverse(px[r * 8 + 1:r * 8 + 8]))) ELSE px END, ',') END AS px FROM u""", "v_pixels")
def g6_augment_hflip(spark: SparkSession, d: str) -> DataFrame:
    return images.augment_hflip(v.v_pixels(spark, d), 0.5, v.PIXEL_SIDE).select("key", F.array_join("px", ",").alias("px"))


@query(f"SELECT key, {_BYTES} FROM {_jittered('v_pixels', 0.2, 0.2)}", "v_pixels")
def g7_augment_jitter(spark: SparkSession, d: str) -> DataFrame:
    return images.augment_jitter(_images(spark, d), 0.2, 0.2).select("key", F.sha1("data").alias("digest"))


@query("SELECT key, CAST(unnest(range(4)) AS INTEGER) AS copy FROM v_pixels", "v_pixels")
def g8_augment_n(spark: SparkSession, d: str) -> DataFrame:
    return images.augment_copies(_images(spark, d), 3, 15, 0.5, 0.1, 0.1).select("key", "copy")


_TENSOR = f"""CAST(3 * len(px) AS BIGINT) AS n, round(list_sum(flatten([{", ".join(f"list_transform(px, lambda x: CAST(CAST((x / 255e0 - {m}e0) / {s}e0 AS FLOAT) AS DOUBLE))" for m, s in zip(MEAN, STD))}])), 4) AS total"""
_FLIPPED = f"""(SELECT * REPLACE (CASE WHEN px IS NOT NULL AND {_unit("flip")} < 0.5e0 THEN flatten(list_transform(range(8), lambda r: list_reverse(px[r * 8 + 1:r * 8 + 8]))) ELSE px END AS px) FROM {_rotated("v_pixels", 15)})"""


@query(f"SELECT key, {_TENSOR} FROM {_jittered(_FLIPPED, 0.1, 0.1)}", "v_pixels")
def g9_prepare_train(spark: SparkSession, d: str) -> DataFrame:
    return images.tensor_stats(images.prepare_train(_images(spark, d)), ["key"])


@query(f"SELECT key, {_TENSOR} FROM v_pixels", "v_pixels")
def g9_prepare_eval(spark: SparkSession, d: str) -> DataFrame:
    return images.tensor_stats(images.prepare_eval(_images(spark, d)), ["key"])


@query(_resampled(5) + f"SELECT key, {DIGEST} FROM x GROUP BY key", "v_pixels")
def g10_stretch_resize(spark: SparkSession, d: str) -> DataFrame:
    return images.stretch_resize(_images(spark, d), 5).select("key", F.sha1("data").alias("digest"))


# ---- audit ----

AUDIT = audit.Config(exts="txt", min_file_bytes=1024, size=8, dup_check=True)


def _audited(spark: SparkSession, d: str, cfg: audit.Config = AUDIT) -> DataFrame:
    """Files with the pixels of the item of the same number; 3 in 40 have another extension, one class is unknown, some sizes are wrong."""
    f = v.v_files(spark, d)
    i = F.col("doc_id")
    f = f.withColumns({"name": F.when(i % 40 < 3, F.concat("name", F.lit(".bak"))).otherwise(F.col("name")), "height": F.when(i % 17 == 0, 7).otherwise(8), "width": F.lit(8), "n_channels": F.when(i % 23 == 0, 1).otherwise(3)})
    px = audit.pixel_stats(v.v_pixels(spark, d)).select(F.col("key").alias("doc_id"), "px_min", "px_max", "px_std")
    f = f.join(px, "doc_id", "left").withColumn("readable", F.col("px_min").isNotNull())
    return audit.with_rules(f, vocab.build_vocab(f.where("label <> 'es'")), cfg)


_AUDIT = """x AS (SELECT key AS doc_id, list_min(px) AS px_min, list_max(px) AS px_max, sqrt(list_avg(list_transform(px, lambda z: (z - list_avg(px)) * (z - list_avg(px))))) AS px_std FROM v_pixels),
f AS (SELECT v.*, px_min, px_max, px_std, px_min IS NOT NULL AS readable, v.doc_id % 40 >= 3 AS ext_ok, CASE WHEN v.doc_id % 17 = 0 THEN 7 ELSE 8 END AS height FROM v_files v LEFT JOIN x USING (doc_id)),
k AS (SELECT digest, min(path) AS first_path FROM f WHERE ext_ok AND readable GROUP BY digest),
a AS (SELECT *, (ext_ok AND readable AND height = 8 AND NOT (px_max = 0 OR px_min = 255)) AS ok FROM f LEFT JOIN k USING (digest)),
r AS (SELECT path, 'BAD_EXT' AS code, 'error' AS severity, concat(name, '.bak') AS detail FROM a WHERE NOT ext_ok
UNION ALL SELECT path, 'BAD_LABEL', 'error', label FROM a WHERE ext_ok AND label = 'es'
UNION ALL SELECT path, 'TINY_FILE', 'warning', CAST(bytes AS VARCHAR) FROM a WHERE ext_ok AND bytes < 1024
UNION ALL SELECT path, 'UNREADABLE', 'error', '' FROM a WHERE ext_ok AND NOT readable
UNION ALL SELECT path, 'BAD_SIZE', 'error', concat('8x', height) FROM a WHERE ext_ok AND readable AND height <> 8
UNION ALL SELECT path, 'ALL_BLACK', 'error', '' FROM a WHERE ext_ok AND readable AND px_max = 0
UNION ALL SELECT path, 'ALL_WHITE', 'error', '' FROM a WHERE ext_ok AND readable AND px_min = 255 AND px_max <> 0
UNION ALL SELECT path, 'LOW_STD', 'warning', '' FROM a WHERE ext_ok AND readable AND px_std < 3
UNION ALL SELECT path, 'DUPLICATE', 'warning', first_path FROM a WHERE ext_ok AND readable AND path <> first_path)"""


def _rule_query(code: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return audit.findings(_audited(spark, d)).where(F.col("code") == code)

    run.__name__ = f"h{list(audit.CODES).index(code) + 1}_{code.lower()}"
    return query(f", {_AUDIT} SELECT * FROM r WHERE code = '{code}'", "v_files", "v_pixels")(run)


for _code in audit.CODES:
    if _code != "NOT_RGB":
        _rule_query(_code)


@query(f""", {_AUDIT} SELECT path, 'NOT_RGB' AS code, 'error' AS severity, '1' AS detail FROM a WHERE ext_ok AND readable AND doc_id % 23 = 0""", "v_files", "v_pixels")
def h5_not_rgb(spark: SparkSession, d: str) -> DataFrame:
    return audit.findings(_audited(spark, d, audit.Config(exts="txt", size=8, strict=True))).where("code = 'NOT_RGB'")


@query(f", {_AUDIT} SELECT * FROM r", "v_files", "v_pixels")
def h11_findings(spark: SparkSession, d: str) -> DataFrame:
    return audit.findings(_audited(spark, d))


@query(f", {_AUDIT} SELECT path, ok FROM a", "v_files", "v_pixels")
def h12_is_ok(spark: SparkSession, d: str) -> DataFrame:
    return _audited(spark, d).select("path", "ok")


@query(f""", {_TREE}, k AS (SELECT px, min(path) AS first_path FROM tree WHERE px IS NOT NULL GROUP BY px),
s AS (SELECT tree.*, first_path, sqrt(list_avg(list_transform(tree.px, lambda z: (z - list_avg(tree.px)) * (z - list_avg(tree.px))))) AS dev FROM tree LEFT JOIN k ON tree.px = k.px)
SELECT path, 'BAD_LABEL' AS code, 'error' AS severity, lab AS detail FROM s WHERE lab = 'zz'
UNION ALL SELECT path, 'TINY_FILE', 'warning', '8' FROM s WHERE px IS NULL
UNION ALL SELECT path, 'UNREADABLE', 'error', '' FROM s WHERE px IS NULL
UNION ALL SELECT path, 'ALL_BLACK', 'error', '' FROM s WHERE list_max(px) = 0
UNION ALL SELECT path, 'ALL_WHITE', 'error', '' FROM s WHERE list_min(px) = 255
UNION ALL SELECT path, 'LOW_STD', 'warning', '' FROM s WHERE dev < 3
UNION ALL SELECT path, 'DUPLICATE', 'warning', first_path FROM s WHERE path <> first_path""", "v_pixels")
def h11_findings_of_files(spark: SparkSession, d: str) -> DataFrame:
    """A folder of images as it lies there: scanned, digested, decoded and put to the rules."""
    names = v.v_pixels(spark, d).select(F.col("label").cast("string").alias("label")).distinct()
    return audit.findings(audit.audit_tree(spark, _image_tree(spark, d), vocab.build_vocab(names), audit.Config(exts="png", size=v.PIXEL_SIDE, min_file_bytes=16, dup_check=True)))


_SUMMARY = """SELECT CAST(count(*) AS BIGINT) AS scanned, CAST(count(*) FILTER (ok) AS BIGINT) AS ok, (SELECT CAST(count(*) AS BIGINT) FROM r WHERE severity = 'error') AS errors, (SELECT CAST(count(*) AS BIGINT) FROM r WHERE severity = 'warning') AS warnings,
  (SELECT concat('{', string_agg(concat('"', label, '":', n), ',' ORDER BY label), '}') FROM (SELECT label, count(*) AS n FROM a WHERE ext_ok AND readable GROUP BY label)) AS per_class FROM a"""


@query(f", {_AUDIT} {_SUMMARY}", "v_files", "v_pixels")
def h13_validation_summary(spark: SparkSession, d: str) -> DataFrame:
    return audit.validation_summary(_audited(spark, d), AUDIT)


@query(f", {_AUDIT}, s AS ({_SUMMARY}), g AS (SELECT unnest(['error', 'warning', 'never']) AS fail_on) SELECT fail_on, CASE fail_on WHEN 'error' THEN errors = 0 WHEN 'warning' THEN errors + warnings = 0 ELSE true END AS passed FROM s CROSS JOIN g", "v_files", "v_pixels")
def h14_gate(spark: SparkSession, d: str) -> DataFrame:
    summary = audit.validation_summary(_audited(spark, d), AUDIT)
    a, b, c = (audit.gate(summary, f).select(F.lit(f).alias("fail_on"), "passed") for f in ("error", "warning", "never"))
    return a.unionByName(b).unionByName(c)


# ---- scoring and evaluation ----

_SOFT = "e AS (SELECT key, y_true, y_pred, list_transform(scores, lambda x: exp(CAST(x AS DOUBLE) - CAST(list_max(scores) AS DOUBLE))) AS e FROM v_preds), q AS (SELECT key, y_true, y_pred, list_transform(e, lambda x: x / list_sum(e)) AS p FROM e)"


@query(f", {_SOFT} SELECT key, CAST(i AS INTEGER) AS idx, round(p[i + 1], 6) AS prob FROM (SELECT key, p, unnest(range(10)) AS i FROM q)", "v_preds")
def i1_softmax(spark: SparkSession, d: str) -> DataFrame:
    return v.v_preds(spark, d).select("key", F.posexplode(evaluate.softmax()).alias("idx", "prob")).select("key", "idx", *r6("prob"))


@query("SELECT key, y_pred FROM v_preds", "v_preds")
def i2_predict(spark: SparkSession, d: str) -> DataFrame:
    return v.v_preds(spark, d).select("key", evaluate.predict().alias("y_pred"))


@query(f", {_SOFT}, n AS ({NAMES}) SELECT key, label, round(list_max(p), 6) AS prob FROM q LEFT JOIN n ON idx = y_pred", "v_preds")
def i3_top1(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.top1(v.v_preds(spark, d), class_names(spark, d)).select("key", "label", *r6("prob"))


@query(f""", {_SOFT}, n AS ({NAMES}), x AS (SELECT key, p, CAST(unnest(range(10)) AS INTEGER) AS idx FROM q)
SELECT key, label, round(p[idx + 1], 6) AS prob, CAST(row_number() OVER (PARTITION BY key ORDER BY p[idx + 1] DESC, idx) AS BIGINT) AS rank FROM x LEFT JOIN n USING (idx)""", "v_preds")
def i4_probability_table(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.probability_table(v.v_preds(spark, d), class_names(spark, d)).select("key", "label", *r6("prob"), "rank")


@query("SELECT round(avg(CASE WHEN y_true = y_pred THEN 1e0 ELSE 0e0 END), 6) AS acc, CAST(count(*) AS BIGINT) AS samples FROM v_preds", "v_preds")
def i5_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.accuracy(v.v_preds(spark, d)).select(*r6("acc"), "samples")


_PER = "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM p"


@query(f", {_EVAL.format(view='v_preds')} {_PER}", "v_preds")
def i6_per_class_metrics(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.per_class_metrics(v.v_preds(spark, d)).select("label", *r6("precision", "recall", "f1"), "support")


@query(f", w AS (SELECT * FROM v_pairs WHERE y_pred = 0), {_EVAL.format(view='w')} {_PER}", "v_pairs")
def i6_absent_class(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.per_class_metrics(v.v_pairs(spark, d).where("y_pred = 0")).select("label", *r6("precision", "recall", "f1"), "support")


_GRID = "g AS (SELECT a.label AS y_true, b.label AS y_pred, CAST(coalesce(n, 0) AS BIGINT) AS n FROM l a CROSS JOIN l b LEFT JOIN c ON c.y_true = a.label AND c.y_pred = b.label)"


@query(f", {_EVAL.format(view='v_preds')}, {_GRID} SELECT * FROM g", "v_preds")
def i7_confusion(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion(v.v_preds(spark, d))


@query(f", {_EVAL.format(view='v_pairs')}, {_GRID} SELECT *, CASE WHEN sum(n) OVER (PARTITION BY y_true) = 0 THEN 0e0 ELSE round(n / sum(n) OVER (PARTITION BY y_true), 6) END AS share FROM g", "v_pairs")
def i8_confusion_normalized(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion_normalized(v.v_pairs(spark, d)).select("y_true", "y_pred", "n", *r6("share"))


@query(f", {_EVAL.format(view='v_preds')} SELECT round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro FROM p", "v_preds")
def i9_macro_metrics(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.macro_metrics(v.v_preds(spark, d)).select(*r6("precision_macro", "recall_macro", "f1_macro"))


@query(f""", {_EVAL.format(view='v_preds')}, nn AS ({NAMES}), t AS (SELECT coalesce(nn.label, CAST(p.label AS VARCHAR)) AS name, precision, recall, f1, support FROM p LEFT JOIN nn ON idx = p.label
UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) FROM p
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM p
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM p)
SELECT name, round(precision, 3) AS precision, round(recall, 3) AS recall, round(f1, 3) AS f1, CAST(support AS BIGINT) AS support FROM t""", "v_preds")
def i10_classification_report(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.classification_report(v.v_preds(spark, d), class_names(spark, d))


def _top(wrong: str) -> str:
    return f", {_SOFT} SELECT key, y_true, y_pred, round(conf, 6) AS conf, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY y_true ORDER BY conf DESC, key) AS rank FROM (SELECT *, p[y_pred + 1] AS conf FROM q WHERE y_true {wrong} y_pred)) WHERE rank <= 6"


@query(_top("<>"), "v_preds")
def i11_top_mistakes(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.top_mistakes(v.v_preds(spark, d)).select("key", "y_true", "y_pred", *r6("conf"), "rank")


@query(_top("="), "v_preds")
def i12_top_correct(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.top_correct(v.v_preds(spark, d)).select("key", "y_true", "y_pred", *r6("conf"), "rank")


@query(""", b AS (SELECT key, y_true, CASE WHEN key % 9 = 0 THEN (y_pred + 1) % 10 ELSE y_pred END AS y_pred FROM v_preds WHERE key % 31 <> 0)
SELECT key, a.y_true AS true_a, b.y_true AS true_b, a.y_pred AS pred_a, b.y_pred AS pred_b FROM v_preds a FULL JOIN b USING (key) WHERE a.y_true IS DISTINCT FROM b.y_true OR a.y_pred IS DISTINCT FROM b.y_pred""", "v_preds")
def i13_prediction_diff(spark: SparkSession, d: str) -> DataFrame:
    a = v.v_preds(spark, d)
    b = a.where("key % 31 <> 0").withColumn("y_pred", F.when(F.col("key") % 9 == 0, (F.col("y_pred") + 1) % 10).otherwise(F.col("y_pred")))
    return evaluate.prediction_diff(a, b)


@query(f", {_EVAL.format(view='v_preds')} {_HEADLINE}", "v_preds")
def i14_evaluate(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.evaluate(v.v_preds(spark, d)).select(*r6("acc", "precision_macro", "recall_macro", "f1_macro"), "samples")


# ---- training runs ----


@query("SELECT run_id, epoch AS best_epoch, val_f1 AS best_f1 FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY val_f1 DESC, epoch) AS r FROM v_epochs) WHERE r = 1", "v_epochs")
def j1_best_epoch(spark: SparkSession, d: str) -> DataFrame:
    return runs.best_epoch(v.v_epochs(spark, d))


# epochs since the last one that was above all before it, in closed form: with min_delta 0 a gain is a new maximum
_STOP = """, g AS (SELECT *, coalesce(val_f1 > max(val_f1) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS gain FROM v_epochs),
b AS (SELECT *, epoch - coalesce(max(CASE WHEN gain THEN epoch END) OVER (PARTITION BY run_id ORDER BY epoch), 0) AS bad FROM g),
t AS (SELECT run_id, min(CASE WHEN bad >= 5 THEN epoch END) AS stop_epoch FROM b GROUP BY run_id)"""


@query(f"{_STOP} SELECT * FROM t", "v_epochs")
def j2_early_stop(spark: SparkSession, d: str) -> DataFrame:
    return runs.early_stop(v.v_epochs(spark, d), 5)


@query(f"{_STOP} SELECT run_id, epoch, val_f1 FROM v_epochs JOIN t USING (run_id) WHERE stop_epoch IS NULL OR epoch <= stop_epoch", "v_epochs")
def j3_effective_epochs(spark: SparkSession, d: str) -> DataFrame:
    return runs.effective_epochs(v.v_epochs(spark, d), patience=5)


# with min_delta above 0 a gain is measured from the last gain, epoch by epoch
_FOLD = """, l AS (SELECT run_id, list({'best': CAST('-inf' AS DOUBLE), 'bad': 0, 'stop': CAST(NULL AS BIGINT), 'm': val_f1, 'epoch': epoch} ORDER BY epoch) AS l FROM v_epochs GROUP BY run_id),
f AS (SELECT run_id, list_reduce(list_prepend({'best': CAST('-inf' AS DOUBLE), 'bad': 0, 'stop': CAST(NULL AS BIGINT), 'm': CAST(NULL AS DOUBLE), 'epoch': CAST(0 AS BIGINT)}, l), lambda a, e: {
  'best': CASE WHEN e.m > a.best + 0.05e0 THEN e.m ELSE a.best END, 'bad': CASE WHEN e.m > a.best + 0.05e0 THEN 0 ELSE a.bad + 1 END,
  'stop': coalesce(a.stop, CASE WHEN NOT e.m > a.best + 0.05e0 AND a.bad + 1 >= 2 THEN e.epoch END), 'm': e.m, 'epoch': e.epoch}).stop AS stop_epoch FROM l)"""


@query(f"{_FOLD} SELECT run_id, stop_epoch FROM f", "v_epochs")
def j2_early_stop_by_delta(spark: SparkSession, d: str) -> DataFrame:
    return runs.early_stop(v.v_epochs(spark, d), 2, 0.05)


@query(f"{_FOLD} SELECT run_id, epoch, val_f1 FROM v_epochs JOIN f USING (run_id) WHERE stop_epoch IS NULL OR epoch <= stop_epoch", "v_epochs")
def j3_effective_epochs_by_delta(spark: SparkSession, d: str) -> DataFrame:
    return runs.effective_epochs(v.v_epochs(spark, d), 2, 0.05)


@query(f"""{_STOP} SELECT run_id, epoch, 'best' AS kind, concat('best_valF1_', printf('%.4f', val_f1), '_epoch', epoch) AS name FROM g WHERE gain
UNION ALL SELECT run_id, epoch, 'last', 'last' FROM g UNION ALL SELECT run_id, epoch, 'periodic', concat('epoch', epoch) FROM g WHERE epoch % 10 = 0""", "v_epochs")
def j4_checkpoint_plan(spark: SparkSession, d: str) -> DataFrame:
    return runs.checkpoint_plan(v.v_epochs(spark, d), every_n=10)


@query("SELECT run_id, epoch, round(1e-3 * pow(0.5e0, (epoch - 1) // 7), 12) AS lr FROM v_epochs", "v_epochs")
def j5_lr_history(spark: SparkSession, d: str) -> DataFrame:
    return runs.lr_history(v.v_epochs(spark, d), 1e-3, 7, 0.5).withColumn("lr", F.round("lr", 12))


@query("SELECT run_id, round(sum(val_f1 * epoch) / sum(epoch), 6) AS train_loss FROM v_epochs GROUP BY run_id", "v_epochs")
def j6_epoch_loss(spark: SparkSession, d: str) -> DataFrame:
    return runs.epoch_loss(v.v_epochs(spark, d).select("run_id", F.col("val_f1").alias("loss"), F.col("epoch").alias("n")), "run_id").select("run_id", *r6("train_loss"))


@query()
def j7_fit_softmax_head(spark: SparkSession, d: str) -> DataFrame:
    """Train on four fifths of the vectors, predict the rest."""
    x = v.table(spark, d, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("features"), F.col("label").alias("y_true"))
    weights, _ = head.fit_softmax_head(x.where("key % 5 <> 0"), x.where("key % 5 = 0"), 10, head.HeadConfig(epochs=12))
    return head.score(x.where("key % 5 = 0"), weights).select("key", F.col("y_true").cast("bigint").alias("y_true"), evaluate.predict("scores").alias("y_pred"))


def _history(cfg: head.HeadConfig, classes: int = 10, features: int = 64) -> str:
    """SQL for the records of a fit, epoch by epoch: losses before a step, then the step, then what the new weights say of the other fifth."""
    rows = "SELECT vec_id AS key, list_append(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), 1e0) AS x, CAST(label AS BIGINT) AS y FROM embeddings WHERE vec_id % 5 {} 0"
    out = [f"WITH t AS ({rows.format('<>')})", f"u AS ({rows.format('=')})", f"w0 AS (SELECT k, i, 0e0 AS w, 0e0 AS m, 0e0 AS v FROM range({classes}) a(k), range(1, {features + 2}) b(i))"]
    last = []
    for e in range(1, cfg.epochs + 1):
        lr = cfg.lr * cfg.gamma ** ((e - 1) // cfg.step)
        lists = "(SELECT k, list(w ORDER BY i) AS w FROM w{} GROUP BY k)"
        out += [
            f"z{e} AS (SELECT key, y, x, k, list_dot_product(x, w) AS z FROM t, {lists.format(e - 1)})",
            f"q{e} AS (SELECT key, y, x, k, exp(z - max(z) OVER (PARTITION BY key)) AS q FROM z{e})",
            f"p{e} AS (SELECT key, y, x, k, q / sum(q) OVER (PARTITION BY key) AS p FROM q{e})",
            f"g{e} AS (SELECT k, i, sum((p - CASE WHEN k = y THEN 1 ELSE 0 END) * x[i]) / (SELECT count(*) FROM t) AS g FROM p{e}, range(1, {features + 2}) b(i) GROUP BY k, i)",
            f"s{e} AS (SELECT k, i, w, 0.9e0 * m + 0.1e0 * g AS m, 0.999e0 * v + 0.001e0 * g * g AS v FROM w{e - 1} JOIN g{e} USING (k, i))",
            f"w{e} AS (SELECT k, i, w * (1 - {lr!r}::DOUBLE * {cfg.weight_decay!r}::DOUBLE) - {lr!r}::DOUBLE * (m / {1 - 0.9**e!r}::DOUBLE) / (sqrt(v / {1 - 0.999**e!r}::DOUBLE) + 1e-8) AS w, m, v FROM s{e})",
            f"y{e} AS (SELECT key, y, arg_max(k, (z, -k)) AS o FROM (SELECT key, y, k, list_dot_product(x, w) AS z FROM u, {lists.format(e)}) GROUP BY key, y)",
            f"f{e} AS (SELECT avg(2e0 * (SELECT count(*) FROM y{e} WHERE y = l AND o = l) / ((SELECT count(*) FROM y{e} WHERE y = l) + (SELECT count(*) FROM y{e} WHERE o = l))) AS f FROM (SELECT y AS l FROM y{e} UNION SELECT o FROM y{e}))",
        ]
        last.append(f"SELECT CAST({e} AS BIGINT) AS epoch, {lr!r}::DOUBLE AS lr, round((SELECT avg(-ln(p)) FROM p{e} WHERE k = y), 6) AS train_loss, round((SELECT avg(CASE WHEN y = o THEN 1e0 ELSE 0e0 END) FROM y{e}), 6) AS val_acc, round((SELECT f FROM f{e}), 6) AS val_f1")
    return ",\n".join(out) + "\n" + "\nUNION ALL ".join(last)


FIT = head.HeadConfig(epochs=3, step=2)


@query(_history(FIT))
def j7_training_history(spark: SparkSession, d: str) -> DataFrame:
    """A record of each epoch of a short fit: the rate, the loss, and accuracy and macro F1 on the fifth that is kept out."""
    x = v.table(spark, d, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("features"), F.col("label").alias("y_true"))
    _, history = head.fit_softmax_head(x.where("key % 5 <> 0"), x.where("key % 5 = 0"), 10, FIT)
    rows = spark.createDataFrame(history, "epoch bigint, lr double, train_loss double, val_acc double, val_f1 double")
    return rows.select("epoch", "lr", *r6("train_loss", "val_acc", "val_f1"))


def fixed_weights() -> np.ndarray:
    """Three classes over 64 features and a constant."""
    k, i = np.mgrid[:3, :65]
    return ((k * 7 + i * 3) % 11 - 5) / 10.0


@query("SELECT vec_id AS key, CAST(k AS INTEGER) AS idx, round(list_sum(list_transform(range(64), lambda i: CAST(embedding[i + 1] AS DOUBLE) * (((k * 7 + i * 3) % 11 - 5) / 10e0))) + ((k * 7 + 192) % 11 - 5) / 10e0, 5) AS score FROM (SELECT *, unnest(range(3)) AS k FROM embeddings)")
def j8_score(spark: SparkSession, d: str) -> DataFrame:
    x = head.score(v.table(spark, d, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("features")), fixed_weights())
    return x.select("key", F.posexplode("scores").alias("idx", "score")).withColumn("score", F.round("score", 5))


@query(""", f AS (SELECT run_id, min(ord) AS bad FROM v_stages WHERE exit_code <> 0 GROUP BY run_id)
SELECT run_id, CAST(count(*) AS BIGINT) AS n_stages, CAST(max(exit_code) AS BIGINT) AS code, round(sum(duration), 6) AS seconds, max(ord) = count(*) AS in_order,
  arg_max(CASE ord WHEN 1 THEN 'fetch' WHEN 2 THEN 'split' WHEN 3 THEN 'resize' WHEN 4 THEN 'validate' WHEN 5 THEN 'train' ELSE 'evaluate' END, ord) AS last FROM v_stages LEFT JOIN f USING (run_id) WHERE bad IS NULL OR ord <= bad GROUP BY run_id""", "v_stages")
def j9_run_ledger(spark: SparkSession, d: str) -> DataFrame:
    return ledger.run_ledger(v.v_stages(spark, d)).select("run_id", "n_stages", "code", *r6("seconds"), "in_order", F.element_at("stages", -1)["stage"].alias("last"))
