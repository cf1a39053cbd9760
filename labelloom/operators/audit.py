"""Rule-based data-quality audit: findings with severities, an ok flag, a summary and a gate.

Each rule is a column that is null or struct(code, severity, detail). A wrong extension
ends a file's checks; an unreadable file gets no pixel rules and no duplicate check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import basename, has_extension, label_parent
from ..plans.scan import left_join_by_group
from ..plans.scratch import saved, small
from ..sources.tree import decode_images, in_fewer_tasks
from .images import data_stats

CODES = {"BAD_EXT": "error", "BAD_LABEL": "error", "TINY_FILE": "warning", "UNREADABLE": "error", "NOT_RGB": "error", "BAD_SIZE": "error", "ALL_BLACK": "error", "ALL_WHITE": "error", "LOW_STD": "warning", "DUPLICATE": "warning"}


@dataclass(frozen=True)
class Config:
    """What the rules compare with; strict checks stored channels, dup_check looks for equal contents. exts None: the defaults."""

    exts: str | None = None
    min_file_bytes: int = 1024
    size: int = 224
    low_std: float = 3.0
    strict: bool = False
    dup_check: bool = False


def rule(code: str, when: Column, detail: Column) -> Column:
    return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(CODES[code]).alias("severity"), detail.cast("string").alias("detail")))


def pixel_stats(df: DataFrame, pixels: str = "px") -> DataFrame:
    """df with px_min, px_max and px_std (population) of an array of pixel values; all null for null or empty."""
    px = F.transform(pixels, lambda v: v.cast("double"))
    n = F.nullif(F.size(pixels), F.lit(0))
    mean = F.aggregate(px, F.lit(0.0), lambda a, v: a + v) / n
    df = df.withColumns({"px_min": F.array_min(pixels), "px_max": F.array_max(pixels), "px_mean": mean})
    var = F.aggregate(px, F.lit(0.0), lambda a, v: a + (v - F.col("px_mean")) * (v - F.col("px_mean"))) / n
    return df.withColumn("px_std", F.sqrt(var)).drop("px_mean")


def first_copies(df: DataFrame, digest: str = "digest", path: str = "path", among: Column | None = None) -> DataFrame:
    """df with first_path: the smallest path with the same digest where this row is a later copy, else null.

    Digests are counted with partial sums, and only those that occur twice are joined back, the
    most frequent ones by broadcast: a digest may be that of any share of all files.
    """
    rows = df if among is None else df.where(among)
    twice = saved(rows.where(F.col(digest).isNotNull()).groupBy(digest).agg(F.min(path).alias("_first"), F.count("*").alias("_n")).where("_n > 1"))
    out = left_join_by_group(df, twice, digest, "_n", F.col(path))
    ok = F.col("_first").isNotNull() & (F.col(path) != F.col("_first"))
    ok = ok if among is None else ok & among
    return out.withColumn("first_path", F.when(ok, F.col("_first"))).drop("_first", "_n")


def with_rules(files: DataFrame, vocab: DataFrame, cfg: Config) -> DataFrame:
    """files(path, name, label, bytes, readable, n_channels, height, width, px_min, px_max, px_std, digest) with found, an array of findings, and ok.

    A null measure fires no rule but readable, which counts as false. ok: readable, of
    three channels where strict, of the right size and not of one colour; labels,
    warnings and duplicates do not matter to it.
    """
    known = small(vocab.select(F.col("label").alias("_label")).distinct().withColumn("_known", F.lit(True)))
    x = files.join(known, F.col("label") == F.col("_label"), "left").drop("_label")
    ext_ok, readable = F.coalesce(has_extension("name", cfg.exts), F.lit(False)), F.coalesce("readable", F.lit(False))
    seen = ext_ok & readable
    x = first_copies(x, among=seen) if cfg.dup_check else x.withColumn("first_path", F.lit(None).cast("string"))
    rgb = (F.col("n_channels") == 3) if cfg.strict else F.lit(True)
    sized = (F.col("height") == cfg.size) & (F.col("width") == cfg.size)
    black, white = F.col("px_max") == 0, (F.col("px_min") == 255)
    rules = [
        rule("BAD_EXT", ~ext_ok, F.col("name")),
        rule("BAD_LABEL", ext_ok & F.col("_known").isNull(), F.col("label")),
        rule("TINY_FILE", ext_ok & (F.col("bytes") < cfg.min_file_bytes), F.col("bytes")),
        rule("UNREADABLE", ext_ok & ~readable, F.lit("")),
        rule("NOT_RGB", seen & ~rgb, F.col("n_channels")),
        rule("BAD_SIZE", seen & ~sized, F.concat_ws("x", F.col("width").cast("string"), F.col("height").cast("string"))),
        rule("ALL_BLACK", seen & black, F.lit("")),
        rule("ALL_WHITE", seen & white & ~F.coalesce(black, F.lit(False)), F.lit("")),
        rule("LOW_STD", seen & (F.col("px_std") < cfg.low_std), F.lit("")),
        rule("DUPLICATE", seen & F.col("first_path").isNotNull(), F.col("first_path")),
    ]
    flat = F.coalesce(black | white, F.lit(False))
    return x.withColumns({"found": F.array_compact(F.array(*rules)), "ok": F.coalesce(seen & rgb & sized & ~flat, F.lit(False))}).drop("_known", "first_path")


def audit_tree(spark: SparkSession, root: str, vocab: DataFrame, cfg: Config) -> DataFrame:
    """with_rules() over every file below root; a file's class is the folder that it lies in, and paths are relative to root.

    Contents are read once for their digest and once to decode them; what meets by path are
    narrow rows, which are written. A root without files gives an empty table.
    """
    plain = lambda path: F.regexp_replace(path, "^([a-z][a-z0-9]*):/+", "$1:/")
    files = in_fewer_tasks(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root))
    files = files.select(plain("path").alias("path"), basename("path").alias("name"), label_parent("path").alias("label"), F.col("length").alias("bytes"), F.sha1("content").alias("digest"))
    decoded = data_stats(decode_images(spark, root)).withColumn("path", plain("path"))
    full = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = full.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(full).toString()
    below = F.substring("path", F.length(plain(F.lit(full.rstrip("/")))) + 2, F.length("path"))
    # the duplicate check reads the rows twice, which must not read the files twice
    return with_rules(saved(files.join(decoded, "path", "left").withColumn("path", below)), vocab, cfg)


def findings(audited: DataFrame) -> DataFrame:
    """(path, code, severity, detail)."""
    return audited.select("path", F.inline("found"))


def validation_summary(audited: DataFrame, cfg: Config) -> DataFrame:
    """One row: scanned (all files), ok, errors and warnings (findings), per_class (json map of readable files by label, unknown labels too)."""
    count = lambda s: F.sum(F.size(F.filter("found", lambda f: f["severity"] == s)))
    totals = audited.agg(F.count("*").alias("scanned"), F.count_if("ok").alias("ok"), F.coalesce(count("error"), F.lit(0)).alias("errors"), F.coalesce(count("warning"), F.lit(0)).alias("warnings"))
    seen = audited.where(F.coalesce(has_extension("name", cfg.exts), F.lit(False)) & F.coalesce("readable", F.lit(False)))
    classes = seen.groupBy("label").agg(F.count("*").alias("n")).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "n")))))).alias("per_class"))
    return totals.crossJoin(classes)


def gate(summary: DataFrame, fail_on: str = "error") -> DataFrame:
    """summary with passed: no errors, or no errors and warnings, or always."""
    bad = {"error": F.col("errors") > 0, "warning": F.col("errors") + F.col("warnings") > 0, "never": F.lit(False)}[fail_on]
    return summary.withColumn("passed", ~bad)


def duplicate_groups(df: DataFrame, digest: str = "digest", path: str = "path") -> DataFrame:
    """(digest, n, first_path) of contents that occur more than once."""
    return df.groupBy(digest).agg(F.count("*").alias("n"), F.min(path).alias("first_path")).where("n > 1")

