"""Class-structured folders as tables, and splits written as partitioned tables."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import basename, extensions, has_extension, label_first, suffix
from ..plans.scratch import saved

#: Fixed value: how a PNG file begins.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
FILES = "path string, root string, label string, name string, ext string, length bigint, content binary"
#: How many of the partitions that Spark deals files out in, 32 small ones each, make a task.
PARTITIONS = 32


def _missing(spark: SparkSession, root: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def in_fewer_tasks(files: DataFrame) -> DataFrame:
    """files as they were read, with PARTITIONS of their partitions to a task, but four tasks a core if there are enough.

    Spark counts 4 MB for opening a file, so that no more than 32 of them make a partition; a task for each costs more than small files take to read.
    """
    some = files.rdd.getNumPartitions()
    return files.coalesce(max(1, 4 * files.sparkSession.sparkContext.defaultParallelism, some // PARTITIONS))


def class_files(files: DataFrame, root: str) -> DataFrame:
    """files(path, ...): with root, label (first folder below root), name and ext; files that lie in root itself are dropped."""
    base = F.lit(root.rstrip("/"))
    labelled = files.withColumn("root", base).withColumn("label", label_first("path", base))
    return labelled.where("label is not null").withColumn("name", basename("path")).withColumn("ext", suffix("path"))


def scan_class_tree(spark: SparkSession, root: str, exts: str | list[str] | None = "all") -> DataFrame:
    """Every file under root/<class>/, nested ones too. A root that does not exist gives an empty table. content is read only if it is used."""
    if _missing(spark, root):
        return spark.createDataFrame([], FILES)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    allowed = extensions(exts)
    if allowed is not None and len(allowed) == 1:
        letters = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in min(allowed))
        reader = reader.option("pathGlobFilter", "*" + letters)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return class_files(in_fewer_tasks(reader.load(root)), full).where(has_extension("path", exts)).select("path", "root", "label", "name", "ext", "length", "content")


def filter_ext(df: DataFrame, exts: str | list[str] | None = None, name: str = "name") -> DataFrame:
    return df.where(has_extension(name, exts))


def decode_images(spark: SparkSession, root: str) -> DataFrame:
    """path, height, width, n_channels, data (BGR, row-major) and readable; a file that cannot be decoded is kept with readable false."""
    image = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(root)
    return in_fewer_tasks(image).select(F.col("image.origin").alias("path"), "image.height", "image.width", F.col("image.nChannels").alias("n_channels"), "image.data", (F.col("image.height") > 0).alias("readable"))


def png(height: int, width: int, data: bytes) -> bytes:
    """BGR pixels, row by row, as a PNG file of eight bits a channel; lossless."""
    rgb = np.frombuffer(data, np.uint8).reshape(height, width, 3)[:, :, ::-1]
    lines = np.hstack([np.zeros((height, 1), np.uint8), rgb.reshape(height, 3 * width)]).tobytes()
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def write_images(df: DataFrame, root: str) -> DataFrame:
    """Write each image of df(label, name, height, width, data) to root/<label>/<name>.png, and return (label, name, path, bytes) of the files.

    An image without data becomes a file that has a signature and nothing else, which cannot be read.
    Tasks write to the file system of root, a local one or one that pyarrow knows. A task
    that runs again writes the same files. Labels and names must not be null.
    """
    base = root if re.match(r"[a-z][a-z0-9]*:/", root) else f"file://{root}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pa_fs.FileSystem.from_uri(base)
        made = set()
        for b in batches:
            paths, sizes = [], []
            for label, name, h, w, data in zip(*[b.column(c).to_pylist() for c in ("label", "name", "height", "width", "data")]):
                if label not in made:
                    fs.create_dir(f"{folder}/{label}", recursive=True)
                    made.add(label)
                body = png(h, w, data) if data else SIGNATURE
                with fs.open_output_stream(f"{folder}/{label}/{name}.png") as f:
                    f.write(body)
                paths.append(f"{base.rstrip('/')}/{label}/{name}.png")
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("name"), pa.array(paths), pa.array(sizes, pa.int64())], ["label", "name", "path", "bytes"])

    named = df.select(F.col("label").cast("string").alias("label"), F.col("name").cast("string").alias("name"), "height", "width", "data")
    return saved(named.mapInArrow(run, "label string, name string, path string, bytes bigint"))


def count_by_root(df: DataFrame, roots: list[str]) -> DataFrame:
    """(root, n) for each of roots, 0 where there is no row."""
    wanted = df.sparkSession.createDataFrame([(r,) for r in roots], "root string")
    return wanted.join(df.groupBy("root").agg(F.count("*").alias("n")), "root", "left").select("root", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def write_split(df: DataFrame, path: str, clear: bool = False) -> None:
    """df(split, label, ...) as a table partitioned by both; clear empties it first, else rows accumulate."""
    df.write.partitionBy("split", "label").mode("overwrite" if clear else "append").parquet(path)
