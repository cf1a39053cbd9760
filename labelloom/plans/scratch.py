"""Intermediate tables in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: No table of more rows than this is broadcast, by a count made beforehand.
BROADCAST_ROWS = 200_000
_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A new path in the folder of spark.checkpoint.dir, which every executor has to see. Where it is unset, local mode gets a folder of its own; a cluster has no folder that would do."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-"))
    return f"{shared.rstrip('/')}/labelloom-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    path = scratch_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, by the file system that it is in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that saved() wrote. Only for those that nothing will read again: what was made of them has to be written already."""
    for t in tables:
        for path in {f.rpartition("/")[0] for f in t.inputFiles()}:
            remove_path(t.sparkSession, path)


def small(df: DataFrame) -> DataFrame:
    """df, marked for broadcast if a count shows that it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df
