"""Schemas of the tables that operators read and write; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

VOCAB = T.StructType([T.StructField("idx", T.IntegerType()), T.StructField("label", T.StringType())])
IMAGE_DATA = "height int, width int, data binary"
FINDING = "struct<code:string,severity:string,detail:string>"
POINTER = "kind string, dataset string, payload map<string,string>, written_at timestamp"
