"""Operator 2: token counts from an exact length histogram.

Documents are encoded once, in a narrow pass, and grouped by encoded length with partial
sums. From the histogram suffix sums answer, for every context limit that is a length in
it: how many documents and tokens there are at that length or more, what is left of all
documents if each is cut at the limit, and which quantile the limit is. Limits between two
lengths follow from the next larger one.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import others, packed, saved, with_types

#: A public byte-level BPE vocabulary as ranks; the path is a parameter.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-tokenization pattern that goes with that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Lengths of one bucket of the suffix sums.
BUCKET = 1024

#: Fixed value: what the pattern calls white space.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space characters in a row before another character over which a text is cut: the encoder fails over some hundred thousand.
LONG = 10_000

_ENCODERS: dict[int, object] = {}


def encoder(vocabulary: bytes, pattern: str = PATTERN):
    """The encoder of a file of base64 tokens and ranks; made once in a process."""
    import tiktoken

    key = hash((vocabulary, pattern))
    if key not in _ENCODERS:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        _ENCODERS[key] = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def pieces(text: str, long: int = LONG) -> list[str]:
    """text cut so that the pieces' tokens are those of the whole.

    Of a run of white space before another character the pattern takes all but the last as
    one part, and the last goes with what follows or is a part by itself. So a long run may be
    cut before its first and its last character: alone, it is one part too.
    """
    out, at = [], 0
    for run in re.finditer(f"[{BLANKS}]{{{long},}}", text):
        if run.end() == len(text):
            break
        out += [text[at : run.start()], text[run.start() : run.end() - 1]]
        at = run.end() - 1
    return [*out, text[at:]]


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """docs(text, ...) with n_tokens, the encoded length of the whole text; null text has 0. Whole texts of any length, special tokens are ordinary text. A column named n_tokens, in whatever case, is replaced."""
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, about a megabyte
    rows = packed(docs, others(docs, "n_tokens"))
    place = next(i for i, f in enumerate(rows.schema["row"].dataType.fields) if f.name.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sum(len(enc.encode_ordinary(p)) for p in pieces(x.as_py() or "")) for x in b.column(0).field(place)], pa.int64())], ["row", "n_tokens"])

    return rows.mapInArrow(run, with_types(rows, "n_tokens bigint")).select("row.*", "n_tokens")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs), one row a distinct length; null lengths are left out."""
    return lengths.where("n_tokens is not null").groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def limits(histogram: DataFrame) -> DataFrame:
    """A row for each length L of the histogram(n_tokens, n_docs).

    docs_from, tokens_from: documents of L tokens or more, and their tokens; kept_tokens:
    all tokens if documents are cut at L; share_up_to: the share of documents of at most L,
    so the quantile q is the smallest L with share_up_to >= q. An empty histogram gives none.
    Suffix sums are taken within buckets of BUCKET lengths, and over the buckets' sums.
    """
    h = histogram.withColumn("bucket", F.expr(f"n_tokens div {BUCKET}")).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    sums = h.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = W.partitionBy(F.lit(1)).orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(1))
    sums = sums.select("bucket", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_later"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_later"), F.sum("d").over(everything).alias("all_d"), F.sum("t").over(everything).alias("all_t"))
    own = W.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, 0)
    x = h.join(sums, "bucket").withColumns({"docs_from": F.sum("n_docs").over(own) + F.col("d_later"), "tokens_from": F.sum("tokens").over(own) + F.col("t_later")})
    return x.select("n_tokens", "n_docs", "docs_from", "tokens_from", (F.col("all_t") - F.col("tokens_from") + F.col("docs_from") * F.col("n_tokens")).alias("kept_tokens"), ((F.col("all_d") - F.col("docs_from") + F.col("n_docs")) / F.col("all_d")).alias("share_up_to"))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """limits() over the encoded lengths of docs(text); the histogram is written once."""
    return limits(saved(length_histogram(token_lengths(docs.select("text"), vocabulary))))
