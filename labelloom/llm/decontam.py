"""Operator 6: benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by size. Items of fewer than K words have shingles of their own
width, so that they are found inside long documents too; all others have K-word shingles.
An item of n distinct shingles is contained at threshold t if the document holds at least
ceil(t * n) of them, so at most n - ceil(t * n) are missing. Its sketch is its bottom-m
MinHash values, and m is set for each size partition to one more than the most that may be
missing in it: a document that contains the item holds at least one value of the sketch,
however long it is. The largest sketch value of a partition bounds what can be in its
sketches, so a document's sketch for it is its hashes up to that bound. Sketches meet, and
candidates are verified by exact shingle containment; the search loses nothing.

Hashes of shingles combine the words' XXH64 in numpy. Items are broadcast, at most
BLOCK_WORDS words of them at a time; documents pass once for each such block.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import others, packed, saved, shingles, text_of, words

K, THRESHOLD = 5, 0.8
#: Words of benchmark text in one broadcast index at most (some 10 bytes each); an item longer than that is one by itself.
BLOCK_WORDS = 4_000_000
LEAK = "array<struct<item_id:bigint,n_shared:bigint,n_item:bigint>>"
_LEAKS = pa.list_(pa.struct([("item_id", pa.int64()), ("n_shared", pa.int64()), ("n_item", pa.int64())]))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)


def sketch_size(n: int, threshold: float = THRESHOLD) -> int:
    """Bottom-m size for the partition of n (sizes 2^j to 2^(j+1) - 1): one more than the most shingles missing in it."""
    largest = 2 ** n.bit_length() - 1
    return min(n, largest - math.ceil(threshold * largest - 1e-9) + 1)


def word_hashes(ws: list[bytes]) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w, 42) for w in ws), np.uint64, len(ws))


def minhashes(w: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` words, from the words' hashes."""
    n = len(w) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = np.zeros(n, np.uint64)
    for i in range(width):
        x = (x ^ (x >> np.uint64(31))) * _ODD[i % 5] + w[i : i + n]
    x = (x ^ (x >> np.uint64(29))) * _ODD[0]
    return x ^ (x >> np.uint64(32))


@dataclass
class Index:
    """Items (item_id, words); for each width the sketch values, ascending, with their items, and each size partition's bound."""

    items: list[tuple[int, list[bytes]]] = field(default_factory=list)
    sketches: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    bounds: dict[int, np.uint64] = field(default_factory=dict)


def index(items: list[tuple[int, list[bytes]]], k: int = K, threshold: float = THRESHOLD) -> Index:
    out = Index(items)
    values: dict[int, list[np.ndarray]] = defaultdict(list)
    owners: dict[int, list[np.ndarray]] = defaultdict(list)
    for i, (_, ws) in enumerate(items):
        if ws:
            width = min(k, len(ws))
            hs = np.unique(minhashes(word_hashes(ws), width))
            hs = hs[: sketch_size(len(hs), threshold)]
            values[width].append(hs)
            owners[width].append(np.full(len(hs), i, np.int32))
    for width in values:
        v, o = np.concatenate(values[width]), np.concatenate(owners[width])
        order = np.argsort(v, kind="stable")
        out.sketches[width] = v[order], o[order]
        out.bounds[width] = v[order[-1]]
    return out


def contained(text: str | None, at: Index, own: object, k: int = K, threshold: float = THRESHOLD) -> list[dict]:
    """Items of which text holds at least the threshold's share of distinct shingles; own(i): the distinct shingles of item i."""
    ws = words(text)
    w = word_hashes(ws)
    found: set[int] = set()
    for width, (values, owners) in at.sketches.items():
        x = minhashes(w, width)
        x = x[x <= at.bounds[width]]  # the document's sketch
        low, high = np.searchsorted(values, x, "left"), np.searchsorted(values, x, "right")
        for a, b in set(zip(low[low < high].tolist(), high[low < high].tolist())):
            found.update(owners[a:b].tolist())
    out = []
    have: dict[int, set[bytes]] = {}
    for i in sorted(found):
        item_id, item = at.items[i]
        width = min(k, len(item))
        if width not in have:
            have[width] = set(shingles(ws, width))
        n, shared = len(own(i)), len(own(i) & have[width])
        if shared >= threshold * n - 1e-9:
            out.append({"item_id": item_id, "n_shared": shared, "n_item": n})
    return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items in the order of their ids, BLOCK_WORDS words at a time; at least one block."""
    block: list[tuple[int, list[bytes]]] = []
    size, first = 0, True
    for r in benchmark.select("item_id", text_of().alias("text")).orderBy("item_id", "text").toLocalIterator():
        ws = words(r["text"])
        if block and size + len(ws) > BLOCK_WORDS:
            yield block
            block, size, first = [], 0, False
        block.append((r["item_id"], ws))
        size += len(ws)
    if block or first:
        yield block


def _passed(rows: DataFrame, at: Index, k: int, threshold: float) -> DataFrame:
    """rows(row, leaks): with the items of one block added to leaks, by row.text."""
    shared = rows.sparkSession.sparkContext.broadcast(at)
    place = next(i for i, f in enumerate(rows.schema["row"].dataType.fields) if f.name.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        own = lru_cache(4096)(lambda i: frozenset(shingles(at.items[i][1], min(k, len(at.items[i][1])))))
        for b in batches:
            found = [contained(x.as_py(), at, own, k, threshold) for x in b.column(0).field(place)]
            found = [old + new for old, new in zip(b.column(1).to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _LEAKS)], ["row", "leaks"])

    return rows.mapInArrow(run, rows.schema)


def _leaks(docs: DataFrame, columns: list[str], benchmark: DataFrame, k: int, threshold: float) -> DataFrame:
    """(row, leaks). With several blocks the rows are written in between, so that one index is alive at a time."""
    rows = packed(docs, columns, leaks=F.array().cast(LEAK))
    for number, block in enumerate(_blocks(benchmark)):
        rows = _passed(saved(rows) if number else rows, index(block, k, threshold), k, threshold)
    return rows


def with_leaks(docs: DataFrame, benchmark: DataFrame, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """docs(doc_id, text, ...) with a column leaks: array of (item_id, n_shared, n_item) contained in the whole text.

    Words lie between ASCII white space, with A-Z in lower case. An item of fewer than k
    words is one shorter shingle, found wherever its words follow each other; items and
    texts without words (null, empty) match nothing. Repeated items each count. Rows are all
    kept, null doc_ids and repeated rows too, in a narrow pass. A column named leaks, in
    whatever case, is replaced. An empty benchmark gives empty arrays.
    """
    return _leaks(docs, others(docs, "leaks"), benchmark, k, threshold).select("row.*", "leaks")


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (doc_id, item_id, n_shared, n_item) of documents and the test items that they contain, as in with_leaks(). Repeated rows each give their pairs; a null doc_id stays null."""
    return _leaks(docs, ["doc_id", "text"], benchmark, k, threshold).select("row.doc_id", F.inline("leaks"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that contain a test item, as in with_leaks(). All columns are kept as they are, whatever their names."""
    return _leaks(docs, docs.columns, benchmark, k, threshold).where(F.size("leaks") == 0).select("row.*")
