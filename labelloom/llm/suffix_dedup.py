"""Operator 4: removal of long repeated substrings by suffix order and longest-previous-factor arrays.

A start is removed for if the string of LENGTH bytes from it on occurs elsewhere. In suffix
order, the longest match of a suffix with one that starts earlier is with the nearest
suffix before or after it in that order that starts earlier: its previous or next smaller
position. The least of the LCPs in between, taken over both, is the longest previous factor,
and the string has an earlier copy where that reaches LENGTH. The same over mirrored
positions finds later copies.

The order is built in parts that Spark deals out. Each string belongs to the smallest hash
among its GRAM-byte substrings, its anchor, so equal strings share their anchor, and a text
falls into runs of starts with one anchor. Anchors that occur once hold no repeat. Runs with
one anchor and equal bytes (by digest) repeat each other in every start, and one of them
goes on. Where an anchor has several different runs, their bytes are dealt out by anchor,
and each task puts their suffixes in order by prefix doubling. An anchor with more than
SLICE bytes of different runs is not put into one task: its runs are cut by longer
substrings instead, up to LENGTH itself, where each start stands alone and equal ones
meet by digest, with partial sums.

Passages that documents share are often shorter than LENGTH bytes. They are found beside
the removal, by the same order over words in place of bytes: runs of word positions meet by
anchors of WORD_GRAM words, equal runs by digest, and different ones under one anchor are
ordered by their first PASSAGE words, where neighbours of equal rank share them.

Texts are worked on once each, however many copies they have. They are shuffled once,
compressed, into a table bucketed by digest, which the later joins read without a shuffle.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, partitions, remove_path, saved, scratch_dir, text_of

LENGTH, GRAM = 400, 64
#: Words of a shared passage (over 50), and of the substrings of it that anchors are taken from.
PASSAGE, WORD_GRAM = 51, 16
#: Bytes of runs that are ordered at a time, and at most for an anchor in one task. Positions in them are packed into POSITION bits.
SLICE, POSITION = 1 << 20, 20
#: Starts that are cut into runs at a time.
CHUNK = 1 << 19
#: Bytes of the substrings that are put in order first, and doubled from there.
FIRST = 5

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64, kept for the largest n so far."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        p = np.full(n, np.uint64(base), np.uint64)
        p[:1] = 1
        have = _POWERS[base] = np.cumprod(p)
    return have[:n]


def _hashes(data: np.ndarray, low: np.ndarray | slice, high: np.ndarray | slice) -> np.ndarray:
    """A mixed 64-bit polynomial hash of each data[low:high]. It only says where strings meet, never that they are equal."""
    n = len(data)
    up, down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(up * (data.astype(np.uint64) + np.uint64(1)), out=sums[1:])
    h = (sums[high] - sums[low]) * down[low]
    for k in (0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD):
        h ^= h >> np.uint64(32)
        h *= np.uint64(k)
    return h ^ (h >> np.uint64(32))


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """The hash of each substring of that width."""
    n = len(data)
    return _hashes(data, slice(0, n - width + 1), slice(width, n + 1)) if n >= width else np.zeros(0, np.uint64)


def sliding_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` consecutive values."""
    n = len(h)
    rows = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    rows[:n] = h
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(rows, axis=1).ravel()
    return np.minimum(ahead[: n - width + 1], behind[width - 1 : n])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, end to end, and where each value begins and the last ends."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def runs(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of texts laid end to end: (text, first start, number of starts, anchor, whether the anchor occurs in it again) of each run of starts with one anchor.

    No run is longer than length - gram + 1 starts; with gram equal to length every start is a run.
    """
    span = length - gram + 1
    for low in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[low : low + CHUNK + length - 1]
        grams = window_hashes(part, gram)
        anchor = sliding_minimum(grams, span)
        start = np.arange(low, low + len(anchor))
        text = np.searchsorted(at, start, side="right") - 1
        inside = start + length <= at[text + 1]
        cut = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]) & inside
        first = np.flatnonzero(cut)
        if not len(first):
            continue
        # the starts of a text that are inside come before those that are not
        good = np.concatenate([[0], np.cumsum(inside)])
        n = good[np.append(first[1:], len(anchor))] - good[first]
        # a periodic text is one long run: pieces of one length are equal but for where they begin in the period
        pieces = -(-n // span)
        which = np.repeat(np.arange(len(first)), pieces)
        ahead = (np.arange(len(which)) - (np.cumsum(pieces) - pieces)[which]) * span
        first, n = first[which] + ahead, np.minimum(span, n[which] - ahead)
        twice = np.zeros(len(first), bool)
        for k in range(0, len(first) if span > 1 else 0, 4096):
            f, m, v = first[k : k + 4096, None], n[k : k + 4096], anchor[first[k : k + 4096], None]
            left = f[:, 0] + (grams[f + np.arange(span)] == v).argmax(1)
            right = f[:, 0] + m + span - 2 - (grams[f + m[:, None] + span - 2 - np.arange(span)] == v).argmax(1)
            twice[k : k + 4096] = left != right
        yield text[first], start[first] - at[text[first]], n, anchor[first], twice


_RUN = "anchor bigint, context binary, text binary, ord bigint, s bigint, n int, twice boolean"
#: The same over words: s and n count them, ord is 1 if the run is known to be in another text, size counts bytes.
_WORD_RUN = "anchor bigint, context binary, text binary, ord bigint, s bigint, n int, size bigint"


def _worded(data: bytes) -> bytes:
    """The words of a text, between ASCII white space, each with one space after it."""
    return b" ".join([*data.split(), b""])


def _edges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of words with a space after each: where they begin and end."""
    end = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return np.append(0, end + 1)[:-1], end


def _laid(rows: Iterator[tuple]) -> Iterator[tuple[bytes, np.ndarray, list[tuple]]]:
    """(bytes, ...) in groups of some CHUNK bytes: end to end, where each begins and the last ends, and what else is in the rows."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[0])
        if size >= CHUNK:
            yield b"".join(r[0] for r in held), np.cumsum([0, *(len(r[0]) for r in held)]), [r[1:] for r in held]
            held, size = [], 0
    if held:
        yield b"".join(r[0] for r in held), np.cumsum([0, *(len(r[0]) for r in held)]), [r[1:] for r in held]


def _found(rows: Iterator[tuple], length: int, gram: int, words: bool) -> Iterator[pa.RecordBatch]:
    """Rows (bytes, text, ord, where the bytes begin in the text): their runs, of bytes or of words."""
    names = [c.split()[0] for c in (_WORD_RUN if words else _RUN).split(", ")]
    for data, at, of in _laid(rows):
        view = memoryview(data)
        digest = lambda low, high: hashlib.blake2b(view[low:high], digest_size=16).digest()  # noqa: B023, E731
        symbols = np.frombuffer(data, np.uint8)
        if words:
            begin, end = _edges(data)
            symbols, at = _hashes(symbols, begin, end), np.searchsorted(begin, at)
        for text, s, n, anchor, twice in runs(symbols, at, length, gram):
            low = at[text] + s
            high = low + n + length - 1
            if words:
                low, high = begin[low], end[high - 1] + 1
            context = [digest(a, b) for a, b in zip(low.tolist(), high.tolist())]
            who = [of[i] for i in text.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(context, pa.binary()), pa.array([w[0] for w in who], pa.binary()), pa.array([w[1] for w in who], pa.int64()), pa.array(s + np.array([w[2] for w in who])), pa.array(n.astype(np.int32)), pa.array(high - low if words else twice)],
                names,
            )


def _runs_of_texts(length: int, gram: int, words: bool = False):
    """Rows (text, ord, z): the runs of each text."""
    form = _worded if words else bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        yield from _found(((form(unpack(z.as_py())), t.as_py(), o.as_py(), 0) for b in batches for t, o, z in zip(*b.columns)), length, gram, words)

    return run


def _runs_of_runs(length: int, gram: int, words: bool = False):
    """Rows (text, ord, s, bytes): the runs, by a longer gram, of each run's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _found(((x.as_py(), t.as_py(), o.as_py(), s.as_py()) for b in batches for t, o, s, x in zip(*b.columns)), length, gram, words)

    return run


def _contexts(length: int, words: bool = False):
    """Rows (text, z, runs): each run with the bytes that its strings cover."""
    names = ["anchor", "ord", "text", "s", "n", "hot", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for text, z, rs in zip(*b.columns):
                data, text, rs = unpack(z.as_py()), text.as_py(), rs.as_py()
                if words:
                    data = _worded(data)
                    begin, end = _edges(data)
                for at in range(0, len(rs), 1024):
                    part = rs[at : at + 1024]
                    columns = [[r[c] for r in part] for c in ("anchor", "ord", "s", "n", "hot")]
                    if words:
                        cut = [data[begin[s] : end[s + n + length - 2] + 1] for s, n in zip(*columns[2:4])]
                    else:
                        cut = [data[s : s + n + length - 1] for s, n in zip(*columns[2:4])]
                    arrays = [pa.array(x, t) for x, t in zip([*columns[:2], [text] * len(part), *columns[2:], cut], (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()))]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _ranked(key: np.ndarray) -> np.ndarray:
    """The rank of each key (below 2 ** 40) among the different ones."""
    x = np.sort((key << POSITION) | np.arange(len(key)))
    new = np.concatenate([[0], (x[1:] >> POSITION) != (x[:-1] >> POSITION)])
    rank = np.empty(len(key), np.int64)
    rank[x & ((1 << POSITION) - 1)] = np.cumsum(new)
    return rank


def _later(x: np.ndarray, by: int) -> np.ndarray:
    """x from `by` places on, with zeros after its end."""
    out = np.zeros_like(x)
    out[: len(x) - by] = x[by:]
    return out


def suffix_ranks(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Prefix doubling: (width, the rank of each substring of that width by its bytes), up to length. At most 2 ** POSITION bytes; substrings that pass the end count as filled with zeros."""
    width = min(FIRST, length)
    key = np.zeros(len(data), np.int64)
    for i in range(width):
        key = (key << 8) | _later(data.astype(np.int64), min(i, len(data)))
    return _doubled(width, key, length)


def _doubled(width: int, key: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """suffix_ranks() from keys (below 2 ** 40) of the substrings of the first width."""
    out = [(width, _ranked(key))]
    while width < length:
        step = min(width, length - width)
        rank = out[-1][1]
        out.append((width + step, _ranked((rank << POSITION) | _later(rank, min(step, len(key))))))
        width += step
    return out


def common_prefixes(data: np.ndarray, ranks: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """LCPs, at most the last width of ranks, of the substrings that begin at a and at b."""
    length, last = ranks[-1][0], len(data) - 1
    off = np.zeros(len(a), np.int64)
    for width, rank in reversed(ranks):
        at, bt = np.minimum(a + off, last), np.minimum(b + off, last)
        off += width * ((rank[at] == rank[bt]) & (off + width <= length))
    open_ = np.ones(len(a), bool)
    for _ in range(ranks[0][0] - 1):
        at, bt = a + off, b + off
        open_ &= (off < length) & (at <= last) & (bt <= last)
        open_ &= data[np.minimum(at, last)] == data[np.minimum(bt, last)]
        off += open_
    return off


def longest_previous_factor(position: np.ndarray, lcp: np.ndarray, least: int = 1) -> np.ndarray:
    """For suffixes in order, with their positions and each one's LCP with the one before it: the longest match with an earlier position.

    Previous and next smaller positions are found for all at once: whoever points at a larger
    position takes over where that one points, with the least LCP on the way. Matches shorter
    than `least` are not followed and may come out shorter than they are.
    """

    def previous(position: np.ndarray, lcp: np.ndarray) -> np.ndarray:
        to, low = np.arange(len(position)) - 1, lcp.copy()
        low[:1] = 0
        while True:
            i = np.flatnonzero((low >= least) & (position[to] > position))
            if not len(i):
                return np.where(low >= least, low, 0)
            j = to[i]
            low[i], to[i] = np.minimum(low[i], low[j]), to[j]

    back = previous(position[::-1], np.append(lcp[1:], 0)[::-1])[::-1]
    return np.maximum(previous(position, lcp), back)


def repeated_starts(data: np.ndarray, start: np.ndarray, length: int, later_only: bool) -> np.ndarray:
    """Of starts in data, in the order in which they come in the corpus: whether the string of `length` bytes has an earlier copy (or a later one, unless later_only)."""
    ranks = suffix_ranks(data, length)
    order = np.sort((ranks[-1][1][start] << POSITION) | np.arange(len(start))) & ((1 << POSITION) - 1)
    lcp = np.concatenate([[0], common_prefixes(data, ranks, start[order[:-1]], start[order[1:]])])
    flag = np.zeros(len(start), bool)
    flag[order] = longest_previous_factor(order, lcp, length) >= length
    if not later_only:
        flag[order] |= longest_previous_factor(-order, lcp, length) >= length
    return flag


def _spans(own: np.ndarray, offset: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of flagged consecutive starts: (run, first offset, last offset)."""
    i = np.flatnonzero(flag)
    if not len(i):
        return i, i, i
    new = np.concatenate([[True], (np.diff(i) > 1) | (own[i[1:]] != own[i[:-1]])])
    first, last = i[new], i[np.append(np.flatnonzero(new)[1:] - 1, len(i) - 1)]
    return own[first], offset[first], offset[last]


def _order(length: int, later_only: bool):
    """Rows (anchor, ord, text, s, n, bytes), sorted by the first four: spans (text, b, e) to remove."""

    def spans(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, at = _flat(batch.column(5))
        n = batch.column(4).to_numpy().astype(np.int64)
        own = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(own)) - (np.cumsum(n) - n)[own]
        run, first, last = _spans(own, offset, repeated_starts(data, at[:-1][own] + offset, length, later_only))
        if len(run):
            s = batch.column(3).to_numpy()[run]
            yield pa.RecordBatch.from_arrays([batch.column(2).take(pa.array(run)), pa.array(s + first), pa.array(s + last + length)], ["text", "b", "e"])

    return _by_anchor(spans)


def _meet(length: int):
    """Rows (anchor, ord, text, s, n, bytes) of words, sorted by anchor: texts with `length` words that another text has as well."""

    def met(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = _flat(batch.column(5))[0].tobytes().split()
        n = batch.column(4).to_numpy().astype(np.int64)
        own = np.repeat(np.arange(len(n)), n)
        start = np.arange(len(own)) + (length - 1) * own
        rank = _doubled(1, pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64), length)[-1][1][start]
        order = np.argsort(rank, kind="stable")
        rank, text = rank[order], batch.column(2).dictionary_encode().indices.to_numpy()[own[order]]
        first = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
        shared = np.minimum.reduceat(text, first) != np.maximum.reduceat(text, first)
        shared |= np.maximum.reduceat(batch.column(1).to_numpy()[own[order]], first) > 0
        hit = np.unique(own[order[np.repeat(shared, np.diff(np.append(first, len(rank))))]])
        if len(hit):
            yield pa.RecordBatch.from_arrays([batch.column(2).take(pa.array(hit)).unique()], ["text"])

    return _by_anchor(met)


def _by_anchor(work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]):
    """Rows (anchor, ord, text, s, n, bytes), sorted by anchor: what work makes of them. An anchor's runs are ordered together; small anchors are put together up to SLICE bytes."""

    def sliced(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not sum(p.num_rows for p in parts):
            return
        table = pa.Table.from_batches(parts)
        anchor = table.column(0).to_numpy()
        ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
        size = np.concatenate([[0], np.cumsum(pc.binary_length(table.column(5)).to_numpy().astype(np.int64))])
        at = 0
        while at < len(anchor):
            whole = np.flatnonzero((ends > at) & (size[ends] - size[at] <= SLICE))
            to = int(ends[whole[-1]])
            yield from work(table.slice(at, to - at).combine_chunks().to_batches()[0])  # SLICE bytes are one batch
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column(0).to_numpy()
            last = int(np.argmax(anchor == anchor[-1]))  # the last anchor may go on in the next batch
            if not last and (not rest or rest[-1].column(0)[-1].as_py() == anchor[-1]):
                rest.append(batch)
                continue
            yield from sliced([*rest, batch.slice(0, last)])
            rest = [batch.slice(last)]
        yield from sliced(rest)

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, data, id): data compressed."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([pack(x.as_buffer()) for x in b.column(1)], pa.binary()), b.column(2)], ["text", "z", "id"])


def _cut(length: int, later: bool, words: int | None):
    """Rows (text, copied, z, spans, shared): what is left of each text."""
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for low in range(0, b.num_rows, 256):
                out = []
                for text, copied, z, spans, shared in zip(*b.slice(low, 256).columns):
                    data, copied = unpack(z.as_py()), copied.as_py()
                    merged: list[list[int]] = [[0, len(data)]] if copied and not later and len(data) >= length else []
                    for x in [] if merged else sorted((x["b"], x["e"]) for x in spans.as_py() or ()):
                        if merged and x[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], x[1])
                        else:
                            merged.append(list(x))
                    kept, at = [], 0
                    for s, e in merged:
                        kept.append(data[at:s])
                        at = e
                    kept = b"".join([*kept, data[at:]])
                    passage = shared.as_py() or bool(words and copied and len(data.split()) >= words)
                    out.append((text.as_py(), len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), passage, kept))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], ["text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "shares_passage", "kept"])

    return run


def _text(column: Column) -> Column:
    """The number of a text: half of its SHA-256."""
    return F.substring(F.unhex(F.sha2(column, 256)), 1, 16)


def grams(length: int, gram: int) -> list[int]:
    """Lengths of the substrings that anchors are taken from, one level after the other: what a run of one level has too many starts for falls into some four of the next."""
    out = [gram]
    while out[-1] < length:
        out.append(length - (length - out[-1]) // 4)
    return out


def _level(texts: DataFrame, found: DataFrame, length: int, later: bool, slice_bytes: int, last: bool) -> tuple[DataFrame, DataFrame | None, list[DataFrame]]:
    """Of saved runs: spans to remove (text, b, e), the runs (with bytes) of anchors that are too large for a task, and tables to delete."""
    n = partitions(texts.sparkSession)
    often = saved(found.groupBy("anchor").agg(F.count("*").alias("times"), F.max("twice").alias("again")).where("times > 1 or again").select("anchor"))
    again = saved(found.join(often, "anchor"))
    discard(found, often)
    mine = F.struct("ord", "text", "s")
    classes = saved(again.groupBy("anchor", "context").agg(F.count("*").alias("members"), F.min(mine).alias("head"), F.first("n").alias("n"), F.max("twice").alias("twice")))
    # equal runs: all of their starts are repeated
    equal = again.join(classes.where("members > 1").select("anchor", "context", "head"), ["anchor", "context"])
    equal = equal.where(mine != F.col("head")) if later else equal
    spans = saved(equal.select("text", F.col("s").alias("b"), (F.col("s") + F.col("n") + (length - 1)).alias("e")))
    if last:
        return spans, None, [again, classes]
    kinds = classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(F.col("n") + (length - 1)).alias("size"), F.max("twice").alias("again")).where("kinds > 1 or again").select("anchor", (F.col("size") > slice_bytes).alias("hot"))
    heads = classes.join(kinds, "anchor").groupBy("head.text").agg(F.collect_list(F.struct("anchor", F.col("head.ord").alias("ord"), F.col("head.s").alias("s"), "n", "hot")).alias("runs"))
    context = saved(texts.join(heads, "text").select("text", "z", "runs").mapInArrow(_contexts(length), "anchor bigint, ord bigint, text binary, s bigint, n int, hot boolean, bytes binary"))
    dealt = context.where(~F.col("hot")).select("anchor", "ord", "text", "s", "n", "bytes").repartition(n, "anchor").sortWithinPartitions("anchor", "ord", "text", "s")
    ordered = saved(dealt.mapInArrow(_order(length, later), "text binary, b bigint, e bigint"))
    hot = context.where("hot").select("text", "ord", "s", "bytes")
    return spans.unionByName(ordered), None if hot.isEmpty() else hot, [again, classes, context]


def _shared(texts: DataFrame, words: int, gram: int, slice_bytes: int) -> tuple[DataFrame, list[DataFrame]]:
    """Of different texts(text, z): those (text) with a run of `words` words that another one has as well, and tables to delete."""
    n, levels = partitions(texts.sparkSession), grams(words, gram)
    source = texts.select("text", F.lit(0).cast("bigint").alias("ord"), "z").mapInArrow(_runs_of_texts(words, gram, True), _WORD_RUN)
    out, over = None, []
    for level, size in enumerate(levels):
        found = saved(source)
        often = saved(found.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor"))
        again = saved(found.join(often, "anchor"))
        discard(found, often)
        classes = again.groupBy("anchor", "context").agg(F.min(F.struct("text", "s")).alias("head"), F.max("text").alias("other"), F.max("ord").alias("ord"), F.first("n").alias("n"), F.first("size").alias("size"))
        classes = saved(classes.withColumn("ord", F.greatest("ord", (F.col("head.text") != F.col("other")).cast("bigint"))).drop("other"))
        over += [again, classes]
        # equal runs of different texts
        hits = again.join(classes.where("ord > 0").select("anchor", "context"), ["anchor", "context"]).select("text").distinct()
        if size < words:
            kinds = classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("size").alias("size"), F.min("ord").alias("least")).where("kinds > 1 and least = 0").select("anchor", (F.col("size") > slice_bytes).alias("hot"))
            heads = classes.join(kinds, "anchor").groupBy("head.text").agg(F.collect_list(F.struct("anchor", "ord", F.col("head.s").alias("s"), "n", "hot")).alias("runs"))
            context = saved(texts.join(heads, "text").select("text", "z", "runs").mapInArrow(_contexts(words, True), "anchor bigint, ord bigint, text binary, s bigint, n int, hot boolean, bytes binary"))
            dealt = context.where(~F.col("hot")).select("anchor", "ord", "text", "s", "n", "bytes").repartition(n, "anchor").sortWithinPartitions("anchor")
            hits = hits.unionByName(dealt.mapInArrow(_meet(words), "text binary"))
            over.append(context)
        out = hits if out is None else out.unionByName(hits)
        hot = None if size == words else context.where("hot").select("text", "ord", "s", "bytes")
        if hot is None or hot.isEmpty():
            break
        source = hot.mapInArrow(_runs_of_runs(words, levels[level + 1], True), _WORD_RUN)
    return out.distinct(), over


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, remove: str = "all", slice_bytes: int = SLICE, with_kept: bool = False, words: int | None = None, word_gram: int = WORD_GRAM) -> DataFrame:
    """A row for each of docs(doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, changed (with words shares_passage; and kept, the bytes left).

    Texts are UTF-8 bytes, null text is empty. Every byte is removed that lies in a string
    of `length` bytes which also starts elsewhere, in another text or the same one (with
    itself overlapping as well); remove="later" keeps the first of the equal strings, in the
    order of texts' smallest doc_id (null last), then of starts: texts that are copies of an
    earlier document go whole. changed says whether anything is removed. Texts shorter than
    length stay. Repeated rows, null doc_ids included, are copies of each other. Other columns
    of docs are not read, whatever their names. An empty table gives an empty table.

    shares_passage says whether a text has `words` words in a row, between ASCII white space
    of any kind, that another row's text has as well. It removes nothing.
    """
    spark = docs.sparkSession
    later = remove == "later"
    n = partitions(spark)
    docs = docs.select("doc_id", text_of().alias("text"))
    long_ = F.octet_length("text") >= min(length, 2 * words - 1 if words else length)
    # one row a text; grouping orders by text what is then written in its bucket
    table, path = f"labelloom_{uuid.uuid4().hex}", scratch_dir(spark)
    packed = docs.where(long_).select(_text(F.col("text")).alias("t"), F.col("text").cast("binary"), "doc_id").mapInArrow(_packed, "text binary, z binary, id bigint")
    texts = packed.groupBy("text").agg(F.first("z").alias("z"), F.count("*").alias("copies"), F.coalesce(F.min("id"), F.lit(2**63 - 1)).alias("first_id"))
    texts.write.bucketBy(n, "text").option("path", path).option("compression", "uncompressed").saveAsTable(table)
    texts = spark.table(table)

    # only the order of texts matters, and only where the first is kept
    source = texts.select("text", (F.col("first_id") if later else F.lit(0).cast("bigint")).alias("ord"), "z").mapInArrow(_runs_of_texts(length, gram), _RUN)
    spans, over = [], []
    levels = grams(length, gram)
    for level, size in enumerate(levels):
        own, hot, done = _level(texts, saved(source), length, later, slice_bytes, size == length)
        spans.append(own)
        over += done
        if hot is None:
            break
        source = hot.mapInArrow(_runs_of_runs(length, levels[level + 1]), _RUN)
    every = spans[0]
    for x in spans[1:]:
        every = every.unionByName(x)
    every = every.groupBy("text").agg(F.collect_list(F.struct("b", "e")).alias("spans"))
    left = texts.join(every, "text", "left").withColumn("shared", F.lit(False))
    if words:
        shared, done = _shared(texts.select("text", "z"), words, word_gram, slice_bytes)
        over += done
        left = left.drop("shared").join(shared.withColumn("shared", F.lit(True)), "text", "left")
    left = left.select("text", (F.col("copies") > 1).alias("copied"), "z", "spans", F.coalesce("shared", F.lit(False)).alias("shared"))
    left = left.mapInArrow(_cut(length, later, words), "text binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, shares_passage boolean, kept binary")
    left = saved(left if with_kept else left.drop("kept"))
    spark.sql(f"DROP TABLE {table}")
    remove_path(spark, path)
    discard(*over)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.expr("n_removed > 0").alias("changed"), *(["shares_passage"] if words else []), *(["kept"] if with_kept else [])]
    zero = F.lit(0).cast("bigint")
    short = docs.where(~long_).select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.lit(False).alias("shares_passage"), F.col("text").cast("binary").alias("kept"))
    rows = docs.where(long_).select("doc_id", _text(F.col("text")).alias("text"))
    if not later:
        return rows.join(left, "text").select(columns).unionByName(short.select(columns))
    # of the copies of a text only the first document keeps it, and of its repeated rows one
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()))
    first = rows.groupBy("text").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    gone = (F.col("row") != F.col("first.row")) & (F.col("n_bytes") >= length)
    out = rows.join(saved(first), "text").join(left, "text")
    out = out.withColumns({"n_removed": F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")), "n_spans": F.when(gone, 1).otherwise(F.col("n_spans")).cast("bigint"), "kept_sha256": F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256"))} | ({"kept": F.when(gone, F.lit(b"")).otherwise(F.col("kept"))} if with_kept else {}))
    return out.select(columns).unionByName(short.select(columns))
