"""Operator 10: SimHash near-duplicates, candidates by pigeonring filtering.

A 64-bit fingerprint is a ring of four 16-bit segments. If two fingerprints differ in at
most three bits, some segment starts a chain in which every prefix of l segments differs
in at most 3 * l / 4 bits: 0, then 1, 2 and 3 in all. The first two links are an equality
on 32 bits: a fingerprint is filed under (start, first segment, second segment), and looked
up under each variant with one set bit of the second segment cleared; when the second
segments differ in one bit, exactly one of the two has it set, so every such pair meets
once per start. The remaining links are checked on those that meet, before the full
Hamming distance. Work is on distinct fingerprints only.

Texts that share four fifths of their five-word shingles (Jaccard) can differ in more bits
than that, too many for any filter on 64 bits. For dropping near copies, similar_links()
finds them all as well, by a prefix filter on the shingle sets: in any order of all
shingles, similar sets share one of the first fifth of each. Rare ones come first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, joined_by_group, packed, partitions, saved, shingle_hashes, with_types, words

DIFFERING = 3
#: Groups above this size are dealt out in pairs of blocks.
BLOCK = 8192
#: Similar texts: Jaccard similarity of sets of WIDE-word shingles, as numerator and denominator.
SHARE, WIDE = (4, 5), 5
#: Shingles that OFTEN or more texts of a sample of one in SAMPLE have are taken last; so many are known at most.
SAMPLE, OFTEN, MOST_OFTEN = 16, 4, 1_000_000
#: One in so many shingles links what it can before the others are looked at.
FIRST_OF = 8
#: Rows are sent on in batches of so many.
GATHER = 1 << 17
#: The sketch of a shingle set has at least so many bits, and over twice the set's size; a power of two.
SKETCH = 256
#: Ids are broadcast up to so many.
SMALL_IDS = 1_000_000
#: Up to this group size pairs are compared by shifts over many groups at once.
SMALL = 32


def fingerprint(text: str | None, k: int = 3) -> int:
    """SimHash over XXH64 (seed 42) of k-word shingles: a bit is 1 if set in over half of them; no words give 0."""
    hs = shingle_hashes(words(text), k)
    if not hs:
        return 0
    ones = np.zeros(64, np.int64)
    raw = np.array(hs, ">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(raw), 1 << 16):
        ones += np.unpackbits(raw[at : at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hs)).tobytes(), "big")


def fingerprints(docs: DataFrame, columns: list[str], k: int = 3) -> DataFrame:
    """(row, fp): the columns, text among them or doc_id alone, as a struct, and the fingerprint of text as a signed long."""
    with_text = any(c.lower() == "text" for c in columns)
    rows = packed(docs, columns) if with_text else packed(docs, columns, text=F.col("text"))
    place = next((i for i, f in enumerate(rows.schema["row"].dataType.fields) if f.name.lower() == "text"), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1) if place is None else b.column(0).field(place)
            fp = np.array([fingerprint(x.as_py(), k) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["row", "fp"])

    return rows.mapInArrow(run, with_types(rows.select("row"), "fp bigint"))


def _chain_ok(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """x: differences (xor) rotated so that the chain starts at the top 16 bits. Every prefix within its budget."""
    count, ok = np.zeros(len(x), np.uint8), np.ones(len(x), bool)
    for budget, shift in enumerate((48, 32, 16, 0)):
        count = count + np.bitwise_count((x >> np.uint64(shift)) & np.uint64(0xFFFF))
        ok &= count <= budget * DIFFERING // 3
    return ok


def _rotate(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    left = (start * 16).astype(np.uint64)
    return (x << left) | np.where(left == 0, np.uint64(0), x >> ((np.uint64(64) - left) & np.uint64(63)))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, own, fp): each fingerprint's own four keys, and those with one set bit of the second segment cleared."""
    for b in batches:
        for at in range(0, b.num_rows, 1 << 15):
            fp = b.column(0).slice(at, 1 << 15).to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(4):
                top = _rotate(fp, np.full(len(fp), start)) >> np.uint64(32)
                keys, owners = [top], [fp]
                for bit in range(16):
                    has = (top >> np.uint64(bit)) & np.uint64(1) == 1
                    keys.append(top[has] ^ np.uint64(1 << bit))
                    owners.append(fp[has])
                key = (np.concatenate(keys) | np.uint64(start << 32)).view(np.int64)
                own = np.arange(len(key)) < len(fp)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own), pa.array(np.concatenate(owners).view(np.int64))], ["key", "own", "fp"])


def _group_edges(fp: np.ndarray, own: np.ndarray, start: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of a large group's links: one vector of distances for each member taken up, at most one edge a member."""
    left = np.ones(len(fp), bool)
    where = np.full(len(fp), start)
    stack: list[int] = []
    while True:
        if not stack:
            rest = np.flatnonzero(left & own)
            if not len(rest):
                return
            stack.append(int(rest[0]))
            left[rest[0]] = False
        i = stack.pop()
        near = np.flatnonzero(left if own[i] else left & own)
        near = near[_chain_ok(_rotate(fp[near] ^ fp[i], where[near]), where[near])]
        if len(near):
            left[near] = False
            stack += near.tolist()
            yield np.full(len(near), fp[i]), fp[near]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, part, own, fp), sorted by key and part: verified links a < b of every group."""
    rest: list[np.ndarray] | None = None

    def edges(key: np.ndarray, part: np.ndarray, own: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
        size = np.diff(np.append(cut, len(key)))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        group = np.repeat(np.arange(len(cut)), size)
        for shift in range(1, min(SMALL, int(size.max())) if len(size) else 0):
            i = np.flatnonzero((group[shift:] == group[:-shift]) & (size[group[shift:]] <= SMALL) & (own[shift:] | own[:-shift]))
            x = _rotate(fp[i] ^ fp[i + shift], key[i] >> 32)
            i = i[_chain_ok(x, key[i])]
            found.append((fp[i], fp[i + shift]))
        for g in np.flatnonzero(size > SMALL):
            s = slice(cut[g], cut[g] + size[g])
            found += _group_edges(fp[s], own[s], int(key[cut[g]] >> 32))
        if found:
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        now[3] = now[3].view(np.uint64)
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now)]
        key, part = now[0], now[1]
        if not len(key):
            continue
        last = int(np.argmax((key == key[-1]) & (part == part[-1])))  # the last group may go on in the next batch
        yield from edges(*(x[:last] for x in now))
        rest = [x[last:] for x in now]
    if rest is not None:
        yield from edges(*rest)


def links(nodes: DataFrame) -> DataFrame:
    """nodes(fp long, distinct): links (a, b) that connect all fingerprints at DIFFERING or fewer bits.

    In groups of up to SMALL members every link is returned, in larger ones a spanning
    forest, so that the number of links stays in proportion to the input while no two
    fingerprints that link end in different components. Keys with more than BLOCK members
    are dealt out as pairs of blocks, so that no task holds a whole hot group.
    """
    n = partitions(nodes.sparkSession)
    keyed = saved(nodes.mapInArrow(_variants, "key bigint, own boolean, fp bigint"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("any_own")).where("n > 1 and any_own")
    rows = keyed.join(counts.select("key", "n"), "key")
    blocks = F.expr(f"cast(ceil(n / {BLOCK}) as int)")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    # block pairs (i <= j), numbered i * blocks + j
    parts = F.when(blocks == 1, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: (F.least(mine, other) * blocks + F.greatest(mine, other)).cast("int")))
    dealt = rows.select("key", F.explode(parts).alias("part"), "own", "fp")
    return dealt.repartition(n, "key", "part").sortWithinPartitions("key", "part").mapInArrow(_linked, "a bigint, b bigint")


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct 64-bit hashes of a text's WIDE-word shingles, ascending."""
    return np.unique(np.array(shingle_hashes(words(text), WIDE), np.uint64))


def _gathered(pieces: Iterator[list[np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of GATHER rows or more, and a last one, from the columns of many small pieces."""
    held: list[list[np.ndarray]] = []
    rows = 0
    for x in pieces:
        held.append(x)
        rows += len(x[0])
        if rows >= GATHER:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)
            held, rows = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text): a row for each distinct shingle of each."""
    yield from _gathered(([shingle_set(t.as_py()).view(np.int64)] for b in batches for t in b.column(0)), ["token"])


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rid, fp, text): the size of the text's shingle set, a digest of it, and its sketch: in each bit the parity of how many shingles fall there. Texts without words are left out."""

    def fact(text: str | None) -> tuple[int, bytes, np.ndarray]:
        s = shingle_set(text)
        bits = max(SKETCH, 1 << (2 * len(s)).bit_length())
        parity = np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) % 2 == 1
        return len(s), xxhash.xxh128_digest(s.tobytes()), np.packbits(parity).view(np.int64)

    for b in batches:
        n, digest, sketch = zip(*[fact(t.as_py()) for t in b.column(2)]) if b.num_rows else ((), (), ())
        out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int32()), pa.array(digest, pa.binary()), pa.array(list(sketch), pa.list_(pa.int64()))], ["rid", "fp", "n", "digest", "sketch"])
        yield out.filter(pa.array([k > 0 for k in n], pa.bool_()))


def _often(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that OFTEN or more of a sample of one text in SAMPLE have, ascending, and in how many; where over MOST_OFTEN qualify, the more frequent ones.

    They only decide in which order shingles are taken, and so the cost: any order finds every pair.
    """
    tokens = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(_shingle_rows, "token bigint")
    counts, least = saved(tokens.groupBy("token").agg(F.count("*").alias("c")).where(F.col("c") >= OFTEN)), OFTEN
    while counts.where(F.col("c") >= least).count() > MOST_OFTEN:
        least *= 2
    t = counts.where(F.col("c") >= least).toArrow()
    token, c = t.column(0).to_numpy().view(np.uint64), t.column(1).to_numpy()
    order = np.argsort(token)
    return token[order], c[order]


def prefix(s: np.ndarray, often: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first n - ceil(4/5 n) + 1 of the n shingles s, by (how often sampled, hash), and how often they were.

    Two sets of similarity SHARE share ceil(4/5 n) or more of either's n shingles, so the
    first shingle that they share lies within the prefix of both.
    """
    c = np.zeros(len(s), np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, s), len(often) - 1)
        c = np.where(often[at] == s, count[at], 0)
    first = np.lexsort((s, c))[: len(s) + (-SHARE[0] * len(s)) // SHARE[1] + 1]
    return s[first], c[first]


def _prefixes(often: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rid, text): (token, part, rid, n, pos) for each shingle of the prefix. Those that more than BLOCK texts should have are dealt out as pairs of blocks, as in links()."""
    known, count = often.value

    def rows(rid: int, text: str | None) -> list[np.ndarray]:
        s = shingle_set(text)
        token, c = prefix(s, known, count)
        blocks = np.maximum(1, -(-c * SAMPLE // BLOCK))
        pos = np.repeat(np.arange(len(token)), blocks)
        other = np.arange(len(pos)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        mine, blocks = (xxhash.xxh32_intdigest(rid.to_bytes(8, "big")) % blocks)[pos], blocks[pos]
        part = np.minimum(mine, other) * blocks + np.maximum(mine, other)
        return [token[pos].view(np.int64), part, np.full(len(pos), rid, np.int64), np.full(len(pos), len(s), np.int32), pos.astype(np.int32)]

    yield from _gathered((rows(r.as_py(), t.as_py()) for b in batches for r, t in zip(b.column(0), b.column(1))), ["token", "part", "rid", "n", "pos"])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Rows sorted by their first two columns (token, part): the columns in pieces of whole groups, where groups begin, and their sizes; groups of one are left out."""
    rest: list[np.ndarray] | None = None

    def piece(now: list[np.ndarray]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        edge = (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])
        keep = ~(np.concatenate([[True], edge]) & np.concatenate([edge, [True]]))
        now = [x[keep] for x in now]
        if len(now[0]):
            cut = np.flatnonzero(np.concatenate([[True], (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])]))
            yield now, cut, np.diff(np.append(cut, len(now[0])))

    for batch in batches:
        now = [c.to_numpy() for c in batch.columns]
        now = now if rest is None else [np.concatenate(x) for x in zip(rest, now)]
        if not len(now[0]):
            continue
        last = int(np.argmax((now[0] == now[0][-1]) & (now[1] == now[1][-1])))  # the last group may go on in the next batch
        if last:
            yield from piece([x[:last] for x in now])
        rest = [x[last:] for x in now]
    if rest is not None:
        yield from piece(rest)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of groups of two or more."""
    for now, _, _ in _whole_groups(batches):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in now], ["token", "part", "rid", "n", "pos"])


def _crossing(every: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, part, rid, n, pos, root, low, high), sorted by token, part and n: all pairs of a group (or only those that follow each other) in different components whose sizes, shingles left from here on, and small sketches allow SHARE.

    Where a pair meets at the first shingle that it shares, nothing before counts; parities
    differ in at most as many bits as the sets in shingles. So no similar pair is lost.
    """
    p, q = SHARE

    def pairs() -> Iterator[list[np.ndarray]]:
        for (_, _, rid, n, pos, root, low, high), cut, size in _whole_groups(batches):
            n, left = n.astype(np.int64), (n - pos).astype(np.int64)
            low, high = low.view(np.uint64), high.view(np.uint64)

            def allowed(i: np.ndarray, j: np.ndarray) -> list[np.ndarray]:
                ok = (root[i] != root[j]) & (q * n[i] >= p * n[j]) & ((p + q) * np.minimum(left[i], left[j]) >= p * (n[i] + n[j]))  # noqa: B023
                i, j = i[ok], j[ok]
                apart = np.bitwise_count(low[i] ^ low[j]).astype(np.int64) + np.bitwise_count(high[i] ^ high[j])  # noqa: B023
                ok = (p + q) * apart <= (q - p) * (n[i] + n[j])  # noqa: B023
                a, b = rid[i][ok], rid[j][ok]  # noqa: B023
                return [np.minimum(a, b), np.maximum(a, b)]

            group = np.repeat(np.arange(len(cut)), size)
            for shift in range(1, min(SMALL, int(size.max())) if every else 2):
                i = np.flatnonzero((group[shift:] == group[:-shift]) & (not every or size[group[shift:]] <= SMALL))
                yield allowed(i, i + shift)
            for g in np.flatnonzero(size > SMALL) if every else ():
                for i in range(cut[g], cut[g] + size[g] - 1):
                    j = np.arange(i + 1, cut[g] + size[g])
                    yield allowed(np.full(len(j), i), j)

    yield from _gathered(pairs(), ["a", "b"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 256):
            x = b.slice(at, 256)
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array([shingle_set(t.as_py()).view(np.int64) for t in x.column(1)], pa.list_(pa.int64()))], ["rid", "s"])


def _ids(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= SMALL_IDS else ids


def _halved(x: Column, size: Column) -> Column:
    """The sketch x as one of size longs, if it has twice as many: parities of halves add up."""
    return F.when(F.size(x) > size, F.zip_with(F.slice(x, F.lit(1), size), F.slice(x, size + 1, size), lambda low, high: low.bitwiseXOR(high))).otherwise(x)


def _verified(pairs: DataFrame, docs: DataFrame, facts: DataFrame) -> DataFrame:
    """Of pairs (a, b) of rids, those of similarity SHARE or more, as links of fingerprints. Sizes of a pair have passed _crossing()."""
    p, q = SHARE
    side = lambda x: facts.select(F.col("rid").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("fp", "n", "sketch")])
    # parities differ in at most as many bits as the sets in shingles: that is at most (q - p) / (q + p) of both sizes
    size = F.least(F.size("sketch_a"), F.size("sketch_b"))
    parts = F.zip_with(_halved(F.col("sketch_a"), size), _halved(F.col("sketch_b"), size), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(parts, F.lit(0), lambda s, x: s + x)
    near = pairs.distinct().join(side("a"), "a").join(side("b"), "b").where(apart * (q + p) <= (F.col("n_a") + F.col("n_b")) * (q - p))
    near = saved(near.select("a", "b", "fp_a", "fp_b"))
    ids = _ids(saved(near.select(F.col("a").alias("rid")).union(near.select("b")).distinct()))
    sets = saved(docs.join(ids, "rid", "left_semi").mapInArrow(_shingle_sets, "rid bigint, s array<bigint>"))
    both = near.join(sets.select(F.col("rid").alias("a"), F.col("s").alias("s_a")), "a").join(sets.select(F.col("rid").alias("b"), F.col("s").alias("s_b")), "b")
    shared = F.size(F.array_intersect("s_a", "s_b"))
    return saved(both.where(q * shared >= p * (F.size("s_a") + F.size("s_b") - shared)).select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")).distinct())


def similar_links(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows(rid, fp, text), rid distinct: links (a, b) of fingerprints that, with edges (those of links()), connect all texts of Jaccard similarity SHARE or more.

    Equal shingle sets link at once and one of each goes on. Similar sets share a shingle of
    their prefixes. Of those that share one, neighbours are verified first, by one shingle in
    FIRST_OF and then by all; then every pair that is still in different components is. So a
    large group is one component before its pairs are looked at. Each link is verified on
    whole sets.
    """
    n = partitions(rows.sparkSession)
    facts = saved(rows.select("rid", "fp", "text").mapInArrow(_facts, "rid bigint, fp bigint, n int, digest binary, sketch array<bigint>"))
    equal = saved(facts.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("rid", "fp")).alias("one")).where("n > 1"))
    same = facts.join(equal.select("digest", "one"), "digest")
    edges = saved(edges.unionByName(same.select(F.col("fp").alias("a"), F.col("one.fp").alias("b")).where("a <> b").distinct()))
    others = _ids(saved(same.where("rid <> one.rid").select("rid")))
    docs = rows.select("rid", "text").join(others, "rid", "left_anti")
    often = rows.sparkSession.sparkContext.broadcast(_often(docs))
    keyed = docs.mapInArrow(partial(_prefixes, often), "token bigint, part bigint, rid bigint, n int, pos int")
    groups = saved(keyed.repartition(n, "token", "part").sortWithinPartitions("token", "part").mapInArrow(_repeated, keyed.schema))

    def folded(half: int) -> Column:
        """Every second long of the sketch, folded into one: parities add up."""
        return F.aggregate(F.filter("sketch", lambda _, i: i % 2 == half), F.lit(0).cast("bigint"), lambda a, x: a.bitwiseXOR(x))

    def crossing(roots: DataFrame, groups: DataFrame, every: bool) -> DataFrame:
        of = saved(facts.select("rid", "fp", folded(0).alias("low"), folded(1).alias("high")).join(roots, F.col("fp") == F.col("node"), "left").select("rid", F.coalesce("root", "fp").alias("root"), "low", "high"))
        rooted = groups.join(_ids(of), "rid").select("token", "part", "rid", "n", "pos", "root", "low", "high")
        pairs = rooted.repartition(n, "token", "part").sortWithinPartitions("token", "part", "n", "rid").mapInArrow(partial(_crossing, every), "a bigint, b bigint")
        return _verified(pairs, docs, facts)

    some = groups.where(F.pmod("token", F.lit(FIRST_OF)) == 0)
    for taken, every in ((some, False), (groups, False), (groups, True)):
        edges = saved(edges.unionByName(crossing(components(edges), taken, every)))
    return edges


def near_components(rows: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """rows(doc_id, fp), and links (a, b) of fingerprints, those of links() if not given: one row (fp, root, component_id) a distinct fingerprint; component_id is the smallest doc_id reachable, root a fingerprint of the component."""
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(saved(links(nodes.select("fp")) if edges is None else edges))
    joined = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    joined = saved(joined)
    least = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    return joined.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, k: int = 3) -> DataFrame:
    """One row a document: doc_id, fingerprint (16 lowercase hex digits), component_id.

    Null and empty texts have fingerprint zero and link like any other. Rows with the same
    doc_id each count. component_id is the smallest non-null doc_id of the component, null
    only if all are null. Other columns are not read, whatever their names. An empty table
    gives an empty table.
    """
    rows = saved(fingerprints(docs, ["doc_id"], k).select("row.doc_id", "fp"))
    of = saved(near_components(rows))
    sizes = rows.groupBy("fp").agg(F.count("*").alias("n"))
    of = saved(of.select("fp", "component_id").join(sizes, "fp"))
    return joined_by_group(rows, of, "fp", "n", rows.count()).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, k: int = 3, similar: bool = True) -> DataFrame:
    """docs with one row of each component: the smallest doc_id (null last), of rows equal in that any one.

    Fingerprints link at DIFFERING or fewer bits; with similar, texts of Jaccard similarity SHARE or more link as well.
    All columns are kept as they are, whatever their names. An empty table gives an empty table.
    """
    rows = saved(fingerprints(docs, docs.columns, k).withColumn("rid", F.monotonically_increasing_id()))
    narrow = rows.select("rid", "fp", F.col("row.doc_id").alias("doc_id"))
    edges = similar_links(rows.select("rid", "fp", F.col("row.text").alias("text")), saved(links(narrow.select("fp").distinct()))) if similar else None
    of = near_components(narrow, edges)
    # the first of each fingerprint, then of each component
    first = narrow.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"))
    best = saved(first.join(of, "fp").groupBy("root").agg(F.min("first").alias("best")).select("best.rid"))
    return rows.join(_ids(best), "rid", "left_semi").select("row.*")
