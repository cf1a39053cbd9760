"""Operator 12: alignment of two tokenizers, with counts of linked pairs by minimal perfect hashing.

Each text is encoded by both; where tokens of both end at the same byte, groups are cut, and
all tokens of a group that come from different tokenizers are linked. How many documents
link a pair of ids is counted without a hash table: the distinct pairs get a minimal perfect
hash, built slice by slice, tasks count into dense vectors that it indexes, vectors are
summed as a tree, and a second pass aligns the documents again and looks the counts up.
Every lookup compares the key that is stored at its index.

Texts are encoded once; their ids are kept in a table, four bytes an id, with where groups end. Pairs are worked on at most
some PAIRS at a time, so that an index is of a bounded size: the id of the first tokenizer
says in which block a pair is, and documents pass once for each block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Public vocabularies; their paths are parameters.
BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs of a block, on average; of a slice of the hash; counts of one row of a vector; rows summed at once.
PAIRS, SLICE, CHUNK, FAN_IN = 1 << 22, 1 << 16, 1 << 16, 16
#: Characters that are encoded, and links that are looked at, at once.
CHARACTERS, LINKS = 1 << 18, 1 << 19
#: Bits a key on each level of the hash.
GAMMA = 2

#: Fixed value: the pattern by which byte-level vocabularies split texts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters in a row, with or without white space, over which texts are not given to the faster library.
LONG = 1000
_RUN = re.compile(rf"\s{{{LONG}}}|\S{{{LONG}}}")

_MADE: dict[int, tuple] = {}


def _of_bytes() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokenizers(a: bytes, b: bytes) -> tuple:
    """Both encoders, from the contents of their files, and the bytes of their tokens by id; made once in a process."""
    key = hash((a, b))
    if key not in _MADE:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        first = Tokenizer.from_str(a.decode())
        first.encode_special_tokens = True
        second = SentencePieceProcessor(model_proto=b)
        of, tokens = _of_bytes(), [b""] * first.get_vocab_size()
        for token, i in first.get_vocab().items():
            tokens[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        pieces = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(second.id_to_piece(list(range(second.get_piece_size()))))]
        _MADE[key] = FirstEncoder(a, first), second, tokens, pieces
    return _MADE[key]


def _twin(a: bytes):
    """The first vocabulary in a faster library, if it is a byte-level one of the plain kind: split by the usual pattern, nothing normalised, merges in the order of ids; else None."""
    import tiktoken

    given = json.loads(a)
    model, vocab = given["model"], given["model"]["vocab"]
    split = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if given["normalizer"] or {k: v for k, v in (given["pre_tokenizer"] or {}).items() if k in split} != split or model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    of = _of_bytes()
    if merged != list(range(256, len(vocab))) or not all(c in of for t in vocab for c in t):
        return None
    return tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks={bytes(of[c] for c in t): i for t, i in vocab.items()}, special_tokens={})


class FirstEncoder:
    """Ids of texts by the first vocabulary.

    Texts that both libraries split alike go to the faster one: those whose characters have
    had the same kind since Unicode 3.2, so that tables of any version agree, and that have
    no run of LONG characters with or without white space, over which one of them
    fails. The others go to the library that the file is of.
    """

    def __init__(self, a: bytes, plain):
        self.plain, self.twin = plain, _twin(a)
        self.same, self.other = set("\t\n\r"), set()

    def alike(self, text: str) -> bool:
        """Whether both libraries give text the same ids."""
        letters = set(text)
        for c in letters - self.same - self.other:
            kind = unicodedata.category(c)
            stable = unicodedata.ucd_3_2_0.category(c) == kind and kind[0] != "C"
            (self.same if stable else self.other).add(c)
        if not letters <= self.same:
            return False
        words = text.split()
        spare = len(text) - sum(map(len, words)) - len(words)  # white space beyond one character a word
        return max(map(len, words), default=0) < LONG and (spare < LONG - 2 or not _RUN.search(text))

    def ids(self, texts: list[str]) -> list[list[int]]:
        fast = [self.twin is not None and self.alike(t) for t in texts]
        slow = iter(self.plain.encode_batch_fast([t for t, f in zip(texts, fast) if not f], add_special_tokens=False))
        return [self.twin.encode_ordinary(t) if f else next(slow).ids for t, f in zip(texts, fast)]


#: The bit of a stored id that says whether its token ends a group.
CUT = 1 << 31


def encoded(docs: DataFrame, vocabularies: tuple[str, str] = (BYTE_VOCABULARY, PIECE_VOCABULARY)) -> DataFrame:
    """docs(doc_id, text): (rid, doc_id, a, b), the ids of " " + text by both, as integers of 32 bits, with CUT where tokens of both end. Texts that are null or empty, or whose tokens do not give the text back, have none."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(open(v, "rb").read() for v in vocabularies))  # two files of some megabytes
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, tokens, pieces = tokenizers(*shared.value)
        long_a, long_b = (np.array([len(x) for x in v], np.int64) for v in (tokens, pieces))
        for b in batches:
            texts, out_a, out_b = b.column("text").to_pylist(), [], []
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size < CHARACTERS:
                    size += len(texts[end] or "")
                    end += 1
                some = [t or "" for t in texts[at:end]]
                at = end
                x, y = first.ids([" " + t for t in some]), second.encode(some, num_threads=1)
                for i, t in enumerate(some):
                    data = f" {t}".encode()
                    if not (t and b"".join([pieces[k] for k in y[i]]) == data and b"".join([tokens[k] for k in x[i]]) == data):
                        x[i] = y[i] = ()
                marked = _marked(x, long_a, y, long_b)
                out_a += marked[0]
                out_b += marked[1]
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("doc_id"), pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["rid", "doc_id", "a", "b"])

    return rows.mapInArrow(run, f"rid bigint, doc_id {rows.schema['doc_id'].dataType.simpleString()}, a binary, b binary")


def _marked(a: list, long_a: np.ndarray, b: list, long_b: np.ndarray) -> list[list[bytes]]:
    """Some texts' ids by both as they are stored: CUT is added where a token of either ends at the same byte."""

    def flat(side: list) -> np.ndarray:
        ids = array("I")
        for x in side:
            ids.extend(x)
        return np.array(ids, np.uint32)

    x, y = flat(a), flat(b)
    ends_x, ends_y = np.cumsum(long_a[x]), np.cumsum(long_b[y])
    out = []
    for side, ids, cut in ((a, x, _found(ends_x, ends_y)), (b, y, _found(ends_y, ends_x))):
        ids[cut] |= np.uint32(CUT)
        data, to = ids.tobytes(), 4 * np.cumsum([len(v) for v in side])
        out.append([data[i:j] for i, j in zip([0, *to.tolist()], to.tolist())])
    return out


class Sizes:
    """How many ids both tokenizers have, and how an id is written: of the first one within and at the end of a group, then of the second."""

    def __init__(self, vocabularies: tuple[str, str]):
        _, _, tokens, pieces = tokenizers(*[open(v, "rb").read() for v in vocabularies])
        self.a, self.b = len(tokens), len(pieces)

    @cached_property
    def labels(self) -> np.ndarray:
        marked = ((self.a, (b",", b"|")), (self.b, (b",", b";")))
        return np.array([b"%d%s" % (i, mark) for n, marks in marked for mark in marks for i in range(n)], object)


class Aligned:
    """Some documents' tokens end to end: ids a and b, for each token its group and whether it ends it, and for each group its document and sizes."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        x, y = (np.frombuffer(b"".join(side), np.uint32) for side in (a, b))
        self.docs, self.n_a, self.n_b = len(a), np.array([len(t) for t in a], np.int64) // 4, np.array([len(t) for t in b], np.int64) // 4
        self.a, self.b = ((ids & np.uint32(CUT - 1)).astype(np.int64) for ids in (x, y))
        self.cut_a, self.cut_b = x >= CUT, y >= CUT
        self.group_a, self.group_b = np.cumsum(self.cut_a) - self.cut_a, np.cumsum(self.cut_b) - self.cut_b
        self.groups = int(self.cut_a.sum())
        self.p, self.q = np.bincount(self.group_a, minlength=self.groups), np.bincount(self.group_b, minlength=self.groups)
        self.doc = np.repeat(np.arange(self.docs), self.n_a)[self.cut_a]

    def links(self, blocks: int = 1, block: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(document, a, b, how often) of linked occurrences, some LINKS at a time, of the ids a that are in the block. Of a group with more than LINKS, equal ones are one row."""
        start_a, start_b = np.cumsum(self.p) - self.p, np.cumsum(self.q) - self.q
        product = self.p * self.q
        large = np.flatnonzero(product > LINKS)
        token = np.flatnonzero((self.a % blocks == block) & (product <= LINKS)[self.group_a]) if len(large) or blocks > 1 else np.arange(len(self.a))
        partners = self.q[self.group_a[token]]
        sums = np.cumsum(partners)
        at = 0
        while at < len(token):
            end = int(np.searchsorted(sums, (sums[at - 1] if at else 0) + LINKS, "right"))
            end = max(end, at + 1)
            some, n = token[at:end], partners[at:end]
            of = np.repeat(some, n)
            g = self.group_a[of]
            b = self.b[start_b[g] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)]
            yield self.doc[g], self.a[of], b, np.ones(len(of), np.int64)
            at = end
        for g in large:
            a, na = np.unique(self.a[start_a[g] : start_a[g] + self.p[g]], return_counts=True)
            b, nb = np.unique(self.b[start_b[g] : start_b[g] + self.q[g]], return_counts=True)
            mine = a % blocks == block
            a, na = a[mine], na[mine]
            step = max(1, LINKS // len(b))
            for i in range(0, len(a), step):
                x, n = np.repeat(a[i : i + step], len(b)), np.repeat(na[i : i + step], len(b))
                yield np.full(len(x), self.doc[g]), x, np.tile(b, len(x) // len(b)), n * np.tile(nb, len(x) // len(b))


def _found(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each of x is among the others; both in ascending order."""
    if not len(among):
        return np.zeros(len(x), bool)
    return among[np.minimum(np.searchsorted(among, x), len(among) - 1)] == x


def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """encoded()'s rows, together while they have fewer than LINKS ids, and aligned."""
    for batch in batches:
        lengths = np.array([len(x) + len(y) for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())])
        at = 0
        while at < batch.num_rows:
            n = max(1, int(np.searchsorted(np.cumsum(lengths[at:]), 4 * LINKS, "right")))
            rows = batch.slice(at, n)
            yield rows, Aligned(rows.column("a").to_pylist(), rows.column("b").to_pylist())
            at += n


# ---- the minimal perfect hash ----


def _spread(keys: np.ndarray, level: int) -> np.ndarray:
    """32 mixed bits of each key, others on each level."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(32)


def built(keys: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Of distinct keys: words of bits, level after level, the levels' numbers of bits, and the keys in the order of their indexes.

    On each level a key that has its bit for itself sets it; the others go on. A key's index is the number of bits set before its own.
    """
    words, bits, order = [], [], []
    left = np.sort(keys)
    while len(left):
        m = -(-max(64, GAMMA * len(left)) // 64) * 64
        at = (_spread(left, len(bits)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        alone = np.bincount(at, minlength=m) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        bits.append(m)
        mine = alone[at]
        order.append(left[mine][np.argsort(at[mine])])
        left = left[~mine]
    return np.concatenate([*words, np.zeros(0, np.uint64)]), bits, np.concatenate([*order, np.zeros(0, np.int64)])


class PerfectHash:
    """Indexes of pairs from 0 on without a gap, from the slices' (words, levels, keys), by slice; a key's slice is the rest of its division by their number."""

    def __init__(self, slices: list[tuple[np.ndarray, list[int], np.ndarray]]):
        self.slices = max(1, len(slices))
        levels = max((len(b) for _, b, _ in slices), default=0)
        self.bits = np.zeros((levels, self.slices), np.uint64)
        self.start = np.zeros((levels, self.slices), np.int64)
        at = 0
        for s, (_, bits, _) in enumerate(slices):
            for level, m in enumerate(bits):
                self.bits[level, s], self.start[level, s] = m, at
                at += m
        self.words = np.concatenate([*[w for w, _, _ in slices], np.zeros(1, np.uint64)])
        count = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(count) - count
        self.keys = np.concatenate([*[k for _, _, k in slices], np.zeros(0, np.int64)])

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; -1 for one that is not in the set."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level in range(len(self.bits)):
            k = keys[todo]
            s = k % self.slices
            at = self.start[level][s] + (_spread(k, level) * self.bits[level][s] >> np.uint64(32)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = ((word >> bit) & np.uint64(1)).astype(bool) & (self.bits[level][s] > 0)
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (self.before[at >> 6] + np.bitwise_count(below))[hit]
            todo = todo[~hit]
            if not len(todo):
                break
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        return np.where(known, out, -1)


def _distinct_pairs(tokens: DataFrame, sizes: Sizes) -> DataFrame:
    """(pair), a * |b's vocabulary| + b, of all links: distinct within a part of each task first, then over all."""
    width = sizes.b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros(0, np.int64)
        for _, x in aligned(batches):
            for _, a, b, _ in x.links():
                kept = np.union1d(kept, a * width + b)
                if len(kept) > LINKS:
                    yield pa.RecordBatch.from_arrays([pa.array(kept)], ["pair"])
                    kept = kept[:0]
        yield pa.RecordBatch.from_arrays([pa.array(kept)], ["pair"])

    return tokens.select("a", "b").mapInArrow(run, "pair bigint").distinct()


def perfect_hash(pairs: DataFrame, count: int) -> PerfectHash:
    """The hash of pairs(pair), distinct and at most `count`: slices are built by tasks, and come here as some 9 bytes a pair."""
    n = count // SLICE + 1

    def build(key: tuple, t: pa.Table) -> pa.Table:
        words, bits, keys = built(t["pair"].to_numpy())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "words": [words.tobytes()], "bits": pa.array([bits], pa.list_(pa.int64())), "keys": [keys.tobytes()]})

    made = pairs.withColumn("slice", F.pmod("pair", F.lit(n))).groupBy("slice").applyInArrow(build, "slice bigint, words binary, bits array<bigint>, keys binary")
    slices = [(np.zeros(0, np.uint64), [], np.zeros(0, np.int64))] * n
    for r in made.toLocalIterator():
        slices[r["slice"]] = np.frombuffer(r["words"], "<u8"), list(r["bits"]), np.frombuffer(r["keys"], np.int64)
    return PerfectHash(slices)


def _counts(tokens: DataFrame, sizes: Sizes, index, blocks: int, block: int) -> np.ndarray:
    """In how many documents each pair of the index is linked: a dense vector a task, summed FAN_IN at a time."""
    width = sizes.b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = index.value
        total = np.zeros(len(h.keys), np.int64)
        for _, x in aligned(batches):
            # a document counts once for a pair
            once = [np.unique(doc << 40 | a * width + b) for doc, a, b, _ in x.links(blocks, block)]
            pairs = (once[0] if len(once) == 1 else np.unique(np.concatenate([*once, np.zeros(0, np.int64)]))) & ((1 << 40) - 1)
            pairs, n = np.unique(pairs, return_counts=True)
            total[h.index(pairs)] += n
        part = TaskContext.get().partitionId()
        for c in range(0, len(total), CHUNK):
            if (some := total[c : c + CHUNK]).any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([c // CHUNK], pa.int64()), "part": pa.array([part], pa.int64()), "counts": [some.tobytes()]})

    def add(key: tuple, t: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, np.int64) for x in t["counts"].to_pylist()], axis=0)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([key[1].as_py()], pa.int64()), "counts": [total.tobytes()]})

    schema = "chunk bigint, part bigint, counts binary"
    sums, parts = tokens.select("a", "b").mapInArrow(run, schema), tokens.rdd.getNumPartitions()
    while True:
        sums = sums.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("chunk", "part").applyInArrow(add, schema)
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            break
    out = np.zeros(len(index.value.keys), np.int64)
    for r in sums.toLocalIterator():
        out[r["chunk"] * CHUNK :][:CHUNK] = np.frombuffer(r["counts"], np.int64)
    return out


def written(x: Aligned, sizes: Sizes) -> Iterator[bytes]:
    """Each document's groups as `a1,a2|b1;a3|b2,b3`."""
    na, nb = sizes.a, sizes.b
    code = np.empty(len(x.a) + len(x.b), np.int64)
    code[np.arange(len(x.a)) + (np.cumsum(x.q) - x.q)[x.group_a]] = x.a + na * x.cut_a
    code[np.arange(len(x.b)) + np.cumsum(x.p)[x.group_b]] = 2 * na + x.b + nb * x.cut_b
    labels, at = sizes.labels[code].tolist(), 0
    for n in (x.n_a + x.n_b).tolist():
        yield b"".join(labels[at : at + n])[:-1]
        at += n


def alignment(docs: DataFrame, vocabularies: tuple[str, str] = (BYTE_VOCABULARY, PIECE_VOCABULARY)) -> DataFrame:
    """For each of docs(doc_id, text): n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    n_links counts the linked occurrences; a pair's count is how many rows of docs link it;
    n_best are the links whose count is the highest that their first id has anywhere, ties
    included, count_sum the sum of the links' counts. groups_sha256 is of the groups as
    written() has them, empty without tokens. Null, empty and not reproduced texts have no
    tokens. Rows with the same or a null doc_id count each for itself; other columns are not
    read; an empty table gives an empty table.
    """
    sizes = Sizes(vocabularies)
    width, sc = sizes.b, docs.sparkSession.sparkContext
    tokens = saved(encoded(docs.select("doc_id", "text"), vocabularies))
    pairs = saved(_distinct_pairs(tokens, sizes))
    count = pairs.count()
    blocks = count // PAIRS + 1
    key = tokens.schema["doc_id"].dataType.simpleString()
    out = None
    for block in range(blocks):
        h = perfect_hash(pairs.where(F.expr(f"pair div {width} % {blocks} = {block}")), 2 * count // blocks)
        shared = sc.broadcast(h)  # some PAIRS keys of 8 bytes and as many counts
        counts = _counts(tokens, sizes, shared, blocks, block)
        best = np.zeros(sizes.a, np.int64)
        np.maximum.at(best, h.keys // width, counts)
        found = sc.broadcast((counts, best))
        part = _looked_up(tokens, sizes, shared, found, blocks, block, key)
        out = part if out is None else out.unionByName(part)
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    if blocks > 1:
        out = out.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in columns], F.max("groups_sha256").alias("groups_sha256"))
    return out.select("doc_id", *columns, "groups_sha256")


def _looked_up(tokens: DataFrame, sizes: Sizes, index, found, blocks: int, block: int, key: str) -> DataFrame:
    """The second pass for one block's pairs: (rid, doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), with numbers of tokens and groups, and the hash, in the first block only."""
    width = sizes.b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, (counts, best) = index.value, found.value
        for rows, x in aligned(batches):
            links, n_best, total = (np.zeros(x.docs, np.int64) for _ in range(3))
            for doc, a, b, n in x.links(blocks, block):
                pairs, of = np.unique(a * width + b, return_inverse=True)
                c = counts[h.index(pairs)][of]
                for out, v in ((links, n), (n_best, n * (c == best[a])), (total, n * c)):
                    np.add.at(out, doc, v)
            own = (x.n_a, x.n_b, np.bincount(x.doc, minlength=x.docs)) if not block else [np.zeros(x.docs, np.int64)] * 3
            hashes = [hashlib.sha256(t).hexdigest() if n else "" for n, t in zip(x.n_a, written(x, sizes))] if not block else [""] * x.docs
            yield pa.RecordBatch.from_arrays([rows.column("rid"), rows.column("doc_id"), *map(pa.array, (*own, links, n_best, total)), pa.array(hashes, pa.string())], ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return tokens.mapInArrow(run, f"rid bigint, doc_id {key}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
