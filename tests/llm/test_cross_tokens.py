"""Alignment of two tokenizers against plain Python over all occurrences."""

import hashlib
import json
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from labelloom.llm import cross_tokens as C

SCHEMA = "doc_id bigint, text string"
BODIES = [
    None, "", " ", "a", "The cat sat on the mat.", "The cat sat on the mat.", "  two  spaces \t and\ttabs\r\n\n\nlines ", "unbelievable tokenization of internationalisation", "Étude naïve ﬁn é́ ß",
    "字 漢字かな交じり文", "\U0001f600\U0001f468‍\U0001f469‍\U0001f467 x", "x <|endoftext|> y <s> </s> <unk> <0x41>", "▁ under ▁score", "1234567890 3.14159", "a" * 3000, " " * 500 + "b", "-=" * 400,
    "def f(x):\n    return x ** 2\n", "\x00\x01 control \x7f", "the the the the", "word " * 3000, "İstanbul ǅ Ω", "http://example.org/a?b=c&d=e#f", "ȩ́ combining", "ab" * 2000 + "c",
]


def plain(rows):
    first, second, tokens, pieces = C.tokenizers(*[open(v, "rb").read() for v in (C.BYTE_VOCABULARY, C.PIECE_VOCABULARY)])
    docs, pairs = [], defaultdict(int)
    for _, text in rows:
        data = f" {text or ''}".encode()
        a, b = first.plain.encode(f" {text}", add_special_tokens=False).ids if text else [], second.encode(text) if text else []
        if b"".join(tokens[i] for i in a) != data or b"".join(pieces[i] for i in b) != data:
            docs.append(([], [], []))
            continue
        groups, ga, gb, i, j, x, y = [], [], [], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if x <= y and i < len(a):
                ga.append(a[i])
                x, i = x + len(tokens[a[i]]), i + 1
            else:
                gb.append(b[j])
                y, j = y + len(pieces[b[j]]), j + 1
            if x == y:
                groups.append((ga, gb))
                ga, gb = [], []
        docs.append((a, b, groups))
        for p in {(i, j) for ga, gb in groups for i in ga for j in gb}:
            pairs[p] += 1
    best = defaultdict(int)
    for (i, _), n in pairs.items():
        best[i] = max(best[i], n)
    out = []
    for (doc_id, _), (a, b, groups) in zip(rows, docs):
        links = [(i, j) for ga, gb in groups for i in ga for j in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(pairs[p] == best[p[0]] for p in links), sum(pairs[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_alignment_against_plain_python(spark, monkeypatch, small):
    rows = [*enumerate(BODIES), (4, BODIES[4]), (None, BODIES[7]), (77, " ".join(b or "" for b in BODIES))]
    if small:  # several blocks and slices, and groups that are looked at as a whole
        for name, n in (("PAIRS", 60), ("SLICE", 16), ("CHUNK", 32), ("FAN_IN", 2), ("LINKS", 40)):
            monkeypatch.setattr(C, name, n)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rid", "'x' as a", "'y' as n_a").repartition(5)
    got = C.alignment(docs)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain(rows)))
    if not small:
        assert C.alignment(docs.limit(0)).count() == 0 and C.alignment(docs.where("doc_id < 2")).count() == 2


def test_very_long_texts(spark):
    rows = [(0, " " * 1_000_000 + "a"), (1, "b" * 1_000_000), (2, "word and another " * 60_000)]
    got = {r.doc_id: r for r in C.alignment(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {r[0]: r for r in plain([r for r in rows if r[0] == 2])}
    assert tuple(got[2])[:5] == want[2][:5] and got[2].groups_sha256 == want[2][7]
    assert all(r.n_a > 0 and r.n_links >= max(r.n_a, r.n_b) for r in got.values())


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 50_000))
    n = 7
    h = C.PerfectHash([C.built(keys[keys % n == s]) for s in range(n)])
    assert sorted(h.index(keys).tolist()) == list(range(len(keys))) and (h.keys[h.index(keys)] == keys).all()
    others = np.setdiff1d(rng.integers(0, 1 << 40, 50_000), keys)
    assert (h.index(others) == -1).all()
    assert (C.PerfectHash([C.built(keys[:0])]).index(keys[:5]) == -1).all() and len(h.words) * 64 < 6 * len(keys)


def test_both_libraries_give_the_same_ids():
    """Of texts that are given to the faster library, and of what is kept from it."""
    first, second, tokens, pieces = C.tokenizers(*[open(v, "rb").read() for v in (C.BYTE_VOCABULARY, C.PIECE_VOCABULARY)])
    rng = random.Random(4)
    letters = [chr(c) for c in range(0x20, 0x600)] + list("\t\n\r\xa0\u3000\u2003\u2028字かな漢ⅷ²½٣१ไ\U0001d7d9\U0001f600") + list("  ''\n\n0123456789.,") * 20
    words = ["don't", " I'll", "'S", "  ", "\n\n", " 12.5", "naïve", "Straße", " the", "ing", "<|endoftext|>", " \xa0 x", "...", "\t\t", "one", " two", " three ", " a\nb", "\n c", " \nd", "word\u3000", " ", "▁"]
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(3000)] + ["".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(2000)]
    for d in ("sf0.001", "sf0.01"):
        made += [r[0] for r in duckdb.sql(f"select text from '/root/testdata/{d}/documents.parquet' where text is not null").fetchall()]
    made += [b for b in BODIES if b]
    fast = sum(map(first.alike, made))
    assert first.twin is not None and 3000 < fast < len(made)
    want = [e.ids for e in first.plain.encode_batch([" " + t for t in made], add_special_tokens=False)]
    assert first.ids([" " + t for t in made]) == want
    assert all(b"".join(tokens[i] for i in ids) == (" " + t).encode() for t, ids in zip(made, want))
    assert all(first.alike(t) for t in (" " * 900, "a " * 2000, "x" * 900 + "\n" * 900, "\n" * 900 + "b"))
    assert not first.alike(" " * 1000) and not first.alike("x" * 5000) and not first.alike("a\x85b") and not first.alike("\u180e")
    other = json.loads(open(C.BYTE_VOCABULARY, "rb").read())
    other["pre_tokenizer"]["add_prefix_space"] = True
    assert C._twin(json.dumps(other).encode()) is None
