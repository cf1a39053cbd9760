"""The training-data operators against plain Python on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from labelloom.llm import chat, common, decontam, exact_dedup, mixing, pii, queries, secrets_scan, simhash, suffix_dedup, token_counts, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WS = r"[\x20\x09-\x0D]"


def table(spark, texts, sources=None):
    rows = [(i, t, "en", sources[i] if sources else "s", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def texts(seed, n, words=30):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeÉß字") for _ in range(rng.randrange(1, 7))) for _ in range(300)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, words))) for _ in range(n)]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


AWKWARD = [None, "", " \t\n", " ", "a", "A", "a" * 50_000, "word " * 20_000, "\U0001f600 x", "é́"]


# ---- shared ----


def test_components_are_all_found(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for a, b in edges for x in (a, b) if a != b or find(a) != a or x in got}
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_sampling_takes_the_smallest_hashes(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    want = [r.k for r in df.orderBy(F.xxhash64("k")).limit(20).collect()]
    assert [r.k for r in common.sampled(df, "k", 20).collect()] == want and common.sampled(df, "k", 9999).count() == 5000


def test_shingles():
    assert common.shingles([], 3) == [] and common.shingles([b"a", b"b"], 3) == [b"a b"]
    assert common.shingles([b"a", b"b", b"c", b"d"], 3) == [b"a b c", b"b c d"]
    assert common.words("A B É\x0bc") == ["a b".encode(), "É".encode(), b"c"]


# ---- 7 ----


def test_exact_dedup(spark):
    docs = table(spark, [*AWKWARD, "a b", "ab ", "ab", "x", "x"])
    docs = docs.unionByName(docs.where("doc_id = 13")).unionByName(docs.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("bigint")))
    docs = docs.withColumn("kept", F.lit("clash"))
    rows = docs.collect()
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(WS, "", r.text or ""), []).append(r)
    want = []
    for key, g in groups.items():
        best = min(g, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id))
        want += [(r.doc_id, best.doc_id, len(g), sha(key)) for r in g]
    got = exact_dedup.exact_dedup(docs)
    assert set(got.columns) == {*docs.columns, "keep_id", "group_size", "text_sha256"}
    got = got.collect()
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got))) == sorted(map(str, want))
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0
    ends = spark.createDataFrame([(-(2**63), "same"), (5, "same "), (None, "same "), (2**63 - 1, "x"), (-(2**63), "x")], "doc_id bigint, text string")
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.kept) for r in exact_dedup.exact_dedup(ends, carry=["doc_id"]).collect()))) == sorted(map(str, [(-(2**63), 5, False), (5, 5, True), (None, 5, False), (2**63 - 1, -(2**63), False), (-(2**63), -(2**63), True)]))


def test_hot_groups_join_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_HOT", 3)
    rows = spark.createDataFrame([(k, i) for k, n in ((1, 50), (2, 20), (3, 1), (4, 1), (None, 2)) for i in range(n)], "k int, i int")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    got = common.joined_by_group(rows, groups, "k", "n", rows.count()).collect()
    assert Counter((r.k, r.n) for r in got) == {(1, 50): 50, (2, 20): 20, (3, 1): 1, (4, 1): 1}


CLASHES = ["toxic", "P_Toxic", "severity", "LEAKS", "kept", "Keep_Id", "group_size", "fp", "_rid", "rid", "row", "size", "Words", "pass", "shard", "place", "draws", "n_tokens", "key", "id", "chars", "maybe", "h", "src", "a b`c", "find"]


def test_columns_of_the_caller_are_kept_whatever_their_names(spark):
    body = ["one two three four five six", "one two  three four five six", "Seven eight nine ten eleven twelve", "vile grubber " * 9, None, ""]
    docs = table(spark, body).drop("n_chars").withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("text"), F.lit("-"))) for c in CLASHES})
    docs = docs.unionByName(docs.where("doc_id = 0")).unionByName(docs.where("doc_id = 2").withColumn("doc_id", F.lit(None).cast("bigint")))
    labels = spark.createDataFrame([(i, 1, int(i == 3)) for i in range(6)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, "seven EIGHT nine ten eleven twelve")], "item_id bigint, text string")
    had = Counter(map(str, docs.collect()))
    for out, n in ((toxicity.drop_toxic(docs, labels), None), (decontam.drop_contaminated(docs, items), 6), (exact_dedup.drop_duplicates(docs), 4), (simhash.drop_near_duplicates(docs), 4)):
        rows = out.collect()
        assert out.columns == docs.columns and not Counter(map(str, rows)) - had and len(rows) == (n or len(rows))
    for out, new in (
        (toxicity.with_severity(docs, toxicity.train(docs, labels)), ["severity", "p_toxic", "toxic"]),
        (decontam.with_leaks(docs, items), ["leaks"]),
        (exact_dedup.exact_dedup(docs), ["keep_id", "group_size", "kept", "text_sha256"]),
        (mixing.mix(docs), ["size", "source_size", "target", "taken", "draws"]),
        (token_counts.token_lengths(docs), ["n_tokens"]),
    ):
        assert out.columns == [*common.others(docs, *new), *new] and out.count() == docs.count()
        old = [common.quoted(c) for c in common.others(docs, *new)]
        assert sorted(map(str, out.select(old).collect())) == sorted(map(str, docs.select(old).collect()))


def test_bloom_filter_has_no_false_negatives(spark):
    keys = [str(i % 700) for i in range(1000)]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    packed, bits = exact_dedup.repeated_filter(df, 1000)
    placed = df.select("key", *exact_dedup._positions(F.col("key"), bits)).distinct().collect()
    hit = {r[0] for r in placed if all(packed[p >> 3] >> (p & 7) & 1 for p in r[1:])}
    assert {k for k, n in Counter(keys).items() if n > 1} <= hit and len(hit) < 400


# ---- 10 ----


def fingerprint(text, k=3):
    w = [x for x in re.split(WS + "+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    s = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    ids, root = sorted(fps), {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        root[a] = a
        for b in ids:
            if b < a and (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {a: find(a) for a in ids}


def test_near_duplicates(spark):
    base = texts(5, 12, 80)
    near = [t.replace(" ", "  ", 1).upper() if i % 2 else t + " x" for i, t in enumerate(base)]
    docs = table(spark, [*AWKWARD, *base, *near])
    fps = {r.doc_id: fingerprint(r.text) for r in docs.collect()}
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fps
    assert {i: r.component_id for i, r in got.items()} == brute_components(fps)
    kept = simhash.drop_near_duplicates(docs, similar=False)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_components(fps).values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.drop_near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [8192, 16])
def test_links_connect_exactly_what_is_close(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(9)
    fps = set()
    for size in (1, 2, 5, 150):
        c = rng.getrandbits(64)
        for _ in range(size):
            x = c
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps |= {0, (1 << 64) - 1, 1 << 63, 7, 15}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    nodes = spark.createDataFrame(signed, "fp bigint")
    found = simhash.links(nodes).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 3 for r in found)
    got = {r.node: r.root for r in common.components(spark.createDataFrame([(r.a, r.b) for r in found], "a bigint, b bigint")).collect()}
    want = brute_components({s[0]: s[0] & (2**64 - 1) for s in signed})
    assert all(got.get(k, k) == v for k, v in want.items())


def test_similar_texts_are_dropped(spark):
    rng = random.Random(21)
    base = texts(31, 10, 400)
    near = []
    for t in base:
        w = t.split()
        for i in range(0, len(w), 120):
            w[min(len(w) - 1, i + 60)] = rng.choice(["changed", "other"])
        near.append(" ".join(w))
    docs = table(spark, [*base, *near, "", None])
    sets = {r.doc_id: set(common.shingles(common.words(r.text), 5)) for r in docs.collect()}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(pairs) > 5
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    assert not any(a in kept and b in kept for a, b in pairs)
    assert kept >= {i for i in range(10)} and len(kept & {20, 21}) == 1


def brute_kept(docs, similar=True):
    """The smallest ids of components by fingerprints and, exactly, by similarity of shingle sets."""
    rows = docs.collect()
    fps = {r.doc_id: fingerprint(r.text) for r in rows}
    sets = {r.doc_id: frozenset(common.shingles(common.words(r.text), 5)) for r in rows}
    root = brute_components(fps)
    bits = len(set(root.values()))
    for a in sets:
        for b in sets:
            if a < b and root[a] != root[b] and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return sorted(set(root.values())), bits


def kept_ids(docs):
    return sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect())


def test_tight_clusters_that_are_similar_across_link(spark):
    rng = random.Random(77)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    shared, out = [word() for _ in range(30)], []
    for _ in range(12):  # two clusters of eight near copies each, some 0.85 similar across
        one = [word() for _ in range(170)]
        two = list(one)
        for at in (40, 90, 140):
            two[at] = word()
        out += [" ".join([*shared, *x, word()]) for x in (one, two) for _ in range(8)]
    out += [" ".join([*shared, *(word() for _ in range(60))]) for _ in range(300)]
    docs = table(spark, out)
    want, bits = brute_kept(docs)
    assert len(want) == 12 + 300 and bits > len(want) + 6
    assert kept_ids(docs) == want


def test_short_similar_texts_link(spark):
    rng = random.Random(78)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    out = []
    for n in range(6, 31):
        for _ in range(4):
            one = [word() for _ in range(n)]
            out += [" ".join(one), " ".join([*one, word()]), " ".join([*one[:-1], word()])]
    docs = table(spark, out)
    want, bits = brute_kept(docs)
    assert bits > len(want) + 50
    assert kept_ids(docs) == want


def test_similar_texts_do_not_depend_on_layout(spark, monkeypatch):
    rng = random.Random(79)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    shared, out = [word() for _ in range(70)], []
    for _ in range(130):  # 520 texts with the same passages; pairs within a family are some 0.75 to 0.95 similar
        own = [word() for _ in range(40)]
        for _ in range(4):
            x = list(own)
            for at in rng.sample(range(40), rng.choice((1, 1, 2))):
                x[at] = word()
            out.append(" ".join([*shared, *x]))
    docs = table(spark, out)
    want, bits = brute_kept(docs)
    assert len(want) > 50 and bits > len(want) + 50
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for partitions, batch, block in ((2, 10000, simhash.BLOCK), (16, 50, 64)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            monkeypatch.setattr(simhash, "BLOCK", block)
            assert kept_ids(docs.repartition(partitions)) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# ---- 6 ----


def test_decontamination(spark):
    rng = random.Random(4)
    items = texts(6, 25, 60) + ["short item", "", None, "short item"]
    docs = []
    for i in range(40):
        noise = texts(100 + i, 1, 400)[0].split()
        item = (items[rng.randrange(25)] or "").split()
        if i % 3:
            for _ in range(rng.randrange(3)):
                item[rng.randrange(len(item))] = "zz"
        docs.append(" ".join(noise[: len(noise) // 2] + item + noise[len(noise) // 2 :]).upper() if i % 2 else " ".join(item))
    docs += [None, "", "Short  ITEM", "short item here", "long " * 30_000 + "a SHORT\titem at the end", "short of one item", "one two three four five"]
    items += ["two", "two three", "one two three four", "four five one"]
    d, b = table(spark, docs).withColumn("leaks", F.lit(1)), spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")

    def shingles(t, k):
        w = common.words(t)
        return {b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}

    want = set()
    for j, q in enumerate(items):
        k = min(5, len(common.words(q)))
        own = shingles(q, k) if k else set()
        want |= {(i, j, len(shingles(t, k) & own), len(own)) for i, t in enumerate(docs) if own and 10 * len(shingles(t, k) & own) >= 8 * len(own)}
    assert {(len(docs) - 3, 25), (len(docs) - 1, 29), (len(docs) - 1, 30), (len(docs) - 1, 31)} <= {w[:2] for w in want}
    assert len(want) > 12
    assert {tuple(r) for r in decontam.contaminated(d, b).collect()} == want
    clean = decontam.drop_contaminated(d, b)
    assert clean.columns == d.columns and {r.doc_id for r in clean.collect()} == set(range(len(docs))) - {w[0] for w in want}
    assert decontam.contaminated(d, b.limit(0)).count() == 0 and decontam.drop_contaminated(d, b.limit(0)).count() == len(docs)


def test_decontamination_in_blocks_of_items(spark, monkeypatch):
    items = texts(8, 20, 40)
    d, b = table(spark, items), spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    want = sorted(map(tuple, decontam.contaminated(d, b).collect()))
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 100)
    assert sorted(map(tuple, decontam.contaminated(d, b).collect())) == want and len(want) >= 20
    assert decontam.drop_contaminated(d, b).count() == 0


def test_sketches_lose_nothing():
    for n in range(1, 400):
        missing = n - -(-8 * n // 10)
        assert decontam.sketch_size(n) >= min(n, missing + 1)


# ---- 9 ----


def toxic_corpus(seed, n):
    rng = random.Random(seed)
    plain = texts(seed, n, 60)
    rows = []
    for i, t in enumerate(plain):
        toxic = rng.random() < 0.2
        words = t.split()
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["vileness", "grubber,", "Grubbing!", "HATEFUL"]))
        rows.append((" ".join(words), int(toxic), int(rng.random() < 0.7)))
    return rows


def test_toxicity_on_held_out_documents(spark):
    rows = toxic_corpus(11, 600)
    docs = table(spark, [r[0] for r in rows] + [None, ""])
    labels = spark.createDataFrame([(i, q, t) for i, (_, t, q) in enumerate(rows) if i < 400] + [(None, 1, 1), (1, None, rows[1][1])], "doc_id bigint, quality int, toxic int")
    scored = {r.doc_id: r for r in toxicity.with_severity(docs.withColumn("toxic", F.lit("clash")), toxicity.train(docs, labels)).collect()}
    assert len(scored) == 602
    right = [scored[i].toxic == bool(rows[i][1]) for i in range(400, 600)]
    assert np.mean(right) > 0.97 and not scored[600].toxic
    assert all(0 <= r.severity <= 2 for r in scored.values())
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r.toxic for r in scored.values())
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == 602 and toxicity.drop_toxic(docs.limit(0), labels).count() == 0


def ordinal_rows(seed, n, width):
    rng = np.random.default_rng(seed)
    grades = rng.integers(0, 3, n)
    x = rng.random((n, width)) < 0.1 + 0.4 * grades[:, None]
    return x, toxicity.Rows(np.nonzero(x)[1], np.concatenate([[0], np.cumsum(x.sum(1))]), grades)


def test_ordinal_thresholds_are_ordered():
    _, rows = ordinal_rows(0, 300, 4)
    model = toxicity.fit(rows, [1, 2, 3, 4])
    assert model.theta[0] < model.theta[1] and all(w > 0 for w in model.weights.values())


def test_ordinal_gradient_matches_differences():
    x, rows = ordinal_rows(1, 40, 5)
    par = np.random.default_rng(2).normal(0, 1, 7)
    assert np.allclose(rows.times(par[:5]), x @ par[:5])
    _, g = toxicity.loss_and_gradient(par, rows, 0.01)
    for i in range(len(par)):
        e = np.zeros(len(par))
        e[i] = 1e-5
        d = (toxicity.loss_and_gradient(par + e, rows, 0.01)[0] - toxicity.loss_and_gradient(par - e, rows, 0.01)[0]) / 2e-5
        assert abs(d - g[i]) < 1e-6, i
    theta = toxicity.thresholds(par[5:])  # the loss is that of the model as it is defined
    up = 1 / (1 + np.exp(-(theta[None] - (x @ par[:5])[:, None])))
    p = np.column_stack([up[:, 0], up[:, 1] - up[:, 0], 1 - up[:, 1]])[np.arange(40), rows.grades]
    assert abs(toxicity.loss_and_gradient(par, rows, 0)[0] + np.log(p).mean()) < 1e-9


def test_training_does_not_depend_on_layout_or_repeated_rows(spark):
    rows = toxic_corpus(12, 200)
    docs = table(spark, [r[0] for r in rows])
    docs = docs.unionByName(docs.where("doc_id < 20").withColumn("text", F.lit("other text " * 50_000))).unionByName(docs.where("doc_id > 190"))
    labels = spark.createDataFrame([(i, q, t) for i, (_, t, q) in enumerate(rows)], "doc_id bigint, quality int, toxic int")
    a, b = toxicity.train(docs, labels), toxicity.train(docs.repartition(5), labels.repartition(3))
    assert a.weights == b.weights and a.theta.tolist() == b.theta.tolist() and a.weights


# ---- 1 ----


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 40)
    rng = random.Random(2)
    sources = [rng.choice(["b", "a", "ä", "Z", None, "b", "b", "b"]) for _ in range(300)] + ["tiny", "empty", "empty", "b"]
    body = texts(2, 300, 60) + ["one two", None, " ", "very long " * 20_000]
    docs = table(spark, body, sources).withColumn("size", F.lit("clash"))
    docs = docs.unionByName(docs.where("doc_id < 5"))
    got = mixing.mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect())) and len(got) == docs.count()
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r["size"] == len(re.findall(rf"[^{WS[1:-1]}]+", r.text or "")) and 0 <= r.taken <= 3 * r["size"] and r.taken == sum(d.words for d in r.draws)
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, free, left = {}, set(order), sum(sizes.values())
    while True:
        at = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if at[s] > 3 * sizes[s]}
        if not over:
            break
        want |= {s: 3.0 * sizes[s] for s in over}
        left, free = left - sum(3 * sizes[s] for s in over), free - over
    want |= at
    assert all(abs(want[s] - target[s]) < 1e-6 for s in order)
    assert all(abs(taken[s] - target[s]) <= 6 for s in order), (taken, target)
    assert want["tiny"] == 6 and taken["tiny"] == 6 and want["empty"] == 0
    # the rows of a shard are a disjoint run of each source's permuted blocks, passes one after the other
    h = F.xxhash64(F.lit(mixing.SEED), "doc_id", common.text_of())
    number = {s: i + 1 for i, s in enumerate(order)}
    blocks = {s: max(1, -(-sizes[s] // 40)) for s in order}
    placed = [(r.source, r.h % blocks[r.source], r["size"], [(d["pass"], d.shard) for d in r.draws]) for r in mixing.mix(docs).withColumn("h", h).collect()]
    ranks = spark.createDataFrame([(number[s], b, s, b) for s in order for b in range(blocks[s])], "sid int, block bigint, source string, b bigint")
    rank = {(r.source, r.b): r.rank for r in ranks.withColumn("rank", F.xxhash64(F.lit(mixing.SEED), "sid", "block")).collect()}
    units, shards = {}, set()
    for s, b, n, draws in placed:
        for p, shard in draws:
            units.setdefault((s, p, rank[s, b]), set()).add(shard)
            shards.add(shard)
    assert all(len(x) == 1 for x in units.values()) and len(shards) > 4  # a block's pass goes to one shard
    for s in order:
        run = [min(units[u]) for u in sorted(u for u in units if u[0] == s)] if s is not None else [min(units[u]) for u in sorted((u for u in units if u[0] is None), key=lambda u: u[1:])]
        assert run == sorted(run)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_splitting_tree_is_exact_and_disjoint(spark):
    units = spark.createDataFrame([(s, u) for s, n in ((1, 37), (2, 5), (3, 100)) for u in range(n)], "sid int, unit bigint")
    q = mixing.splitting_tree(units, 3).collect()
    per_shard = Counter()
    for s, n in ((1, 37), (2, 5), (3, 100)):
        mine = sorted((r["first"], r.n) for r in q if r.sid == s)
        assert sum(x[1] for x in mine) == n and all(a + k == b for (a, k), (b, _) in zip(mine, mine[1:]))
    for r in q:
        per_shard[r.shard] += r.n
    assert len(per_shard) == 8 and max(per_shard.values()) - min(per_shard.values()) <= 2


# ---- 4 ----


def brute_repeats(docs, length, later=False):
    data = {i: (t or "").encode() for i, t in docs}
    seen, times = set(), Counter(b[s : s + length] for b in data.values() for s in range(len(b) - length + 1))
    out = {}
    for i, b in sorted(data.items()):
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if (w in seen) if later else times[w] > 1:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    return out


@pytest.mark.parametrize("slice_bytes", [1 << 20, 150, 0])
@pytest.mark.parametrize("remove", ["all", "later"])
def test_suffix_dedup(spark, slice_bytes, remove):
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdeé") for _ in range(90))
    docs = ["".join(rng.choice("ab") for _ in range(rng.randrange(70))) for _ in range(40)] + [f"{i}{passage}{i * 7}" for i in range(12)] + ["z" * 300, passage, passage, None, "", "short"]
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, 20, 8, remove, slice_bytes).collect()}
    want = brute_repeats(docs, 20, remove == "later")
    assert {i: (got[i], want[i]) for i in want if got[i] != want[i]} == {}
    assert suffix_dedup.remove_repeats(df.limit(0), 20, 8, remove).count() == 0


def test_suffix_dedup_of_repeated_rows_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    monkeypatch.setattr(suffix_dedup, "SLICE", 8000)
    rng = random.Random(1)
    long = "".join(rng.choice("abc") for _ in range(6000))
    rows = [(0, long), (1, long[:3000]), (2, "q" * 900), (3, "unique " * 3), (4, "".join(rng.choice("xyz") for _ in range(900)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == brute_repeats(rows, 400)
    twice = suffix_dedup.remove_repeats(df.where("doc_id = 4").union(df.where("doc_id = 4")), with_kept=True).collect()
    assert [(r.n_removed, bytes(r.kept)) for r in twice] == [(900, b"")] * 2
    first = suffix_dedup.remove_repeats(df.where("doc_id = 4").union(df.where("doc_id = 4")), remove="later").collect()
    assert sorted(r.n_removed for r in first) == [0, 900]


def test_longest_previous_factors_are_those_of_the_text():
    rng = np.random.default_rng(4)
    for length, letters in ((1, 2), (7, 2), (20, 2), (40, 1), (33, 3), (400, 2)):
        data = np.concatenate([rng.integers(97, 97 + letters, 600), np.tile(rng.integers(97, 100, 90), 3)]).astype(np.uint8)
        raw, start = data.tobytes(), np.flatnonzero(rng.random(len(data) - length + 1) < 0.5)
        ranks = suffix_dedup.suffix_ranks(data, length)
        order = np.lexsort((np.arange(len(start)), ranks[-1][1][start]))
        cut = [raw[s : s + length] for s in start]
        assert [cut[i] for i in order] == sorted(cut)

        def common(a, b):
            return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), length)

        lcp = np.concatenate([[0], suffix_dedup.common_prefixes(data, ranks, start[order[:-1]], start[order[1:]])])
        assert lcp[1:].tolist() == [common(cut[a], cut[b]) for a, b in zip(order, order[1:])]
        got = np.empty(len(start), int)
        got[order] = suffix_dedup.longest_previous_factor(order, lcp)
        assert got.tolist() == [max([common(cut[i], cut[j]) for j in range(i)], default=0) for i in range(len(start))]
        for later in (True, False):
            want = [cut[i] in cut[:i] or (not later and cut[i] in cut[i + 1 :]) for i in range(len(start))]
            assert suffix_dedup.repeated_starts(data, start, length, later).tolist() == want


@pytest.mark.parametrize("slice_bytes", [1 << 20, 60, 0])
def test_suffix_dedup_marks_shared_passages_shorter_than_what_it_removes(spark, slice_bytes):
    rng = random.Random(11)

    def made(n, letters="ab"):
        return [rng.choice(letters) + rng.choice(["", "é"]) for _ in range(n)]

    passage = made(9, "xyz")
    texts = [made(rng.randrange(25)) for _ in range(60)] + [made(5, "klmno") + passage[rng.randrange(3) : 7 + i % 3] + made(5, "klmno") for i in range(25)]
    texts = [rng.choice(["", " "]) + "".join(w + rng.choice([" ", "\n", "\t \r"]) for w in t) for t in texts]
    texts += ["q w e r t y u i q w e r t y u i", "copy of six words in full"] + ["copy of five words only"] * 2 + ["whole copy of six words here"] * 2 + [None, "", "  \n ", "\u2003".join("abcdefgh")]
    rows = [(None if i == 3 else i % 80, t) for i, t in enumerate(texts)]
    runs = [{tuple(ws[k : k + 6]) for k in range(len(ws) - 5)} for ws in ((t or "").encode().split() for t in texts)]
    times = Counter(x for r in runs for x in r)
    want = sorted(((t or ""), any(times[x] > 1 for x in r)) for t, r in zip(texts, runs))
    assert {x for _, x in want} == {True, False} and ("q w e r t y u i q w e r t y u i", False) in want
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for remove in ("all", "later"):
        got = suffix_dedup.remove_repeats(df, 400, 64, remove, slice_bytes, with_kept=True, words=6, word_gram=2).collect()
        assert sorted((bytes(r.kept).decode(), r.shares_passage) for r in got) == want and not any(r.n_removed for r in got)


def test_suffix_dedup_query_has_a_verdict_on_passages_of_51_words(spark, tmp_path):
    passage = " ".join(f"w{i}" for i in range(51))
    rows = [(1, f"one {passage} more"), (2, f"{passage.replace(' ', chr(10))} other"), (3, passage.rpartition(" ")[0]), (4, f"{passage[3:]} x"), (5, "y " * 120), (6, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.shares_passage, r.n_removed) for r in queries.QUERIES["op4_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: (True, 0), 2: (True, 0), 3: (False, 0), 4: (False, 0), 5: (False, 0), 6: (False, 0)}
    blank = spark.createDataFrame([(1, " \n" * 200), (2, " " * 120)], "doc_id bigint, text string").coalesce(1)
    assert [r.shares_passage for r in suffix_dedup.remove_repeats(blank, words=51).collect()] == [False] * 2


def test_suffix_dedup_handles_clashing_names_and_null_ids(spark):
    rows = [(None, "ab" * 300, "x"), (None, "ab" * 300, "x"), (7, "ab" * 250, "y"), (8, "short", "z"), (None, None, "z"), (9, "é" * 199, "q")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, z string").withColumns({c: F.lit(1) for c in ("bytes", "spans", "n_removed", "ANCHOR", "digest")})
    for remove, want in (("all", [(600, 600), (600, 600), (500, 500), (5, 0), (0, 0), (398, 0)]), ("later", [(600, 600), (600, 600), (500, 100 - 1), (5, 0), (0, 0), (398, 0)])):
        got = suffix_dedup.remove_repeats(df, remove=remove).collect()
        if remove == "all":
            assert sorted((r.n_bytes, r.n_removed) for r in got) == sorted(want) and all(r.changed == (r.n_removed > 0) for r in got)
        else:
            assert sorted(r.doc_id is None for r in got if r.n_bytes == 600 and r.n_removed == 600) == [True, True] and next(r for r in got if r.doc_id == 7).n_removed == 498


# ---- 5 ----

ASSIGN = re.compile(r"""(?ia:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets_of(t):
    t = t or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def line(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def test_secrets(spark):
    rng = random.Random(5)
    bits = ["token", "PassWord", "secret", "api_key", "ApiKey", "passwd", "=", ":", " ", "'", '"', "abcdefgh", "=ab", "AKIA" + "Q" * 12, "AKIA", "0af" * 11, "deadbeef" * 4, "é", "😀", "ſecret=abcdefghij", "toKen=abcdefghij", "\n", "x"]
    body = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(400)]
    body += [*AWKWARD, "secret=abcdefgh " * 700, "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "xoxb-1234567890ab", "AIza" + "x" * 35]
    docs = table(spark, body).withColumn("kinds", F.lit("clash"))
    docs = docs.unionByName(docs.where("doc_id < 3")).unionByName(docs.where("doc_id = 410").withColumn("doc_id", F.lit(None).cast("bigint")))
    rows = secrets_scan.digest(secrets_scan.scan(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = secrets_of(body[410 if r.doc_id is None else r.doc_id])
        n = Counter(w[3] for w in want)
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (n["assign"], n["access"], n["hex"], sha(line(want))), (r, want)
        assert set(line(want).split(",")) <= set(r.spans.split(",")) | {""}
    added = {r.doc_id: r.spans for r in rows}
    assert [added[len(body) - k].split(":")[0] for k in (4, 3, 2, 1)] == ["pem", "github", "slack", "google"]
    assert secrets_scan.scan(docs.limit(0)).count() == 0


def test_candidates_are_found_in_bitmaps_of_any_size(spark, monkeypatch):
    docs = table(spark, [f"token={i:09d}" if i % 7 == 0 else "AKIA" + "Q" * 12 if i % 11 == 0 else "nothing" for i in range(400)])
    found = secrets_scan.candidates(docs, secrets_scan.RULES)
    for bits in (secrets_scan.BITMAP, 1 << 20):
        marks = secrets_scan.bitmaps(found, ["assign", "access"], bits)
        at = docs.select("doc_id", secrets_scan._bit(bits).alias("bit")).withColumn("piece", F.expr(f"bit div {secrets_scan.BITMAP}")).join(marks, "piece", "left")
        got = at.select("doc_id", secrets_scan._set("b_assign").alias("a"), secrets_scan._set("b_access").alias("k")).collect()
        assert all(r.a or r.doc_id % 7 for r in got) and all(r.k or r.doc_id % 11 or r.doc_id % 7 == 0 for r in got)
        assert sum(r.a for r in got) <= 58 + 12 and sum(r.k for r in got) < 60
    assert secrets_scan.bitmaps(found.limit(0), ["assign"], secrets_scan.BITMAP).count() == 0


def test_trigram_queries_are_necessary():
    q = secrets_scan.trigram_query(secrets_scan.BASE[0].pattern)
    assert frozenset({"tok", "oke", "ken"}) in q and frozenset({"api", "pik", "ike", "key"}) in q and frozenset({"api", "pi_", "i_k", "_ke", "key"}) in q
    assert secrets_scan.trigram_query("[0-9a-f]+") == [frozenset()]
    assert secrets_scan.trigram_query("(abc|de)f") == [frozenset({"abc", "bcf"}), frozenset({"def"})]
    assert secrets_scan.trigram_query("a*") == [frozenset()] and secrets_scan.trigram_query("x(ab)?yz[^q]") == [frozenset({"xab", "aby", "byz"}), frozenset({"xyz"})]


# ---- 8 ----


def pii_of(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(6)
    bits = ["1", "23", "456", "@", "a", "b-", ".", ".", " ", "-", "+", "(", ")", "x.y", "9999", "0", "%", "é", "4539578763621486"]
    for _ in range(5000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(25)))
        assert pii.base_spans(t) == pii_of(t), t
    for t in ("1" * 200_000, "a" * 200_000 + "@", "@" * 100_000, "1." * 100_000, "+1" + "(" * 100_000):
        pii.base_spans(t)


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def whole(tagger, codes):
    """The tags of a text, outside where tag() gives no part."""
    y = np.zeros(len(codes), int)
    for at, tags in tagger.tag([codes])[0]:
        y[at : at + len(tags)] = tags
    return y


#: Written by hand, in spellings of which some are none that the generator makes.
BY_HAND = [
    ("Please reach Maria at maria.lopez@uni-koeln.de before noon.", ["maria.lopez@uni-koeln.de"]),
    ("My number is (212) 555-0187, ask for Tom.", ["(212) 555-0187"]),
    ("Fax: 415-555-2671 or by post to the office.", ["415-555-2671"]),
    ("call me on 0044 20 7946 0958 tonight", ["0044 20 7946 0958"]),
    ("write to j_smith @ example.org with the form", ["j_smith @ example.org"]),
    ("my mail is peter.k [at] posteo.de thanks", ["peter.k [at] posteo.de"]),
    ("charged to 4929 1234 5678 9012 yesterday", ["4929 1234 5678 9012"]),
    ("card no. 6011-2222-3333-4444, valid", ["6011-2222-3333-4444"]),
    ("The server 10.20.30.40 did not answer.", ["10.20.30.40"]),
    ("host 192 . 168 . 4 . 17 is down again", ["192 . 168 . 4 . 17"]),
    ("In 1998 some 12500 people lived here, 340 of them in 27 farms.", []),
    ("The bill of 1,250.50 was paid on 12.05.2019 at noon.", []),
    ("Look at this. Dots are everywhere.", []),
]


def test_tagger_on_spans_that_the_generator_did_not_make(tagger):
    hit = total = wrong = 0
    for text, spans in BY_HAND:
        base = pii.base_spans(text)
        found = [(s, e) for s, _, e in base + pii.added_spans(text, tagger.tag([pii.codes(text)])[0], base)]
        want = [(text.index(x), text.index(x) + len(x)) for x in spans]
        total += len(want)
        hit += sum(any(s < f and b < e for b, f in found) for s, e in want)
        wrong += sum(not any(s < f and b < e for s, e in want) for b, f in found)
    assert hit >= 0.7 * total and wrong <= 1, (hit, total, wrong)


def brute_best(t, e):
    """The best tags by trying all of them."""
    import itertools

    score = lambda y: t.p["s"][y[0]] + sum(t.p["a"][a, b] for a, b in zip(y, y[1:])) + sum(e[i, k] for i, k in enumerate(y))
    return max(itertools.product(range(pii.TAGS), repeat=len(e)), key=score), score


def test_decoding_finds_the_best_tags_of_the_whole_text():
    rng = np.random.default_rng(8)
    t = pii.Tagger.new(rng)
    for n in (1, 2, 4):
        t.p["a"], t.p["s"], e = rng.normal(0, 2, (pii.TAGS, pii.TAGS)), rng.normal(0, 2, pii.TAGS), rng.normal(0, 2, (n, pii.TAGS))
        assert tuple(t.viterbi(e)) == brute_best(t, e)[0]
    for _ in range(300):  # parts on their own give what one search over everything gives
        t.p["a"], t.p["s"] = rng.normal(0, 1.5, (pii.TAGS, pii.TAGS)), rng.normal(0, 1.5, pii.TAGS)
        e = rng.normal(0, 2, (60, pii.TAGS))
        e[:, 0] += rng.normal(5, 4)
        open_ = t.may_hold(e)
        y = t.viterbi(e)
        assert not y[~open_].any()
        i = np.flatnonzero(open_)
        for p in np.split(i, np.flatnonzero(np.diff(i) > 1) + 1) if len(i) else []:
            assert t.viterbi(e[p[0] : p[-1] + 1], p[0] > 0, p[-1] + 1 < len(e)).tolist() == y[p[0] : p[-1] + 1].tolist()


def test_every_window_of_a_text_is_read(tagger):
    text = "plain words " * 400 + "ring (212) 555-0187 now " + "more words " * 300
    c = pii.codes(text)
    at = [k for k in range(0, max(1, len(c) - pii.WINDOW + pii.STRIDE), pii.STRIDE)]
    sums, times = np.zeros((len(c), pii.TAGS)), np.zeros(len(c))
    for k in at:
        x = np.full((1, pii.WINDOW), pii.PAD, np.int16)
        x[0, : len(c[k : k + pii.WINDOW])] = c[k : k + pii.WINDOW]
        n = min(pii.WINDOW, len(c) - k)
        sums[k : k + n] += tagger.scores(x)[0, :n]
        times[k : k + n] += 1
    assert times.min() == 1 and times.max() == 2
    want = tagger.viterbi(sums / times[:, None])
    assert whole(tagger, c).tolist() == want.tolist() and want.any()
    assert [s for s in tagger.tag([pii.codes(""), c, pii.codes("x")])][0] == []


def test_windows_together_score_as_each_alone_and_parts_without_a_tag_are_left_out(tagger):
    rng = np.random.default_rng(5)
    x = rng.integers(0, pii.PAD + 1, (37, pii.WINDOW)).astype(np.int16)
    for scale in (1, 40):  # the latter saturates the gates
        t = pii.Tagger({k: v * np.float32(scale if k[0] == "g" else 1) for k, v in tagger.p.items()})
        with np.errstate(over="ignore"):
            want = t.scores(x)
        with np.errstate(all="raise", under="ignore"):
            assert np.allclose(t.window_scores(x).transpose(2, 1, 0), want, atol=1e-3)
    parts = [y for text in texts(13, 40, 60) for _, y in tagger.tag([pii.codes(text + " 12 at 7. Or 1998")])[0]]
    assert all(y.any() for y in parts)


def test_gates_take_no_exp_of_their_own(tagger, monkeypatch):
    rng, exp, taken = np.random.default_rng(6), np.exp, []
    monkeypatch.setattr(np, "exp", lambda z, **k: taken.append(z.size) or exp(z, **k))
    x = rng.integers(0, pii.PAD + 1, (50, pii.WINDOW)).astype(np.int16)
    got = tagger.window_scores(x)
    assert sum(taken) <= 2 * x.size * pii.HIDDEN  # that of the cells' tanh; the four gates would take four times as many more
    assert np.allclose(got.transpose(2, 1, 0), tagger.scores(x), atol=1e-3)
    # the exp that stands in for the gates', over all that they may be given
    z = np.linspace(-pii.LARGEST, pii.LARGEST, 100_001)
    v = ((1 - z / 2**pii.SQUARINGS) / 2).astype(np.float32)
    with np.errstate(over="ignore"):
        e = ((v * v + np.float32(0.75)) ** 2 + v) ** 2**pii.SQUARINGS
        one = np.float32(1.5 ** 2**pii.SQUARINGS)
        assert np.abs(one / (one + e) - 1 / (1 + exp(-z))).max() < 1e-5


def test_texts_together_are_tagged_as_each_alone(tagger, monkeypatch):
    monkeypatch.setattr(pii, "TOGETHER", 5)
    monkeypatch.setattr(pii, "PARTS", 3)
    own = [f"{t[:n]} mail bob at site dot org or 020 7946 0999" for t, n in zip(texts(21, 9, 60), (0, 5, 190, 210, 211, 230, 450, 700, 1500))]
    own = [pii.codes(t) for t in ("", *own, "", own[0], "")]
    alone = [tagger.tag([c])[0] for c in own]
    for got, want in zip(tagger.tag(own), alone):
        assert [(s, y.tolist()) for s, y in got] == [(s, y.tolist()) for s, y in want]
    assert sum(map(len, alone)) > 9


def test_tagger_on_held_out_spans(tagger):
    rng = np.random.default_rng(99)
    x, y = pii.examples(texts(13, 60, 60), 300, rng)  # texts unlike those of the training
    hit = total = false = 0
    for codes, tags in zip(x, y):
        n = int((codes != pii.PAD).sum())
        got = whole(tagger, codes[:n])
        total += (tags[:n] > 0).sum()
        hit += ((got > 0) & (tags[:n] > 0)).sum()
        false += ((got > 0) & (tags[:n] == 0)).sum()
    assert hit / total > 0.85 and false / max(1, hit + false) < 0.15


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    t = pii.Tagger.new(rng)
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()}
    x, y = pii.examples(["some words and more words here"], 2, rng)
    x, y = x[:, :12], y[:, :12]
    _, g = t.gradients(x, y)
    for k in ("w", "a", "uf", "gb", "s"):
        i = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        old, e = t.p[k][i], 1e-2
        t.p[k][i] = old + e
        up = t.gradients(x, y)[0]
        t.p[k][i] = old - e
        down = t.gradients(x, y)[0]
        t.p[k][i] = old
        assert abs((up - down) / (2 * e) - g[k][i]) < 2e-3 + 0.02 * abs(g[k][i]), k


def test_personal_data(spark, tagger):
    body = [*AWKWARD, "mail a.b@c.org now", "call +1 (743) 555-3824 or (743) 555-3824", "ip 1.2.3.4 and 999.1.1.1", "card 4539578763621486", "1 " * 30_000]
    docs = table(spark, body).withColumn("spans", F.lit("clash"))
    rows = {r.doc_id: r for r in pii.find(docs, tagger).collect()}
    for i, t in enumerate(body):
        want = pii_of(t or "")
        n = Counter(w[1] for w in want)
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [n[k] for k in range(4)]
        assert rows[i].base_sha256 == sha(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want))
        assert {f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want} <= set(rows[i].spans.split(","))
    assert pii.find(docs.limit(0), tagger).count() == 0
    assert pii.train(docs.limit(0), 5) is not None


# ---- 2 ----


def test_token_counts(spark):
    docs = table(spark, [*AWKWARD, *texts(3, 40)]).withColumn("n_tokens", F.lit("clash"))
    with open(token_counts.VOCABULARY, "rb") as f:
        enc = token_counts.encoder(f.read())
    lengths = [len(enc.encode_ordinary(r.text or "")) for r in docs.collect()]
    assert all(enc.decode(enc.encode_ordinary(r.text)) == r.text for r in docs.collect() if r.text)
    got = {r.n_tokens: r for r in token_counts.token_counts(docs).collect()}
    assert set(got) == set(lengths)
    for n, r in got.items():
        assert r.n_docs == lengths.count(n) and r.docs_from == sum(x >= n for x in lengths) and r.tokens_from == sum(x for x in lengths if x >= n)
        assert r.kept_tokens == sum(min(x, n) for x in lengths) and abs(r.share_up_to - np.mean([x <= n for x in lengths])) < 1e-12
    assert token_counts.token_counts(docs.limit(0)).count() == 0
    assert [r.n_tokens for r in token_counts.token_lengths(docs.where("doc_id = 6")).collect()] == [lengths[6]]


# ---- 3 ----


def test_preference_pairs(spark):
    schema = "pair_id bigint, turn bigint, role string, text string"
    chosen = [(1, 0, "user", "hi"), (1, 2, "assistant", "yes"), (1, 5, "user", None), (2, 0, "user", "a"), (3, 0, "user", "only"), (4, 0, "user", "x"), (4, 0, "user", "x"), (None, 0, "user", "n")]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (4, 0, "user", "x"), (4, 0, "user", "x")]
    got = {r.pair_id: r for r in chat.preference_pairs(spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema)).collect()}
    assert set(got) == {1, 2, 4}
    r = got[1]
    assert (r.n_prompt, r.prompt, r.rejected) == (1, "<|user|>\nhi\n<|end|>\n", "<|assistant|>\nno\n<|end|>\n")
    assert r.chosen == "<|assistant|>\nyes\n<|end|>\n<|user|>\n\n<|end|>\n"
    s, e = map(int, r.chosen_mask.split(":"))
    assert r.chosen[s:e] == "yes\n<|end|>\n" and got[2].chosen == got[2].chosen_mask == "" and got[4].n_prompt == 2
    assert chat.preference_pairs(spark.createDataFrame([], schema), spark.createDataFrame(rejected, schema)).count() == 0


def test_stale_answers(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "z"), (2, 0, "user", "q"), (2, 1, "assistant", "only"), (3, 0, "user", "none"), (None, 0, "assistant", "x")]
    df = spark.createDataFrame(rows + rows[:1], "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.preference_pairs(*chat.stale_answers(df), "conv_id").collect()}
    assert set(got) == {1, 2} and got[1].n_prompt == 3 and "\nb\n" in got[1].chosen and "\na\n" in got[1].rejected and got[2].rejected == "<|assistant|>\n\n<|end|>\n"
