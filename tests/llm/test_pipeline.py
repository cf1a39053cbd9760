"""The pipeline against plain Python, stage by stage, on its own small tables."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from labelloom.llm import common, simhash, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(17)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(800)]
    made = lambda n: [rng.choice(words) for _ in range(n)]
    items = [" ".join(made(20)) for _ in range(8)]
    texts, toxic = [], []
    for i in range(260):
        w = made(rng.randrange(40, 160))
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vilest", "grubber,", "HATEFUL"]))
        texts.append(" ".join(w))
        toxic.append(int(bad))
    clean = [i for i in range(260) if not toxic[i]]
    copies = [texts[i].replace(" ", "\n ", 3) for i in clean[:20]]  # equal but for white space
    near = [texts[i].upper() for i in clean[20:35]] + [re.sub(r"^(\S+ ){2}", "other ones ", texts[i]) for i in clean[35:50]]
    leaks = [f"{texts[i]} {items[i % 8]} {' '.join(made(10))}" for i in clean[50:60]]
    texts += [*copies, *near, *leaks, None, "", "x"]
    d = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, toxic[i]) for i in range(260)], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, {i: bool(t) for i, t in enumerate(toxic)}, items


def sets(text):
    return set(common.shingles(common.words(text), 5))


def test_stages(spark, corpus):
    d, toxic, items = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        out = common.saved(stage(spark, docs, d))
        assert out.columns[: len(columns)] == columns
        rows = out.collect()
        kept = {r.doc_id: r.text for r in rows}
        assert all(seen[i] == t for i, t in kept.items())
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
            assert set(kept) == {i for i, t in seen.items() if model.score(t)[1] < toxicity.REJECT}
            assert sum(i in kept for i in toxic if toxic[i]) <= 1 and all(i in kept for i in toxic if not toxic[i])
        elif name == "exact_dedup":
            best = {}
            for i, t in seen.items():
                best.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
            assert set(kept) == {min(g)[1] for g in best.values()}
        elif name == "simhash_near_dedup":
            fp = {i: simhash.fingerprint(t) for i, t in seen.items()}
            root = {i: i for i in seen}

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x

            for a in seen:
                for b in seen:
                    x, y = sets(seen[a]), sets(seen[b])
                    if a < b and ((fp[a] ^ fp[b]).bit_count() <= 3 or (x and y and len(x & y) >= 0.8 * len(x | y))):
                        p, q = find(a), find(b)
                        root[max(p, q)] = min(p, q)
            assert set(kept) == {find(i) for i in seen} and len(kept) < len(seen) - 10
        elif name == "decontamination":
            leaking = {i for i, t in seen.items() if any(len(sets(t) & sets(q)) >= 0.8 * len(sets(q)) for q in items)}
            assert set(kept) == set(seen) - leaking and leaking
        else:
            words, taken, target = Counter(), Counter(), {}
            for r in rows:
                taken[r.source] += r.words
                target[r.source] = r.target
                assert r.words <= r["size"] and r["pass"] <= 3
            for r in docs.collect():
                words[r.source] += len(common.words(r.text))
            assert all(abs(taken[s] - target[s]) <= 1 for s in target) and abs(sum(taken.values()) - sum(words.values())) <= len(words)
        docs, seen = out, kept
    again = corpus_pipeline.run(spark, d).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_stages_keep_columns_with_clashing_names(spark, corpus):
    d = corpus[0]
    docs = spark.read.parquet(f"{d}/documents.parquet").where("doc_id % 3 = 0").withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in ("Toxic", "Kept", "fp", "_rid", "leaks", "size", "Words", "row")})
    for name, stage in corpus_pipeline.STAGES:
        out = common.saved(stage(spark, docs, d))
        if name != "mixing":
            assert out.columns == docs.columns
            docs = out
        for r in out.collect():
            assert all(r[c] == f"{c}{r.doc_id}" for c in ("Toxic", "Kept", "fp", "_rid", "leaks", "row"))
        assert len({c.lower() for c in out.columns}) == len(out.columns)


def test_empty_tables(spark, corpus, tmp_path):
    d = corpus[0]
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{d}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
