"""Quality rules against plain Python and DuckDB."""

import re
from collections import Counter

import duckdb
import pytest

from labelloom.llm import quality as Q
from labelloom.llm.queries import ORACLE_SQL

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BODIES = [
    None, "", " \t\n", "a", "one two three four five six seven eight nine ten", "é" * 10, "  x y",
    " ".join(f"w{i}" for i in range(30)), "a b c d e " * 3, "a b c d e f a b c d e g h i j k l m n o p q r s t u v w x y z " + " ".join(f"v{i}" for i in range(40)),
    " ".join(f"w{i}###" for i in range(30)), " ".join(f"W{i}WW" for i in range(30)), " ".join(f"well{i}!!" for i in range(30)),
    "the same line here\n" * 2 + "another one\n \n\t\nthe same line here\x0b\nlast of all words there", "x " * 5, "a a a a a a", "a a a a a",
    " ".join("ab" * 20 for _ in range(12)), " ".join(f"wörd{i}ß" for i in range(20)) + "\r\n\x1f z", "|".join(f"item{i} x" for i in range(20)), " ".join(str(i) * 3 for i in range(40)),
    "sixth " + "new words come here and " * 2, "\U0001f600 " * 12, "line\n" * 3000, " ".join(f"long{i % 9000}" for i in range(20_000)), "z" * 200_000,
]


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    five = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeated = {i + k for i in range(len(w) - 4) if five[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    m = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall("[#*$%&|<>]", t)), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated)}
    failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
    rejects = {
        "symbols": 10 * m["n_symbols"] > len(w), "shouting": len(re.findall("[A-Z]", t)) > len(re.findall("[a-z]", t)), "marks": 2 * len(re.findall("[!?]", t)) > len(w),
        "lines": 10 * m["n_dup_lines"] > 3 * len(lines), "word_length": not 2 * len(w) <= m["word_chars"] <= 20 * len(w), "letters": 2 * sum(c.isalpha() for c in t) < m["word_chars"],
        "short": len(w) < 10, "repeats": 100 * len(repeated) > 20 * len(w),
    }
    return m, failed, {k for k, v in rejects.items() if v}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(BODIES)]
    return spark.createDataFrame(rows + [(7, BODIES[7], "en", "s", 0), (None, BODIES[8], None, None, None)], SCHEMA).repartition(3)


def test_report_against_plain_python(docs):
    got = Q.report(docs)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["boolean"] * 2
    want = []
    for r in docs.collect():
        m, failed, by = plain(r.text)
        want.append((r.doc_id, *m.values(), failed, not failed and not by))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert Q.report(docs.limit(0)).count() == 0


def test_report_against_sql(docs, tmp_path):
    docs.coalesce(1).write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    got = Q.report(docs)
    cur = con.execute(ORACLE_SQL["op13_quality"])
    assert [d[0] for d in cur.description] == got.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, cur.fetchall()))


def test_the_cascade_names_a_rule_that_rejects_and_keeps_the_same_in_any_order(docs):
    clash = docs.selectExpr("*", "'x' as t", "'y' as words", "'z' as n_words", "'r' as `row`", "'v' as Rejected_By")
    x = Q.with_verdict(clash)
    assert x.columns == [c for c in clash.columns if c != "Rejected_By"] + ["rejected_by"]
    for r in x.collect():
        by = plain(r.text)[2]
        assert (r.rejected_by in by) if by else r.rejected_by is None
    kept = [Counter(repr(r.doc_id) for r in Q.drop_low_quality(docs, rules).collect()) for rules in (Q.BASE + Q.CASCADE, tuple(reversed(Q.BASE + Q.CASCADE)))]
    assert kept[0] == kept[1] == Counter(repr(r.doc_id) for r in docs.collect() if not plain(r.text)[2])
    assert Q.drop_low_quality(clash).columns == clash.columns


def test_rules_are_ordered_by_rejection_per_cost(docs):
    found = {r.name: (share, cost) for r, share, cost in Q.estimated(docs, Q.BASE + Q.CASCADE)}
    n = docs.count()
    for r in Q.BASE + Q.CASCADE:
        assert found[r.name][0] == pytest.approx(sum(r.name in plain(x.text)[2] for x in docs.collect()) / n) and found[r.name][1] >= Q.LEAST_COST
    a, b, c = Q.CASCADE[:3]
    assert Q.ordered([(a, 0.1, 1.0), (b, 0.1, 0.1), (c, 0.5, 1.0)]) == [b, c, a]


def test_later_rules_are_not_asked(spark):
    docs = spark.createDataFrame([(1, "short")], "doc_id bigint, text string")
    wrong = Q.Rule("wrong", lambda m: Q.F.raise_error(Q.F.col("t")).cast("boolean"))
    assert Q.with_words(docs).select(Q.first_to_reject([Q.BASE[0], wrong])).first()[0] == "short"
