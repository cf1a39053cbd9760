"""Repair of conversations against a plain cheapest-path search and a plain reading of the contract."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from labelloom.llm import turn_repair as T

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def plain_cheapest(initials, faults, entry=0, exits=(0, 3), last=True):
    """Uniform-cost search over (cost, edits)."""
    heap, done = [(0, "", 0, entry)], set()
    while heap:
        c, p, i, q = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(initials) and q in exits:
            return c, p
        row = i < len(initials)
        out = [("I", 2, i, 3 if q == 2 else 2)] if row or last else []
        if row:
            late = int(faults[i] == "t")
            out.append(("D", 3, i + 1, q))
            if faults[i] not in "bd":
                fits = {"s": (0,), "u": (0, 1, 3), "a": (2,)}.get(initials[i], ())
                if q in fits:
                    out.append(("K", late, i + 1, {"s": 1, "u": 2, "a": 3}[initials[i]]))
                out.append(("R", 2 + late, i + 1, 3 if q == 2 else 2))
        for e, cost, j, t in out:
            heapq.heappush(heap, (c + cost, p + e, j, t))
    return None


def plain_digest(rows):
    """rows (conv_id, turn, role, text) as the contract has them, one conversation after the other."""
    kept = {r[0]: [] for r in rows}
    sp = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        how, role, text = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20, sp(role), sp(text)
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        kept[conv] += [(turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    out = {}
    for conv, g in kept.items():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), ""
        for _, role, text in g:
            said = BLANK.findall(text)
            faults += "b" if not said else "d" if (role, text) in seen else "k" if said[-1] in ".!?" else "t"
            seen.add((role, text))
        initials = "".join(r[1][:1] if r[1][:1] in ("s", "u", "a") else "x" for r in g)
        cost, audit = plain_cheapest(initials, faults)
        turns = [r[0] for r in g if r[0] is not None]
        lines, at, last = [], 0, ""
        for e in audit:
            fits = "assistant" if last == "u" else "user"
            if e == "I":
                lines.append(f"{fits}:")
            elif e in "KR":
                lines.append(f"{g[at][1] if e == 'K' else fits}:{g[at][2]}")
            at += e != "I"
            last = lines[-1][0] if lines else ""
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def some_row(rng, initials, faults, n):
    return "".join(rng.choice(initials) for _ in range(n)), "".join(rng.choice(faults) for _ in range(n))


def test_search_is_cheapest_and_first_in_order():
    rng = random.Random(11)
    for _ in range(4000):
        initials, faults = some_row(rng, rng.choice(["ua", "suax", "uuua", "sx"]), rng.choice(["bdtk", "tk", "k"]), rng.randrange(0, 11))
        last = rng.random() < 0.5 or not initials
        entry, exits = rng.randrange(4), T.ACCEPTING if last else (rng.randrange(4),)
        assert T.cheapest(initials, faults, entry, exits, last) == plain_cheapest(initials, faults, entry, exits, last)


def test_bounds_are_never_above_the_cost():
    rng = random.Random(12)
    for _ in range(300):
        initials, faults = some_row(rng, "suaxua", "bdtkkk", rng.randrange(1, 9))
        need = T.lower_bounds(initials, faults, T.ACCEPTING, True)
        for i in range(len(initials) + 1):
            for q in range(4):
                assert need[4 * i + q] <= plain_cheapest(initials[i:], faults[i:], q)[0]


def test_runs_put_together_give_the_search_of_the_whole():
    rng = random.Random(13)
    for _ in range(500):
        n = rng.randrange(3, 14)
        initials, faults = some_row(rng, "suaxua", "bdtkkk", n)
        cuts = [0, *sorted(rng.sample(range(1, n), 2)), n]
        parts = list(zip(cuts, cuts[1:]))
        ways = [T.every_way(initials[a:b], faults[a:b], a == 0, b == n) for a, b in parts]
        path = T.through([c for c, _ in ways], [r for _, r in ways])
        got = [T.cheapest(initials[a:b], faults[a:b], e, (m,), b == n) for (a, b), (e, m) in zip(parts, path)]
        assert (sum(c for c, _ in got), "".join(p for _, p in got)) == T.cheapest(initials, faults)


def conversations(seed, n):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.randrange(1, 12)):
            text = rng.choice(["Yes.", "no", "Really?! ", "", " \t", "ok.\n", "ok .\x0b\x1f", "Fine. And", None, "é ", "So be it!" + " " * 100, "it ends" + "\t" * 100])
            rows.append((c, rng.choice([t, t, t, t + 1, None]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), text))
    return rows


@pytest.mark.parametrize("block", [256, 3])
def test_repair_against_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK", block)
    rows = conversations(1, 60) + [(None, 0, "user", "a."), (None, 1, "user", "a."), (7, 0, "user", "long " * 40_000), (999, None, None, None)]
    rows += [(10**6, t, "ua"[t % 2] + "x", f"t{t % 50}.") for t in range(400)]  # far more than others have
    rows += [(5000 + i, 0, "user", "Hi.") for i in range(40)]  # some of them lose all they have
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'x' as edits", "1 as at").repartition(5)
    got = T.digest(df)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.columns == ["conv_id", *names] and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
    got = got.collect()
    want = plain_digest(rows)
    assert len(got) == len(want) and {r.conv_id: tuple(r[c] for c in names) for r in got} == want
    assert any(r[6] == "" for r in want.values())


def test_repaired_turns_are_legal_and_an_empty_table_gives_none(spark):
    df = spark.createDataFrame(conversations(2, 40), "conv_id bigint, turn bigint, role string, text string")
    edits, turns = T.repair(T.damage(df))
    by = {}
    for r in turns.collect():
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    for g in by.values():
        assert re.fullmatch("s?(ua)+", "".join(r[:1] for r, _ in g))
    assert edits.where("length(edits) > 0").count() > 0
    assert T.digest(df.limit(0)).count() == 0
