"""Operator 11: conversation structure repair by iterative-deepening A*.

A conversation should read `(s?(ua)+)?` by its roles' initials. Each row is kept (K, 0),
given the role that fits (R, 2) or deleted (D, 3); a user or assistant turn without text may
be inserted anywhere (I, 2); a truncated row that stays costs 1 more, and blank rows and
repeated ones must go. The edits are found by depth-first search in the order D, I, K, R
under a bound on the cost. What fails is remembered with the cost that it needs at least, for
this bound and the next ones, and the first accepting path is the cheapest and of those the
least by ASCII.

A conversation may have any share of all rows. Rows get their place in one range-partitioned
sort of narrow columns; runs of at most BLOCK of them are searched one by one. Where a
conversation has several runs, each is searched from every state to every state, the costs
of these are added up along the conversation, 32 numbers a run, and say which states the
cheapest path passes; then each run is searched between its two. Texts are shuffled once,
and read in order. Only the hash of a whole conversation is taken by one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..plans.select import numbered
from .common import SPACE, saved

#: Rows that are searched together at most.
BLOCK = 256
#: States: nothing yet, after system, after user, after assistant. What a state lets in next, and what may be inserted.
START, S, U, A = range(4)
_KEPT = {("s", START): S, ("u", START): U, ("u", S): U, ("u", A): U, ("a", U): A}
_FITS = (U, U, A, U)
_ROLE = {U: "user", A: "assistant"}
ACCEPTING = (START, A)
_NEVER = 1 << 40


def _moves(initial: str, fault: str, q: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows used, state after) from state q at a row, in ASCII order; at the end of a conversation initial is empty."""
    out = [("D", 3, 1, q)] if initial else []
    out.append(("I", 2, 0, _FITS[q]))
    if initial and fault not in "bd":
        late = int(fault == "t")
        if (initial, q) in _KEPT:
            out.append(("K", late, 1, _KEPT[initial, q]))
        out.append(("R", 2 + late, 1, _FITS[q]))
    return out


_MOVES = {(i, f): [_moves(i, f, q) for q in range(4)] for i in ("s", "u", "a", "x") for f in "bdtk"}
_END = [_moves("", "k", q) for q in range(4)]


def lower_bounds(initials: str, faults: str, exits: tuple[int, ...], last: bool) -> list[int]:
    """For each row i and state q, at 4 i + q, a cost that the rest needs at least.

    Blank and repeated rows need 3, truncated ones 1, a role that is neither user nor
    assistant 2, and of rows of one role in a row every change of step an edit of 2; a
    rewritten row mends two such changes. From the start, a system row may stay.
    """
    n = len(initials)
    need = [0] * (4 * n + 4)
    for q in range(4):
        if q in exits:
            continue
        closing = {U: 2, S: 4, START: 4}.get(q, _NEVER) if last and A in exits else _NEVER
        need[4 * n + q] = closing
    base, system, one, two = 0, False, ("x", 0), ("x", 0)  # of the next row that may stay, and of the one after it: initial and edits
    steps = 0
    for i in range(n - 1, -1, -1):
        c, f = initials[i], faults[i]
        if f in "bd":
            base += 3
        else:
            base += f == "t"
            if c in "sx":
                base, system, c = base + 2, system or c == "s", "x"
            elif c == one[0]:
                steps = 1 + (two[1] if two[0] == c else one[1])
            one, two = (c, steps), one
        h = base + 2 * steps
        for q in range(4):
            need[4 * i + q] = max(0, h - 2 * (system and q == START))
        if S not in exits or not system:
            if not {U, A, S if not system else S} & set(exits) and START in exits:
                need[4 * i + S] = _NEVER
        if not {U, A} & set(exits):
            need[4 * i + U] = need[4 * i + A] = _NEVER
            if START not in exits and not system:
                need[4 * i + START] = _NEVER
    return need


def cheapest(initials: str, faults: str, entry: int = START, exits: tuple[int, ...] = ACCEPTING, last: bool = True) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest path from state entry to one of exits, of equal ones the least by ASCII; None if there is none.

    initials: s, u, a or x (anything else) a row; faults: b(lank), d(uplicate), t(runcated) or
    k(eeps) a row. last: insertions may follow the last row.
    """
    n = len(initials)
    moves = [_MOVES[x] for x in zip(initials, faults)]
    moves.append(_END if last else [[], [], [], []])
    goals = {4 * n + q for q in exits}
    need = lower_bounds(initials, faults, exits, last)
    while (bound := need[entry]) < _NEVER:
        nodes, left, path, todo = [entry], [bound], [], [iter(moves[0][entry])]
        while nodes:
            at, rest = nodes[-1], left[-1]
            if at in goals:
                return bound - rest, "".join(path)
            first = at & ~3
            for edit, cost, used, q in todo[-1]:
                to = first + 4 * used + q
                if cost + need[to] <= rest:
                    nodes.append(to)
                    left.append(rest - cost)
                    path.append(edit)
                    todo.append(iter(moves[to >> 2][to & 3]))
                    break
            else:  # failed: the table keeps what it takes at least from here
                need[at] = min((cost + need[first + 4 * used + q] for _, cost, used, q in moves[at >> 2][at & 3]), default=_NEVER)
                for x in (nodes, left, todo):
                    x.pop()
                if path:
                    path.pop()
    return None


def every_way(initials: str, faults: str, first: bool, last: bool) -> tuple[list[int], list[int]]:
    """For each pair of states at 4 entry + exit: the cheapest cost, and the place of its edits among those from the same entry, in ASCII order."""
    costs, ranks = [_NEVER] * 16, [0] * 16
    for e in (START,) if first else range(4):
        found = {m: x for m in (ACCEPTING if last else range(4)) if (x := cheapest(initials, faults, e, (m,), last))}
        for rank, m in enumerate(sorted(found, key=lambda m: found[m][1])):
            costs[4 * e + m], ranks[4 * e + m] = found[m][0], rank
    return costs, ranks


def through(costs: list[list[int]], ranks: list[list[int]]) -> list[tuple[int, int]]:
    """The states before and after each of a conversation's runs on its cheapest path, of equal ones the least by ASCII."""
    togo = [[0] * 4]
    for c in reversed(costs):
        togo.append([min(c[4 * e + m] + togo[-1][m] for m in range(4)) for e in range(4)])
    out, e = [], START
    for k, (c, r) in enumerate(zip(costs, ranks)):
        rest, after = togo[len(costs) - k], togo[len(costs) - k - 1]
        m = min((m for m in range(4) if c[4 * e + m] < _NEVER and c[4 * e + m] + after[m] == rest[e]), key=lambda m: r[4 * e + m])
        out.append((e, m))
        e = m
    return out


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


# ---- over tables ----


def damage(conversations: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) damaged by crc32 of "conv_id:turn" modulo 20: 0 drops a row, 1 empties its text, 2 takes its [.!?], 3 repeats it, 4 makes the user say it. Null roles and texts are one space, so are nulls in the key."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    x = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("how")).where("how <> 0")
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return x.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("how") == 3, 2).otherwise(1))).alias("again")).drop("again")


def _initial(role: str = "role") -> Column:
    c = F.substring(role, 1, 1)
    return F.when(c.isin("s", "u", "a"), c).otherwise("x")


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


def runs(rows: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text): (conv_id, at, initials, faults, before, first, last, blank, duplicate, truncated) for each run of at most BLOCK rows. Written."""
    final = F.right(F.rtrim(F.regexp_replace(F.right("text", F.lit(64)), SPACE, " ")), F.lit(1))
    # where the last 64 characters are all white space, the whole text is looked at
    final = F.when(final != "", final).otherwise(F.right(F.rtrim(F.translate("text", "\t\n\x0b\f\r", "     ")), F.lit(1)))
    narrow = rows.select("conv_id", "turn", "role", _digest().alias("digest"), final.alias("final"), F.monotonically_increasing_id().alias("again"))
    narrow = narrow.select("conv_id", "turn", "role", "digest", F.when(F.col("final") == "", "b").when(~F.col("final").isin(".", "!", "?"), "t").otherwise("k").alias("fault"), "again")
    # equal rows are told apart by the number of their place in the input, so that no key is hot
    placed = saved(numbered(narrow, "conv_id", "turn", "role", "digest", "again", name="at").drop("again", "turn"))
    seen = placed.where("fault <> 'b'").groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    x = placed.select("conv_id", "at", _initial().alias("initial"), "fault").join(seen, "at", "left")
    x = x.withColumn("fault", F.when((F.col("fault") != "b") & F.col("new").isNull(), "d").otherwise(F.col("fault")))
    one = F.array_sort(F.collect_list(F.struct("at", "initial", "fault")))
    x = x.groupBy("conv_id", F.expr(f"at div {BLOCK}").alias("block")).agg(one.alias("rows"), *[F.count_if(F.col("fault") == k[0]).alias(k) for k in ("blank", "duplicate", "truncated")])
    text = lambda c: F.array_join(F.transform("rows", lambda r: r[c]), "")
    x = x.select("conv_id", F.element_at("rows", 1)["at"].alias("at"), text("initial").alias("initials"), text("fault").alias("faults"), "blank", "duplicate", "truncated")
    order = W.partitionBy("conv_id").orderBy("at")  # over runs, one for up to BLOCK rows
    ends = {"before": F.coalesce(F.right(F.lag("initials").over(order), F.lit(1)), F.lit("")), "first": F.lag("at").over(order).isNull(), "last": F.lead("at").over(order).isNull()}
    return saved(x.withColumns(ends))


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [every_way(r["initials"], r["faults"], r["first"], r["last"]) for r in b.to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("at"), pa.array([c for c, _ in found], pa.list_(pa.int64())), pa.array([r for _, r in found], pa.list_(pa.int64()))], ["conv_id", "at", "costs", "ranks"])


def _through(t: pa.Table) -> pa.Table:
    t = t.sort_by("at")
    path = through(t["costs"].to_pylist(), t["ranks"].to_pylist())
    return pa.table({"at": t["at"], "entry": pa.array([e for e, _ in path], pa.int64()), "exit": pa.array([m for _, m in path], pa.int64())})


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [cheapest(r["initials"], r["faults"], r["entry"] or START, ACCEPTING if r["exit"] is None else (r["exit"],), r["last"]) for r in b.to_pylist()]
        pairs = [illegal_pairs(p + i) for p, i in zip(b.column("before").to_pylist(), b.column("initials").to_pylist())]
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("conv_id", "at", "blank", "duplicate", "truncated")], pa.array(pairs, pa.int64()), pa.array([c for c, _ in found], pa.int64()), pa.array([p for _, p in found], pa.string())], ["conv_id", "at", "blank", "duplicate", "truncated", "illegal", "cost", "edits"])


def searched(pieces: DataFrame) -> DataFrame:
    """runs() with their cheapest edits: (conv_id, at, blank, duplicate, truncated, illegal, cost, edits)."""
    several = pieces.where("not (first and last)")
    key = pieces.schema["conv_id"].dataType.simpleString()
    ways = several.select("conv_id", "at", "initials", "faults", "first", "last").mapInArrow(_ways, f"conv_id {key}, at bigint, costs array<bigint>, ranks array<bigint>")
    path = ways.groupBy("conv_id").applyInArrow(_through, "at bigint, entry bigint, exit bigint")
    none = F.lit(None).cast("bigint")
    both = pieces.where("first and last").withColumns({"entry": none, "exit": none}).unionByName(several.join(path, "at"))
    return both.mapInArrow(_search, f"conv_id {key}, at bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, edits string")


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, role, text) of repaired turns, from rows in order (conv_id, edits, role, text): a conversation's edits come before its rows."""
    now, edits, at, end, q = object(), "", 0, 0, START
    for conv, more, role, text in rows:
        if conv != now:
            now, edits, at, q = conv, "", 0, START
        if more is not None:
            edits += more
            end = len(edits.rstrip("I"))  # the last row's edit stands before it
            continue
        while edits[at] == "I":
            q = _FITS[q]
            yield conv, _ROLE[q], ""
            at += 1
        if edits[at] != "D":
            q = _KEPT[role[:1], q] if edits[at] == "K" else _FITS[q]
            yield conv, role if edits[at] == "K" else _ROLE[q], text
        at += 1
        if at == end:
            for _ in edits[end:]:
                q = _FITS[q]
                yield conv, _ROLE[q], ""


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, role, text): the turns after the edits of searched(), in order within a partition; a conversation lies in one.

    Rows go by conv_id, turn, role and the SHA-256 of their text, as they were searched. They
    are read as a stream; of a conversation only its edits are in memory, a letter or so a row.
    """
    null = lambda t: F.lit(None).cast(t)
    turns = rows.select("conv_id", F.lit(1).alias("kind"), null("bigint").alias("at"), "turn", "role", _digest().alias("digest"), "text", null("string").alias("edits"))
    ahead = edits.select("conv_id", F.lit(0).alias("kind"), "at", null(rows.schema["turn"].dataType).alias("turn"), null("string").alias("role"), null("binary").alias("digest"), null("string").alias("text"), "edits")
    key = to_arrow_type(rows.schema["conv_id"].dataType)
    both = turns.unionByName(ahead).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "at", "turn", "role", "digest").select("conv_id", "edits", "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*[b.column(c).to_pylist() for c in ("conv_id", "edits", "role", "text")])

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], key), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.string())], ["conv_id", "role", "text"])

        out, size = [], 0
        for r in _edited(each()):
            out.append(r)
            size += len(r[2])
            if len(out) == 4096 or size > 1 << 22:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)

    return both.mapInArrow(run, f"conv_id {kind}, role string, text string")


def hashed(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of turns(conv_id, role, text) that repaired() gives: of "role:text", newline-joined. A conversation without turns gives no row."""
    kind, key = turns.schema["conv_id"].dataType.simpleString(), to_arrow_type(turns.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for b in batches:
            out = []
            for conv, role, text in zip(*[b.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
                if h is None or conv != now:
                    if h is not None:
                        out.append((now, h.hexdigest()))
                    now, h = conv, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], key), pa.array([x for _, x in out], pa.string())], ["conv_id", "sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], key), pa.array([h.hexdigest()])], ["conv_id", "sha256"])

    return turns.mapInArrow(run, f"conv_id {kind}, sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is wrong with rows(conv_id, turn, role, text) and the cheapest edits, run by run, as searched() returns them; and the repaired turns (conv_id, role, text).

    Rows of a conversation go by turn, nulls first, of a turn by role, then by the SHA-256 of
    the text. Roles and texts must not be null. A null conv_id is a conversation like others.
    A role counts by its first character; one that begins otherwise than user, assistant and
    system do, or is empty, cannot stay as it is. Other columns are not read. An empty table
    gives none.
    """
    rows = rows.select("conv_id", "turn", "role", "text")
    edits = saved(searched(runs(rows)))
    return edits, repaired(rows, edits)


def digest(conversations: DataFrame) -> DataFrame:
    """Of conversations(conv_id, turn, role, text), damaged: a row for each conv_id with gaps, faults, illegal pairs, cost, audit and the hash of what repair() makes of it.

    Conversations of which nothing is left have zeros, an empty audit and the hash of nothing.
    """
    rows = damage(conversations.select("conv_id", "turn", "role", "text"))
    edits, turns = repair(rows)
    gap = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    gaps = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn")).distinct().groupBy("conv_id").agg(gap.alias("gaps"))
    sums = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = [conversations.select("conv_id").distinct(), gaps, edits.select("conv_id", *sums[1:], F.struct("at", "edits").alias("edits")), hashed(turns)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    audit = F.array_join(F.transform(F.array_sort(F.collect_list("edits")), lambda x: x["edits"]), "").alias("audit")
    empty = hashlib.sha256().hexdigest()
    return every.groupBy("conv_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in sums], audit, F.coalesce(F.max("sha256"), F.lit(empty)).alias("repaired_sha256"))
