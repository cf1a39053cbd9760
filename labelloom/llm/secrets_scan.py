"""Operator 5: secret scans by a trigram inverted index.

Each rule's regular expression gives a Boolean query over trigrams of ASCII lower-case
text: a concatenation needs all its parts, an alternative any of its branches. The index
holds, for each trigram that a query names and each block of doc_ids, the ids of the
documents that contain it. Postings are intersected and united by the queries, and only
the candidates are verified with the regular expression itself. Rules of which no trigram
is mandatory scan every text. DataFrame functions only; Python reads the patterns, which
are few and fixed, never the data.

Texts are never shuffled. Which documents are candidates comes to them as bitmaps of hashed
ids, at most MAX_BITS a rule, which are broadcast at any size; where ids share a bit, a
document that is no candidate is verified too, which finds nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, text_of


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """pattern is matched from left to right without overlap; a match counts if its `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


_NAMES = "|".join(either_case(x) for x in ("password", "passwd", "secret", "token")) + "|" + either_case("api") + "_?" + either_case("key")

#: The rules that are always reported and counted, then those that the scan adds. A rule that is nothing
#: but a repeated class says its least length in the pattern: the same matches, and shorter runs are not listed first.
BASE = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
)
RULES = BASE + ADDED

#: Documents of one block of the index: the ids that share doc_id div BLOCK.
BLOCK = 4096
#: Bits of a rule's bitmap: BITS_PER_ID for each candidate, up to MAX_BITS (4 MB).
BITS_PER_ID, MAX_BITS = 64, 1 << 25
#: Bits of one piece of it, as Spark's bitmap functions build them.
BITMAP = 32768
#: A character class of up to so many characters is spelled out in the query.
SPELLED = 6


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each a set of trigrams that must all occur in the lower-case text; an empty set matches anything."""

    # A part is a list of alternatives (texts in lower case) or None, where anything may stand.
    def parts(nodes) -> list[list[str] | None]:
        out: list[list[str] | None] = []
        for op, value in nodes:
            name = str(op)
            if name == "LITERAL":
                out.append([chr(value).lower()])
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value) and len(value) <= SPELLED:
                out.append(sorted({chr(v).lower() for _, v in value}))
            elif name == "SUBPATTERN":
                out += parts(value[3])
            elif name == "BRANCH" and all(x is not None for b in value[1] for x in parts(b)):
                out.append(sorted({"".join(t) for b in value[1] for t in product(*parts(b))}))
            elif name in ("MAX_REPEAT", "POSSESSIVE_REPEAT") and value[:2] == (0, 1) and all(x is not None for x in parts(value[2])):
                out.append(["", *("".join(t) for t in product(*parts(value[2])))])
            elif name == "MAX_REPEAT" and value[0] == value[1]:
                out += parts(value[2]) * value[0]
            else:
                out.append(None)
        return out

    # the run of parts with the longest shortest text decides
    best: list[str] = [""]
    run: list[str] = [""]
    for part in [*parts(re._parser.parse(pattern)), None]:
        if part is None or len(run) * len(part) > 64:
            if min(map(len, run)) > min(map(len, best)):
                best = run
            run = [""]
        if part is not None:
            run = [a + b for a in run for b in part] if len(run) * len(part) <= 64 else list(part)
    return sorted({frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in best}, key=sorted)


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """docs(doc_id, text): rows (doc_id, kinds), the rules whose trigram query a document of that id satisfies. Ids are not null."""
    queries = {r.kind: q for r in rules if all(q := trigram_query(r.pattern))}
    grams = sorted({g for q in queries.values() for clause in q for g in clause})
    low = F.lower(text_of())
    present = F.filter(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]), lambda x: x.isNotNull())
    # postings: the ids of a trigram in a block; sets, so at most BLOCK of them
    pairs = docs.where("doc_id is not null").select("doc_id", low.alias("low")).select("doc_id", F.explode(present).alias("gram")).withColumn("block", F.expr(f"doc_id div {BLOCK}"))
    postings = pairs.groupBy("block", "gram").agg(F.collect_set("doc_id").alias("ids"))
    lists = postings.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "ids"))).alias("ids"))
    none = F.array().cast("array<bigint>")
    ids = lambda g: F.coalesce(F.try_element_at("ids", F.lit(grams.index(g))), none)
    clause = lambda c: reduce(F.array_intersect, [ids(g) for g in sorted(c)])
    named = lambda kind: lambda i: F.struct(i.alias("doc_id"), F.lit(kind).alias("kind"))
    found = [F.transform(reduce(F.array_union, [clause(c) for c in q]), named(kind)) for kind, q in queries.items()]
    return lists.select(F.inline(F.concat(*found))).groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _bit(bits: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(bits))


def bitmaps(found: DataFrame, kinds: list[str], bits: int) -> DataFrame:
    """found(doc_id, kinds): rows (piece, b_<kind>...), the bits of hashed ids of each rule's candidates in pieces of BITMAP bits; at most bits / BITMAP rows."""
    at = found.select(_bit(bits).alias("bit"), "kinds")
    of = [F.expr(f"bitmap_construct_agg(pmod(bit, {BITMAP})) FILTER (WHERE array_contains(kinds, '{k}'))").alias(f"b_{k}") for k in kinds]
    return at.groupBy(F.expr(f"bit div {BITMAP}").alias("piece")).agg(*of)


def _set(bitmap: str) -> Column:
    """Whether column bit is set in the piece of a bitmap; null counts as not."""
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.expr(f"cast(pmod(bit, {BITMAP}) div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.expr("cast(pmod(bit, 8) as int)")) == 1, F.lit(False))


def _starts(lengths: Column) -> Column:
    """Sums of all elements before each, in steps of 256 so that the work stays in proportion."""
    zero = F.lit(0).cast("bigint")
    add = lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v))
    steps = F.sequence(F.lit(0), F.expr("(greatest(size(lengths), 1) - 1) div 256").cast("int"))
    chunks = F.transform(steps, lambda c: F.slice("lengths", c * 256 + 1, 256))
    sums = F.transform(chunks, lambda x: F.aggregate(x, zero, lambda a, v: a + v))
    ahead = F.aggregate(sums, F.array(zero), add)
    return F.flatten(F.zip_with(chunks, F.slice(ahead, 1, F.size(steps)), lambda x, at: F.slice(F.aggregate(x, F.array(at), add), 1, F.size(x))))


def with_spans(docs: DataFrame, rule: Rule, order: int, mine: Column) -> DataFrame:
    """docs(t, ...) with a column named after the rule: array of (start, order, end, kind) in code points, where mine holds."""
    found = F.when(mine, F.regexp_extract_all("t", F.lit(f"({rule.pattern})"), F.lit(1)))
    value = F.when(mine, F.regexp_extract_all("t", F.lit(rule.pattern), F.lit(rule.group))) if rule.group else F.col("found")
    gaps = F.when(mine, F.split("t", rule.pattern, -1))
    x = docs.withColumn("found", found).withColumn("value", value).withColumn("gaps", gaps)
    # a match begins after all gaps up to it and all matches before it
    x = x.withColumn("lengths", F.transform(F.arrays_zip("gaps", "found"), lambda z: F.length(z["gaps"]).cast("bigint") + F.coalesce(F.length(z["found"]), F.lit(0)).cast("bigint")))
    x = x.withColumn("starts", _starts(F.col("lengths")))
    spans = F.transform(F.arrays_zip("gaps", "found", "value", "starts"), lambda z: F.struct((z["starts"] + F.length(z["gaps"])).alias("b"), F.lit(order).alias("o"), (z["starts"] + F.length(z["gaps"]) + F.length(z["found"])).alias("e"), F.lit(rule.kind).alias("k"), F.length(z["value"]).alias("n")))
    spans = F.filter(spans, lambda z: F.coalesce(z["n"] >= rule.least, F.lit(False)))
    return x.withColumn(f"s_{rule.kind}", F.coalesce(spans, F.array().cast("array<struct<b:bigint,o:int,e:bigint,k:string,n:int>>"))).drop("found", "value", "gaps", "lengths", "starts")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row for each of docs(doc_id, text): doc_id and s_<kind>, the spans of each rule.

    Whole texts, null text is empty. Repeated doc_ids are candidates together and verified
    each for itself; rows with a null doc_id cannot be indexed and are all verified. Spans
    of different rules may overlap. Other columns are not read, whatever their names. An
    empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    indexed = saved(candidates(docs, rules))
    bits = BITMAP
    rows = indexed.count()
    while bits < min(MAX_BITS, BITS_PER_ID * rows):
        bits *= 2
    named = [r.kind for r in rules if all(trigram_query(r.pattern))]
    marks = saved(bitmaps(indexed, named, bits))
    at = docs.select("doc_id", text_of().alias("t"), _bit(bits).alias("bit")).withColumn("piece", F.expr(f"bit div {BITMAP}"))
    at = at.join(F.broadcast(marks), "piece", "left").select("doc_id", "t", *[(F.col("doc_id").isNull() | _set(f"b_{k}")).alias(f"c_{k}") for k in named])
    for order, rule in enumerate(rules):
        at = with_spans(at, rule, order, F.col(f"c_{rule.kind}") if rule.kind in named else F.lit(True))
    return at.select("doc_id", *[f"s_{r.kind}" for r in rules])


def digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Of scan's rows: doc_id, n_<kind> for each base rule, base_sha256 and spans."""
    one = lambda z: F.concat_ws(":", z["k"], z["b"].cast("string"), z["e"].cast("string"))
    line = lambda rs: F.concat_ws(",", F.transform(F.array_sort(F.concat(*[F.col(f"s_{r.kind}") for r in rs])), one))
    return scanned.select("doc_id", *[F.size(f"s_{r.kind}").cast("bigint").alias(f"n_{r.kind}") for r in base], F.sha2(line(base), 256).alias("base_sha256"), line(rules).alias("spans"))
