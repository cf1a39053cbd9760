"""Operator 13: quality rules as a short-circuit cascade.

A rule is a condition on a text's measures that rejects it. On a bounded sample each rule is
run by itself: what it rejects and how long it takes there give its rejection per cost, and
the cascade asks the rules in that order, a text no further than up to the first that
rejects it; measures are found where a rule asks for them. The order decides how much is
computed, never what is kept. DataFrame functions only.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, sampled, saved, text_of

#: Characters that are symbols, white space, and ASCII letters of either case.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window that may be repeated.
WINDOW = 5
#: Texts on which rules are tried, and how often each is timed.
SAMPLE, TIMES = 2000, 2
#: Seconds that a rule counts as taking on the sample at least: less cannot be told from the time for reading it.
LEAST_COST = 0.02

Measure = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """reject gives the condition, from a function that gives a measure by its name. A condition that is null does not reject."""

    name: str
    reject: Callable[[Measure], Column]

    def rejects(self, m: Measure) -> Column:
        return F.coalesce(self.reject(m), F.lit(False))


#: The rules that any text has to pass, and those of the cascade, with their limits.
BASE = (
    Rule("short", lambda m: m("n_words") < 10),
    Rule("repeats", lambda m: m("n_repeat_words") * 100 > m("n_words") * 20),
)
CASCADE = (
    Rule("symbols", lambda m: m("n_symbols") * 10 > m("n_words")),
    Rule("shouting", lambda m: m("n_upper") > m("n_lower")),
    Rule("marks", lambda m: m("n_marks") * 2 > m("n_words")),
    Rule("lines", lambda m: m("n_dup_lines") * 10 > m("n_lines") * 3),
    Rule("word_length", lambda m: (m("word_chars") < m("n_words") * 2) | (m("word_chars") > m("n_words") * 20)),
    Rule("letters", lambda m: m("n_letters") * 2 < m("word_chars")),
)


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value found once however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _among(characters: str) -> Column:
    return (F.length("t") - F.length(F.translate("t", characters, ""))).cast("bigint")


def _lines() -> Column:
    return F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")


def _repeat_words() -> Column:
    """How many words lie in a window that occurs twice or more.

    Where no two windows have the same hash there is none. Else windows are sorted by hash,
    words and place, equal neighbours are found, and the words that their places cover are
    counted: some n log n steps for n words, and exact. Words are bound once, so that a
    filter which is pushed below them does not split the text for each of its words.
    """
    window = lambda w, i: [F.get(w, i + k) for k in range(WINDOW)]
    hashed = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*window(w, i)))

    def places(w: Column, h: Column) -> Column:
        one = lambda i: F.struct(F.get(h, i).alias("h"), F.array(*window(w, i)).alias("w"), i.alias("i"))
        same = lambda a, b: F.when((a["h"] == b["h"]) & (a["w"] == b["w"]), F.array(a["i"], b["i"]))
        beside = let(F.array_sort(F.transform(F.sequence(F.lit(0), F.size(h) - 1), one)), lambda s: F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), same))
        return F.array_sort(F.array_distinct(F.flatten(F.filter(beside, lambda x: x.isNotNull()))))

    def covered(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p) + 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
        return F.aggregate(steps, none, lambda a, v: a + v)

    none = F.lit(0).cast("bigint")
    several = lambda w, h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(places(w, h), covered)).otherwise(none)
    return let(F.col("words"), lambda w: F.when(F.size(w) > WINDOW, let(hashed(w), lambda h: several(w, h))).otherwise(none))


#: What rules may ask for, over columns t (a text, never null) and words.
MEASURES: dict[str, Callable[[], Column]] = {
    "n_words": lambda: F.size("words").cast("bigint"),
    "word_chars": lambda: F.length(F.translate("t", BLANKS, "")).cast("bigint"),
    "n_symbols": lambda: _among(SYMBOLS),
    "n_upper": lambda: _among(UPPER),
    "n_lower": lambda: _among(LOWER),
    "n_marks": lambda: _among("!?"),
    "n_letters": lambda: F.length(F.regexp_replace("t", r"\P{L}+", "")).cast("bigint"),
    "n_lines": lambda: F.size(_lines()).cast("bigint"),
    "n_dup_lines": lambda: let(_lines(), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
    "n_repeat_words": _repeat_words,
}


def with_words(docs: DataFrame, *keep: str) -> DataFrame:
    """keep, t (the text, null is empty) and words, its runs of characters that are not white space."""
    flat = F.translate("t", BLANKS, " " * len(BLANKS))
    return docs.select(*keep, text_of().alias("t")).withColumn("words", F.filter(F.split(flat, " "), lambda w: w != ""))


def inline(name: str) -> Column:
    """A measure where it is asked for."""
    return MEASURES[name]()


def estimated(docs: DataFrame, rules: tuple[Rule, ...] = CASCADE, sample: int = SAMPLE) -> list[tuple[Rule, float, float]]:
    """(rule, share of texts that it rejects, seconds) of each rule by itself over at most sample of docs(text), those with the smallest hash."""
    some = saved(sampled(docs.select("text"), "text", sample))
    x = with_words(some)

    def run(reject: Column) -> tuple[int, int, float]:
        best = float("inf")
        for _ in range(TIMES):
            began = time.perf_counter()
            n, hits = x.agg(F.count("*"), F.count_if(reject)).first()
            best = min(best, time.perf_counter() - began)
        return n, hits, best

    n, _, reading = run(F.size("words") < 0)
    out = []
    for r in rules:
        _, hits, seconds = run(r.rejects(inline))
        out.append((r, hits / n if n else 0.0, max(seconds - reading, LEAST_COST)))
    return out


def ordered(estimates: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by what they reject a second, most first; equal ones by their cost, then as they were given."""
    return [r for r, _, _ in sorted(estimates, key=lambda x: (-x[1] / x[2], x[2]))]


def first_to_reject(rules: list[Rule], m: Measure = inline) -> Column:
    """The name of the first rule that rejects; null if none does. Later ones are not asked."""
    out = F
    for r in rules:
        out = out.when(r.rejects(m), F.lit(r.name))
    return out if rules else F.lit(None).cast("string")


def with_verdict(docs: DataFrame, rules: tuple[Rule, ...] = BASE + CASCADE, sample: int = SAMPLE) -> DataFrame:
    """docs(text, ...) with rejected_by, the name of a rule that rejects the text, of several the one that is asked first; null if none does.

    Null text is empty, and so short. Whole texts, of any length. Other columns stay as they
    are, one named rejected_by, in whatever case, is replaced. Which of several rules is named
    may differ from run to run, as it goes by measured time; whether there is one does not.
    """
    rules = ordered(estimated(docs, rules, sample))
    kept = [c for c in docs.columns if c.lower() != "rejected_by"]
    x = with_words(packed(docs, kept, text=F.col("text")), "row")
    return x.select("row", first_to_reject(rules).alias("rejected_by")).select("row.*", "rejected_by")


def drop_low_quality(docs: DataFrame, rules: tuple[Rule, ...] = BASE + CASCADE, sample: int = SAMPLE) -> DataFrame:
    """Rows of docs(text, ...) that no rule rejects, columns as they are."""
    rules = ordered(estimated(docs, rules, sample))
    return with_words(packed(docs, text=F.col("text")), "row").where(first_to_reject(rules).isNull()).select("row.*")


def report(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """For each of docs(doc_id, text): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed by BASE, and kept, which is false where base_failed and else says that no rule of CASCADE rejects.

    Null text has no words. Repeated and null doc_ids each give their row, an empty table none.
    """
    told = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rules = ordered(estimated(docs, CASCADE, sample))
    x = with_words(docs.select("doc_id", "text"), "doc_id").select("doc_id", "t", "words", *[MEASURES[c]().alias(c) for c in told])
    found = lambda name: F.col(name) if name in told else inline(name)
    failed = BASE[0].rejects(found) | BASE[1].rejects(found)
    return x.withColumn("base_failed", failed).select("doc_id", *told, "base_failed", F.when(F.col("base_failed"), False).otherwise(first_to_reject(rules, found).isNull()).alias("kept"))
