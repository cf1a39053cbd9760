"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, pii, quality, secrets_scan, turn_repair
from .cross_tokens import alignment
from .decontam import contaminated
from .exact_dedup import exact_dedup
from .mixing import mix
from .simhash import near_duplicates
from .suffix_dedup import PASSAGE, remove_repeats
from .token_counts import token_counts
from .toxicity import train, with_severity


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def op1_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mix(_documents(spark, d).select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken", "draws")


def op2_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(_documents(spark, d))


def op3_chat(spark: SparkSession, d: str) -> DataFrame:
    chosen, rejected = chat.stale_answers(spark.read.parquet(f"{d}/conversations.parquet"))
    return chat.preference_pairs(chosen, rejected, "conv_id")


def op4_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return remove_repeats(_documents(spark, d).select("doc_id", "text"), words=PASSAGE)


def op5_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secrets_scan.digest(secrets_scan.scan(_documents(spark, d)))


def op6_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return contaminated(_documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"))


def op7_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup(_documents(spark, d), carry=["doc_id"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_pii(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d).select("doc_id", "text")
    return pii.find(docs, pii.train(docs))


def op9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d)
    return with_severity(docs.select("doc_id", "text"), train(docs, spark.read.parquet(f"{d}/labels.parquet"))).select("doc_id", "severity", "p_toxic", "toxic")


def op10_simhash(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(_documents(spark, d).select("doc_id", "text"))


def op11_turn_repair(spark: SparkSession, d: str) -> DataFrame:
    return turn_repair.digest(spark.read.parquet(f"{d}/conversations.parquet"))


def op12_cross_tokens(spark: SparkSession, d: str) -> DataFrame:
    return alignment(_documents(spark, d))


def op13_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.report(_documents(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_token_counts": op2_token_counts,
    "op3_chat": op3_chat,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_secrets": op5_secrets,
    "op6_decontamination": op6_decontamination,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_turn_repair": op11_turn_repair,
    "op12_cross_tokens": op12_cross_tokens,
    "op13_quality": op13_quality,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_SHINGLES = "list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))"

_TURN = "concat('<|', role, '|>\n', {}, '\n<|end|>\n')"


def _secrets_sql() -> str:
    """Spans from the pieces between matches: a match begins after all pieces up to it and all matches before it."""
    spans, quoted = [], lambda p: "'" + p.replace("'", "''") + "'"
    for o, r in enumerate(secrets_scan.RULES):
        m, parts = f"regexp_extract_all(t, {quoted(r.pattern)})", f"string_split_regex(t, {quoted(r.pattern)})"
        value = f"regexp_extract_all(t, {quoted(r.pattern)}, {r.group})"
        ahead = "coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
        made = f"list_filter(list_transform(range(1, len(m) + 1), lambda i: {{'b': CAST({ahead} AS BIGINT), 'o': {o}, 'e': CAST({ahead} + length(m[i]) AS BIGINT), 'k': '{r.kind}', 'n': length(v[i])}}), lambda z: z.n >= {r.least})"
        spans.append(f"s{o} AS (SELECT r, {made} AS s{o} FROM (SELECT r, {m} AS m, {value} AS v, {parts} AS p FROM d))")
    line = lambda n: "array_to_string(list_transform(list_sort(" + "list_concat(" * (n - 1) + "s0" + "".join(f", s{i})" for i in range(1, n)) + "), lambda z: concat(z.k, ':', z.b, ':', z.e)), ',')"
    n, base = len(secrets_scan.RULES), len(secrets_scan.BASE)
    counts = ", ".join(f"CAST(len(s{i}) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(secrets_scan.BASE))
    return f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
{", ".join(spans)}
SELECT doc_id, {counts}, sha256({line(base)}) AS base_sha256, {line(n)} AS spans
FROM d {" ".join(f"JOIN s{i} USING (r)" for i in range(n))}"""


ORACLE_SQL: dict[str, str] = {
    "op3_chat": f"""
WITH x AS (SELECT conv_id, turn, m.role AS role, m.text AS text FROM (SELECT conv_id, turn, max({{'role': role, 'text': text}}) AS m FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2)),
l AS (SELECT conv_id, max(turn) AS last FROM x WHERE role = 'assistant' GROUP BY 1),
c AS (SELECT x.*, last FROM x JOIN l USING (conv_id) WHERE turn <= last),
o AS (SELECT conv_id, arg_max(text, turn) AS old FROM c WHERE role = 'assistant' AND turn < last GROUP BY 1),
r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS a, CASE WHEN turn < last THEN coalesce(text, '') ELSE coalesce(old, '') END AS b FROM c LEFT JOIN o USING (conv_id)),
t AS (SELECT *, {_TURN.format("a")} AS ta, {_TURN.format("b")} AS tb FROM r)
SELECT conv_id, CAST(count(*) FILTER (a = b) AS BIGINT) AS n_prompt, coalesce(string_agg(ta, '' ORDER BY turn) FILTER (a = b), '') AS prompt,
  coalesce(string_agg(ta, '') FILTER (a <> b), '') AS chosen, coalesce(string_agg(tb, '') FILTER (a <> b), '') AS rejected,
  coalesce(max(concat('14:', length(ta))) FILTER (a <> b), '') AS chosen_mask, coalesce(max(concat('14:', length(tb))) FILTER (a <> b), '') AS rejected_mask
FROM t GROUP BY conv_id""",
    "op5_secrets": _secrets_sql(),
    "op6_decontamination": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, row_number() OVER () AS r, w, least(5, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
ds AS (SELECT doc_id, r, unnest({_SHINGLES}) AS s FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k),
bs AS (SELECT item_id, r, s, count(*) OVER (PARTITION BY r) AS n_item FROM (SELECT item_id, r, unnest({_SHINGLES}) AS s FROM b))
SELECT doc_id, item_id, CAST(count(*) AS BIGINT) AS n_shared, CAST(n_item AS BIGINT) AS n_item
FROM ds JOIN bs USING (s) GROUP BY ds.r, doc_id, bs.r, item_id, n_item HAVING 10 * count(*) >= 8 * n_item""",
    "op7_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
  row_number() OVER g = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)""",
    "op13_quality": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
i AS (SELECT r, p, count(*) OVER (PARTITION BY r, five) AS n FROM (SELECT r, p, w[p:p + 4] AS five FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS p FROM w))),
p AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, unnest(range(p, p + 5)) AS word FROM i WHERE n > 1) GROUP BY r),
m AS (SELECT w.r, doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower,
  length(regexp_replace(t, '[^!?]', '', 'g')) AS marks, length(regexp_replace(t, '\P{L}+', '', 'g')) AS letters FROM w LEFT JOIN p ON w.r = p.r),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR upper > lower OR 2 * marks > n_words OR 10 * n_dup_lines > 3 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * letters < word_chars) AS kept
FROM b""",
}
