"""Operator 9: toxicity severity by cumulative-link ordinal regression.

Grades: 0 not toxic; a toxic document is 1, or 2 if it is labelled of low quality as well.
The model is P(y <= k) = sigmoid(theta_k - w.x) with ordered thresholds that share the
weights w; x says which words and word beginnings of a vocabulary occur in the whole text,
as a sparse row. The vocabulary is all those whose share among toxic documents is RATIO
times their share among the other labelled ones, and significantly so; Spark counts them.
The model is fitted in numpy on at most SAMPLE labelled documents, the ones with the
smallest hash of doc_id; every document is scored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import others, packed, sampled, saved, with_types

#: The most labelled documents that a model is fitted on.
SAMPLE = 8_000
#: What a feature has to reach to be in the vocabulary: z-score, and ratio of its shares.
Z, RATIO = 4.0, 4.0
#: Lengths in bytes of the word beginnings that are features.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Documents that are toxic (grade 1 or more) with at least this probability are rejected.
REJECT = 0.5
GRADES = 3
#: Words whose features in the vocabulary are remembered at a time.
REMEMBERED = 200_000

_LETTERS = re.compile(rb"[a-z\x80-\xff]+")


def _of_word(word: bytes) -> list[int]:
    return [zlib.crc32(word), *(zlib.crc32(word[:n]) for n in BEGINNINGS if len(word) > n)]


def _runs(text: str | None) -> set[bytes]:
    return set(_LETTERS.findall((text or "").encode().lower()))


def features(text: str | None) -> set[int]:
    """CRC-32 of each distinct run of letters, A-Z in lower case, and of its beginnings."""
    return {i for r in _runs(text) for i in _of_word(r)}


class Model:
    """Weights by feature, and the ordered thresholds."""

    def __init__(self, weights: dict[int, float], theta: np.ndarray):
        self.weights, self.theta = weights, theta
        self.known: dict[bytes, tuple[int, ...]] = {}

    def __getstate__(self) -> tuple:
        return self.weights, self.theta

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def score(self, text: str | None) -> tuple[float, float]:
        """(expected grade, probability of grade 1 or more)."""
        if not self.weights:
            return 0.0, 0.0
        ids: set[int] = set()
        for word in _runs(text):
            mine = self.known.get(word)
            if mine is None:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                mine = self.known[word] = tuple(i for i in _of_word(word) if i in self.weights)
            ids.update(mine)
        eta = sum(self.weights[i] for i in sorted(ids))
        above = 1 / (1 + np.exp(np.clip(self.theta - eta, -50, 50)))
        return float(above.sum()), float(above[0])


@dataclass
class Rows:
    """Sparse rows of 0 and 1: the columns of each, end to end, and where each row begins and the last ends; grades."""

    columns: np.ndarray
    at: np.ndarray
    grades: np.ndarray

    def times(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(w[self.columns])])
        return sums[self.at[1:]] - sums[self.at[:-1]]

    def transposed(self, g: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, np.repeat(g, np.diff(self.at)), width)


def thresholds(raw: np.ndarray) -> np.ndarray:
    """theta_0, and what each next one is above it as a logarithm."""
    return np.concatenate([raw[:1], raw[:1] + np.cumsum(np.exp(raw[1:]))])


def loss_and_gradient(par: np.ndarray, rows: Rows, l2: float) -> tuple[float, np.ndarray]:
    """Mean negative log likelihood, with l2 / 2 times the squared weights, of par: weights, then raw thresholds."""
    width, n, grades = len(par) - GRADES + 1, len(rows.grades), rows.grades
    w, raw = par[:width], par[width:]
    cdf = 1 / (1 + np.exp(-np.clip(thresholds(raw)[None] - rows.times(w)[:, None], -30, 30)))
    full = np.concatenate([np.zeros((n, 1)), cdf, np.ones((n, 1))], 1)
    pick = lambda m, k: np.take_along_axis(m, k[:, None], 1)[:, 0]
    prob = np.maximum(pick(full, grades + 1) - pick(full, grades), 1e-9)
    slope = np.concatenate([np.zeros((n, 1)), cdf * (1 - cdf), np.zeros((n, 1))], 1)
    up, low = pick(slope, grades + 1) / prob / n, pick(slope, grades) / prob / n
    g_theta = np.array([low[grades == k + 1].sum() - up[grades == k].sum() for k in range(GRADES - 1)])
    g_raw = np.array([g_theta[j:].sum() * (1 if j == 0 else np.exp(raw[j])) for j in range(GRADES - 1)])
    return float(-np.log(prob).mean() + l2 / 2 * w @ w), np.concatenate([rows.transposed(up - low, width) + l2 * w, g_raw])


def fit(rows: Rows, ids: list[int], steps: int = 300, l2: float = 1e-4) -> Model:
    """Adam on the mean log loss. Without both toxic and other documents, or without features, the model scores all as 0."""
    toxic = rows.grades > 0
    if not len(ids) or not toxic.any() or toxic.all():
        return Model({}, np.zeros(GRADES - 1))
    par = np.zeros(len(ids) + GRADES - 1)
    par[len(ids)] = np.log((1 - toxic.mean()) / toxic.mean())
    m, v = np.zeros_like(par), np.zeros_like(par)
    for t in range(1, steps + 1):
        _, grad = loss_and_gradient(par, rows, l2)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        par = par - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(dict(zip(ids, par[: len(ids)].tolist())), thresholds(par[len(ids) :]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` documents of docs(doc_id, text) that labels(doc_id, quality, toxic) covers.

    Of several labels of a document the highest toxic and lowest quality count; null toxic
    counts as no label, null quality as 1. Of several texts of a document the one whose
    features come first in order counts. Rows with a null doc_id are not used.
    """
    graded = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min(F.coalesce("quality", F.lit(1))).alias("quality"))
    graded = graded.select("doc_id", F.when(F.col("toxic") == 0, 0).when(F.col("quality") == 0, 2).otherwise(1).alias("grade"))
    # the bound holds before any text is read: ids and grades only, then their documents
    chosen = sampled(graded, "doc_id", sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [sorted(features(x.as_py())) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "grade", "ids"])

    found = rows.mapInArrow(run, "doc_id bigint, grade int, ids array<bigint>").groupBy("doc_id").agg(F.min(F.struct("grade", "ids")).alias("m"))
    found = saved(found.select("doc_id", "m.grade", "m.ids"))
    n1, n0 = found.agg(F.count_if(F.col("grade") > 0), F.count_if(F.col("grade") == 0)).first()
    each = found.select("doc_id", (F.col("grade") > 0).alias("toxic"), F.explode("ids").alias("id"))
    counts = each.groupBy("id").agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
    p, q, pool = (F.col("a") + 0.5) / (n1 + 1), (F.col("b") + 0.5) / (n0 + 1), (F.col("a") + F.col("b") + 1) / (n1 + n0 + 2)
    z = (p - q) / F.sqrt(pool * (1 - pool) * (1 / max(n1, 1) + 1 / max(n0, 1)))
    vocabulary = saved(counts.where((z >= Z) & (p / q >= RATIO)).select("id"))
    # what a bounded sample has of the vocabulary
    got = found.select("doc_id", "grade").toArrow().sort_by("doc_id")
    cells = each.select("doc_id", "id").join(vocabulary, "id").toArrow()
    ids = np.unique(cells.column("id").to_numpy())
    order = {d: k for k, d in enumerate(got.column("doc_id").to_pylist())}
    row, column = np.array([order[d] for d in cells.column("doc_id").to_pylist()], np.int64), np.searchsorted(ids, cells.column("id").to_numpy())
    by_row = np.lexsort((column, row))
    at = np.searchsorted(row[by_row], np.arange(len(order) + 1))
    return fit(Rows(column[by_row], at, got.column("grade").to_numpy().astype(np.int64)), ids.tolist())


def _scored(docs: DataFrame, columns: list[str], model: Model) -> DataFrame:
    """(row, severity, p_toxic), by the text in docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = packed(docs, columns)
    place = next(i for i, f in enumerate(rows.schema["row"].dataType.fields) if f.name.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            s = [model.score(x.as_py()) for x in b.column(0).field(place)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in s], pa.float64()), pa.array([x[1] for x in s], pa.float64())], ["row", "severity", "p_toxic"])

    return rows.mapInArrow(run, with_types(rows, "severity double, p_toxic double"))


def with_severity(docs: DataFrame, model: Model) -> DataFrame:
    """docs with severity (expected grade, 0 to 2), p_toxic and toxic (p_toxic >= REJECT), from each whole text.

    Null and empty texts have no features and get the score of the intercepts. All rows
    are kept, null doc_ids and repeated ones too, in a narrow pass; the model, with no more
    weights than its sample has features, is broadcast. Columns of the new names, in whatever
    case, are replaced. An empty table gives an empty table.
    """
    return _scored(docs, others(docs, "severity", "p_toxic", "toxic"), model).select("row.*", "severity", "p_toxic", (F.col("p_toxic") >= REJECT).alias("toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that the model, fitted on their labelled ones, rejects. All columns are kept as they are, whatever their names."""
    return _scored(docs, docs.columns, train(docs, labels)).where(F.col("p_toxic") < REJECT).select("row.*")
