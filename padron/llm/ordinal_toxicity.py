"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

One weight per feature is shared by all thresholds: P(grade > k) is the logistic
function of (score - threshold k), thresholds ascending. The expected severity is
the sum of these probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.llm.common import WORD_TABLE, small_batches

#: Grades 0 (clean) to 3, and the expected severity from which a document is rejected.
GRADES, REJECT = 4, 0.4
PREFIX = 5


def features(text: bytes | None) -> set[bytes]:
    """The distinct words of a text, and the first letters of longer ones (marked by a leading 0 byte)."""
    words = set(text.translate(WORD_TABLE).split()) if text else set()
    return words | {b"\0" + w[:PREFIX] for w in words if len(w) > PREFIX}


class Model:
    """features: name -> number; weights; thresholds (ascending)."""

    def __init__(self, index: dict[bytes, int], weights: np.ndarray, thresholds: np.ndarray):
        self.index, self.weights, self.thresholds = index, weights, thresholds

    def severity(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Expected severity, and P(grade > k) as (texts, thresholds)."""
        score = np.array([self._score(t) for t in texts])
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -500, 500)))
        return p.sum(1), p

    def _score(self, text):
        at = [i for i in map(self.index.get, features(text)) if i is not None]
        return float(self.weights[at].sum()) if at else 0.0


def sample(documents: DataFrame, labels: DataFrame, per_class: int, max_bytes: int = 100_000) -> list[tuple[bytes, int]]:
    """At most about per_class texts of each label value, drawn by a hash of the id.

    Rows with null id, text or label are left out; an id labelled twice counts
    with its larger label, an id with several texts with the one of smallest hash.
    Texts of more than max_bytes are scored but not learned from.
    """
    y = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in y.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return []
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, per_class / n)))])
    drawn = y.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < F.element_at(share, F.col("toxic")) * 1_000_003)
    drawn = F.broadcast(drawn)  # at most about per_class rows of each of the few label values
    body = documents.where("text is not null").where(F.octet_length("text") <= max_bytes).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # one text of each id: partial minima, so an id repeated in many rows stays small
    rows = body.join(drawn, "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("text", "toxic").toArrow()
    return sorted(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()), key=lambda r: (r[1], r[0]))


def grade(toxic: np.ndarray, at: list[np.ndarray], words: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    """Severity grades of a labelled sample: 0 without the label, else 1 to 3 by thirds of the
    share of words that speak for the label (log odds above 2 within the sample).

    at: each text's feature numbers; words: which features are words; pos, neg: texts of either class with a feature.
    """
    n0, n1 = max(1, (~toxic).sum()), max(1, toxic.sum())
    speaks = words & (pos >= 3) & (np.log((pos + 0.5) / n1) - np.log((neg + 0.5) / n0) > 2)
    share = np.array([speaks[a].sum() / max(1, words[a].sum()) if t else 0.0 for a, t in zip(at, toxic)])
    out = np.zeros(len(at), int)
    if toxic.any():
        cuts = np.quantile(share[toxic], [1 / 3, 2 / 3])
        out[toxic] = 1 + np.searchsorted(cuts, share[toxic], side="right")
    return out


def fit(rows: list[tuple[bytes, int]], max_features: int = 20_000, min_docs: int = 5, min_chi2: float = 20.0, rounds: int = 300, decay: float = 5e-4, rate: float = 0.1) -> Model:
    """Fit shared weights and ordered thresholds by full-batch Adam on a bounded sample.

    rows: (text, label). A feature is used if its presence and the label depend on
    each other (chi-square of min_chi2 or more), the max_features strongest at most.
    An empty or one-class sample gives a model that scores everything 0 and
    rejects nothing.
    """
    none = Model({}, np.zeros(0), np.arange(GRADES - 1) + 8.0)
    toxic = np.array([r[1] > 0 for r in rows])
    if toxic.all() or not toxic.any():
        return none
    number: dict[bytes, int] = {}
    at = [np.array([number.setdefault(w, len(number)) for w in features(t)], np.int32) for t, _ in rows]
    pos, neg = (np.bincount(np.concatenate([a for a, t in zip(at, toxic) if t == want] or [np.zeros(0, np.int32)]), minlength=len(number)) for want in (True, False))
    names = list(number)
    words = np.array([w[:1] != b"\0" for w in names], bool)
    y = grade(toxic, at, words, pos, neg)
    n1, n0 = float(toxic.sum()), float((~toxic).sum())
    n, k = n1 + n0, (pos + neg).astype(float)
    chi2 = n * (pos * (n0 - neg) - neg * (n1 - pos)) ** 2 / np.maximum(1, k * (n - k) * n1 * n0)
    chosen = [i for i in np.lexsort((np.arange(len(names)), -chi2)) if chi2[i] >= min_chi2 and k[i] >= min_docs][:max_features]
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    index = {names[i]: j for j, i in enumerate(chosen)}
    del number, names
    at = [place[a][place[a] >= 0] for a in at]
    row = np.repeat(np.arange(len(rows)), [len(a) for a in at])
    col = np.concatenate(at).astype(np.int64)
    balance = np.where(toxic, 0.3 / n1, 0.7 / n0)
    w = np.zeros(len(index))
    # thresholds: the first is free, each step up is the exponential of a free value
    theta = np.concatenate([[1.0], np.zeros(GRADES - 2)])
    m = [np.zeros_like(w), np.zeros_like(theta)]
    v = [np.zeros_like(w), np.zeros_like(theta)]
    for step in range(1, rounds + 1):
        score = np.bincount(row, w[col], minlength=len(rows))
        cut = theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))])
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - cut[None, :], -500, 500)))
        # grade probabilities are differences of neighbouring cumulative ones
        full = np.concatenate([np.ones((len(rows), 1)), p, np.zeros((len(rows), 1))], 1)
        here = np.maximum(full[np.arange(len(rows)), y] - full[np.arange(len(rows)), y + 1], 1e-12)
        slope = np.concatenate([np.zeros((len(rows), 1)), p * (1 - p), np.zeros((len(rows), 1))], 1)
        up, down = slope[np.arange(len(rows)), y], slope[np.arange(len(rows)), y + 1]
        g_score = -(up - down) / here * balance
        g_cut = np.zeros(GRADES - 1)
        np.add.at(g_cut, np.clip(y - 1, 0, None), np.where(y > 0, up / here * balance, 0))
        np.add.at(g_cut, np.clip(y, None, GRADES - 2), np.where(y < GRADES - 1, -down / here * balance, 0))
        g_w = np.bincount(col, g_score[row], minlength=len(w)) + decay * w
        tail = np.cumsum(g_cut[::-1])[::-1]
        g_theta = np.concatenate([[tail[0]], tail[1:] * np.exp(theta[1:])])
        for k, (x, g) in enumerate(((w, g_w), (theta, g_theta))):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            x -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Model(index, w, theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))]))


def train(documents: DataFrame, labels: DataFrame, per_class: int = 2500, **args) -> Model:
    """A model from at most about per_class labelled documents of each label value."""
    return fit(sample(documents, labels, per_class), **args)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with three columns put in front: severity (expected grade), p_toxic (P(grade > 0)) and
    rejected (severity >= REJECT); one row per row of docs, whole texts.

    Null and empty texts have no features and are scored like any text without
    known words: they are not rejected. Columns of docs keep their values, those
    named like the three new ones are replaced. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # max_features words at most
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("severity", "p_toxic", "rejected")]
    text = kept.index("text")

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 1000):
                part = b.slice(a, 1000)
                expected, p = shared.value.severity(part.column(text).cast(pa.binary()).to_pylist())
                arrays = [pa.array(expected), pa.array(p[:, 0]), pa.array(expected >= REJECT)] + part.columns
                yield pa.RecordBatch.from_arrays(arrays, ["severity", "p_toxic", "rejected", *kept])

    fields = T._parse_datatype_string("severity double, p_toxic double, rejected boolean").fields
    body = docs.select(*[F.col(f"`{c}`") for c in kept])
    return body.mapInArrow(run, T.StructType(fields + [docs.schema[c] for c in kept]))


def toxicity(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, severity, p_toxic, rejected) of every document, learned from labels(doc_id, toxic)."""
    model = train(documents, labels)
    return score(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select("doc_id", "severity", "p_toxic", "rejected")
