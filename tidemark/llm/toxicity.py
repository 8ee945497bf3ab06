"""Severity of toxicity by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.sampling import bounded_sample

#: Labelled documents the model is fitted on, at most.
TRAINING_ROWS = 8_000
#: Grades 0 (none) to 3.
GRADES = 4
#: A feature must occur in so many distinct training texts, and among the toxic ones by so many standard
#: deviations more (or less) often than among all: most words of a web corpus only add noise.
LEAST_DOCS = 5
LEAST_Z = 5.0
#: Length of the word beginnings that are features beside whole words.
STEM = 5
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    """Distinct lower-cased words and the beginnings of longer ones (marked by a trailing star)."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:STEM] + "*" for w in words if len(w) >= STEM}


@dataclass
class OrdinalModel:
    """P(grade <= k) = sigmoid(cuts[k] - score): one weight per feature, shared by all thresholds."""

    weights: dict[str, float]
    cuts: list[float]
    threshold: float

    def score(self, text: str) -> float:
        weight = self.weights
        return sum(weight[f] for f in features(text) & weight.keys())

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """Probability of each grade, one row per score."""
        below = 1 / (1 + np.exp(np.clip(scores[:, None] - np.array(self.cuts)[None, :], -50, 50)))
        return np.diff(np.concatenate([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))], 1), axis=1)


def weak_grades(rows: np.ndarray, cols: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grades for rows labelled only toxic or not: the toxic ones are graded by how many marked features they hold.

    A marked feature occurs in toxic rows far more often than in others. The
    cuts are the thirds of the toxic rows.
    """
    if not toxic.any():
        return np.zeros(len(toxic), int)
    size = int(cols.max(initial=-1)) + 1
    in_toxic = np.bincount(cols, toxic[rows], size)
    in_clean = np.bincount(cols, 1 - toxic[rows], size)
    odds = (len(toxic) - toxic.sum() + 1) / (toxic.sum() + 1)
    marked = (in_toxic >= LEAST_DOCS) & (in_toxic * odds > 12 * (in_clean + 0.5))
    hits = np.bincount(rows, marked[cols], len(toxic))
    cuts = np.quantile(hits[toxic == 1], [1 / 3, 2 / 3])
    return np.where(toxic == 1, 1 + (hits[:, None] > cuts[None, :]).sum(1), 0)


def fit_ordinal(texts: list[str], toxic: np.ndarray, rounds: int = 250, decay: float = 2e-4) -> OrdinalModel:
    """Fit by Adam on the mean log loss; every fourth row is kept out to choose the threshold.

    With rows of one class only, the model says that class for all.
    """
    if not len(texts) or toxic.min() == toxic.max():
        always = bool(len(texts)) and bool(toxic.max())
        return OrdinalModel({}, [-30.0 if always else 30.0] * (GRADES - 1), 0.5)
    number: dict[str, int] = {}
    held = np.arange(len(texts)) % 4 == 3
    index = [np.fromiter((number.setdefault(f, len(number)) for f in features(t)), "i4") for t in texts]
    rows, cols = np.repeat(np.arange(len(texts)), [len(i) for i in index]), np.concatenate(index)
    grade = weak_grades(rows, cols, toxic)
    first = {hash(t): i for i, t in reversed(list(enumerate(texts))) if not held[i]}  # copies of a text count once
    telling = _telling(rows, cols, toxic, np.array(sorted(first.values())))
    names = [f for f, i in number.items() if telling[i]]
    del number
    keep = telling[cols]
    rows, cols = rows[keep], (np.cumsum(telling) - 1)[cols[keep]]
    use = ~held[rows]
    train_rows, train_cols = rows[use], cols[use]

    w, theta = np.zeros(len(names)), np.array([1.0, 2.0, 3.0])
    moments = [np.zeros_like(p) for p in (w, w, theta, theta)]
    mine = np.flatnonzero(~held)
    y = grade[mine]
    balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    for step in range(1, rounds + 1):
        score = np.bincount(train_rows, w[train_cols], len(texts))[mine]
        z = np.clip(theta[None, :] - score[:, None], -30, 30)
        s = np.concatenate([np.zeros((len(y), 1)), 1 / (1 + np.exp(-z)), np.ones((len(y), 1))], 1)
        slope = s * (1 - s)
        at = np.arange(len(y))
        p = np.maximum(s[at, y + 1] - s[at, y], 1e-9)
        up, down = balance * slope[at, y + 1] / p, balance * slope[at, y] / p
        whole = np.zeros(len(texts))
        whole[mine] = up - down  # the loss falls as the cut above rises and the cut below sinks
        grad_w = np.bincount(train_cols, whole[train_rows], len(names)) + decay * w
        grad_t = np.zeros(GRADES - 1)
        np.add.at(grad_t, np.minimum(y, GRADES - 2), np.where(y < GRADES - 1, -up, 0))
        np.add.at(grad_t, np.maximum(y - 1, 0), np.where(y > 0, down, 0))
        for at_, (param, grad) in enumerate(((w, grad_w), (theta, grad_t))):
            m, v = moments[2 * at_], moments[2 * at_ + 1]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            param -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
        theta = np.maximum.accumulate(theta + np.arange(GRADES - 1) * 1e-6)
    weights = {f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 1e-3}
    model = OrdinalModel(weights, theta.tolist(), 0.5)
    model.threshold = _threshold(model, np.bincount(rows, w[cols], len(texts)), toxic, held)
    return model


def _telling(rows: np.ndarray, cols: np.ndarray, toxic: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Which features lean to one class among the ``distinct`` rows."""
    chosen = np.zeros(len(toxic), bool)
    chosen[distinct] = True
    use, size = chosen[rows], int(cols.max(initial=-1)) + 1
    n, k = np.bincount(cols[use], minlength=size), np.bincount(cols[use], toxic[rows[use]], size)
    rate = toxic[distinct].mean() if len(distinct) else 0.0
    spread = max(rate * (1 - rate), 1e-9)
    return (n >= LEAST_DOCS) & (np.abs(k - n * rate) >= LEAST_Z * np.sqrt(n * spread))


def _threshold(model: OrdinalModel, scores: np.ndarray, toxic: np.ndarray, held: np.ndarray) -> float:
    """The probability of any grade above 0 that separates the held-out rows best, in the middle of its gap."""
    risk, truth = 1 - model.grades(scores[held])[:, 0], toxic[held]
    if not len(risk) or truth.min() == truth.max():
        return 0.5
    order = np.argsort(-risk)
    hits = np.cumsum(truth[order])
    measure = 2 * hits / (np.arange(1, len(order) + 1) + truth.sum())
    best = int(np.argmax(measure))
    after = risk[order[best + 1]] if best + 1 < len(order) else 0.0
    return float(min(0.95, max(0.05, (risk[order[best]] + after) / 2)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> OrdinalModel:
    """Fit on at most ``bound`` labelled rows of (doc_id, text) and (doc_id, toxic).

    Rows without id, text or label are not learnt from; of repeated labels all
    count.
    """
    marked = labels.where("toxic is not null").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    chosen = bounded_sample(marked, F.col("doc_id"), bound)
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    got = texts.join(F.broadcast(chosen), "doc_id").orderBy("doc_id", F.xxhash64("text")).limit(bound).toPandas()
    return fit_ordinal(got["text"].tolist(), got["toxic"].to_numpy(int))


SCORES = "expected_severity double, severity int, toxic boolean, risk double"


def score_toxicity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """All columns of docs with expected_severity (0 to 3), severity (likeliest grade), toxic (boolean) and risk.

    A null or empty text has no features and is as severe as the cuts alone say,
    which is clean for any model fitted on both classes. Columns of these names
    in ``docs`` are replaced; repeated rows are scored alike. Only texts go to
    Python and only scores come back.
    """

    @F.arrow_udf(f"struct<{SCORES.replace(' ', ':').replace(',:', ',')}>")
    def judged(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            scores = np.fromiter((model.score(t.as_py() or "") for t in batch), float, len(batch))
            p = model.grades(scores)
            columns = [p @ np.arange(GRADES), p.argmax(1).astype("i4"), 1 - p[:, 0] >= model.threshold, 1 - p[:, 0]]
            yield pa.StructArray.from_arrays([pa.array(c) for c in columns], [part.split()[0] for part in SCORES.split(", ")])

    made = [part.split()[0] for part in SCORES.split(", ")]
    kept = ["`" + c.replace("`", "``") + "`" for c in docs.columns if c.lower() not in made]
    return docs.select(*kept, judged(F.col("text").cast("string")).alias("_scores")).select(
        *kept, *(F.col(f"_scores.{m}") for m in made)
    )
