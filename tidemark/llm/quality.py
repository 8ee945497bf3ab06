"""Quality of texts by positive-unlabelled learning with the non-negative risk."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.sampling import bounded_sample

#: Trusted positives, and unlabelled texts, the model is fitted on, at most.
TRAINING_ROWS = 12_000
#: Labelled rows of either class that the class prior and the calibration use, at most.
CALIBRATION_ROWS = 6_000
BINS = 12
_SIGNS = "!?#$%&*|<>{}[]()=+^~@\\/_:;\"'.,-0123456789"


def text_features(text: str) -> list[float]:
    """Numbers that describe the make-up of a text, whatever its language or length."""
    words, chars = text.split(), max(1, len(text))
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    bare = [w for w in words if w.isalpha()]
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    return [
        np.log1p(len(words)),
        np.log1p(len(lines)),
        len(counts) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        max(counts.values(), default=0) / n,
        len(set(lines)) / max(1, len(lines)),
        sum(map(str.isupper, words)) / n,
        sum(map(str.istitle, words)) / n,
        len(bare) / n,
        float(lengths.mean()),
        float(lengths.std()),
        sum(1 for w in words if len(w) > 1 and not (w[-1].isalnum() or w[-1] in ".,;:?)\"'")) / n,
        (chars - sum(map(len, words))) / chars,
        *(min(1.0, text.count(s) / chars) for s in _SIGNS),
    ]


@dataclass
class QualityModel:
    """A sum of one weight per feature bin, and the map from it to a probability."""

    edges: list[np.ndarray]
    weights: np.ndarray
    scale: float
    shift: float

    def binned(self, rows: np.ndarray) -> np.ndarray:
        cols = [np.searchsorted(e, rows[:, j], "left") + j * (BINS + 1) for j, e in enumerate(self.edges)]
        return np.stack(cols, 1) if cols else np.zeros((len(rows), 0), int)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.weights[self.binned(rows)].sum(1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(rows) + self.shift, -40, 40)))


def _adam(grad_of, size: int, rounds: int, rate: float) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, rounds + 1):
        g = grad_of(w)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def fit_pu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, known: np.ndarray, labels: np.ndarray,
    rounds: int = 400, decay: float = 1e-3,
) -> QualityModel:
    """Minimise prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]) with the sigmoid loss l.

    When the second part goes below zero its gradient is taken the other way,
    as the non-negative estimator asks. ``known`` rows with ``labels`` calibrate
    the result. Without positives or unlabelled rows the score is the prior.
    """
    columns = np.concatenate([positive, unlabelled]) if len(positive) + len(unlabelled) else np.zeros((0, 0))
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(columns[:, j], cuts)) for j in range(columns.shape[1])]
    model = QualityModel(edges, np.zeros(len(edges) * (BINS + 1)), 1.0, 0.0)
    logit = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    if not len(positive) or not len(unlabelled):
        model.shift = logit
        return model
    p, u, size = model.binned(positive), model.binned(unlabelled), len(model.weights)

    def spread(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.bincount(rows.ravel(), np.repeat(values, rows.shape[1]), size)

    def gradient(w: np.ndarray) -> np.ndarray:
        fp, fu = w[p].sum(1), w[u].sum(1)
        sp, su = 1 / (1 + np.exp(np.clip(fp, -40, 40))), 1 / (1 + np.exp(np.clip(-fu, -40, 40)))
        negative = su.mean() - prior * (1 - sp).mean()
        g = spread(u, su * (1 - su) / len(u)) - prior * spread(p, sp * (1 - sp) / len(p))
        if negative < 0:
            g = -g
        else:
            g = g - prior * spread(p, sp * (1 - sp) / len(p))
        return g + decay * w / len(edges)

    model.weights = _adam(gradient, size, rounds, 0.03)
    if len(known) and labels.min() < labels.max():
        raw = model.raw(known)

        def slope(ab: np.ndarray) -> np.ndarray:
            off = 1 / (1 + np.exp(-np.clip(np.exp(ab[0]) * raw + ab[1], -40, 40))) - labels
            return np.array([(off * raw).mean() * np.exp(ab[0]), off.mean()]) + 1e-3 * np.array([ab[0], 0])

        ab = _adam(slope, 2, 800, 0.05)
        model.scale, model.shift = float(np.exp(ab[0])), float(ab[1])
    else:
        model.shift = logit
    return model


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the CRC-32 of its id as text; its label is never learnt from."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


_FEATURES = "features array<double>"


def _described(docs: DataFrame, keep: list[str], kinds: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
            arrays = [*batch.columns[:-1], pa.array(rows, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "features"])

    return docs.select(*keep, F.col("text").cast("string")).mapInArrow(run, f"{kinds}, {_FEATURES}")


def fit_quality(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> QualityModel:
    """Fit on at most ``bound`` trusted positives and as many texts without a label.

    Labels of held-out documents are dropped before anything else. The class
    prior is the share of positives among the labelled rows that remain. Null
    texts and labels are not learnt from. If every document has a label, all
    texts serve as the unlabelled ones.
    """
    known = labels.where("quality is not null and doc_id is not null")
    known = known.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality"))
    usable = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n, n_good = usable.agg(F.count(F.lit(1)), F.sum("quality")).head()
    prior = (n_good or 0) / n if n else 0.5

    def rows_of(chosen: DataFrame, limit: int):
        got = _described(texts.join(chosen, "doc_id").limit(limit), ["doc_id", "quality"], "doc_id long, quality int").toPandas()
        got = got.sort_values("doc_id", kind="stable")
        x = np.array(got["features"].tolist() or np.zeros((0, len(text_features("")))), float)
        return x, got["quality"].to_numpy(int)

    good, _ = rows_of(bounded_sample(usable.where("quality = 1"), F.col("doc_id"), bound), bound)
    ids = texts.select("doc_id").where("doc_id is not null").distinct()
    free = ids.join(known.select("doc_id"), "doc_id", "left_anti")
    if free.limit(1).count() == 0:
        free = ids
    free = bounded_sample(free, F.col("doc_id"), bound).withColumn("quality", F.lit(0))
    unlabelled, _ = rows_of(free, bound)
    both, marks = rows_of(bounded_sample(usable, F.col("doc_id"), CALIBRATION_ROWS, seed=11), CALIBRATION_ROWS)
    return fit_pu(good, unlabelled, prior, both, marks)


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) for every row of (doc_id, text).

    A null text is scored as empty. A null doc_id stays null and is not held
    out; repeated rows are scored alike; other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([text_features(t or "") for t in batch.column(1).to_pylist()], float)
            scores = model.score(rows.reshape(batch.num_rows, -1)) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
