"""Toxicity as ordered grades: cumulative-link (proportional odds) regression on the words of a text.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight per word serves all thresholds. x says which words, and which
beginnings of words, a text holds; they are hashed into a fixed number of features. The result is the expected grade, and
whether the lowest threshold is passed with a probability from which on, by cross-validation, few clean texts lie.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import map_batches, text_or_empty

WORD = re.compile(r"[^\W\d_]+")
FEATURES = 1 << 22
#: Letters of a word's beginnings that count as features of their own.
BEGINNINGS = (4, 5)
#: L1 prices that cross-validation chooses from, and the share of clean texts that its cut leaves alone.
PRICES = (0.2, 0.1, 0.05)
LEFT_ALONE = 0.985


def feature(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode()) % FEATURES


def features_of(word: str) -> list[int]:
    """A word and its beginnings, as words are inflected and compounded."""
    return [feature(word), *(feature(f"^{word[:n]}") for n in BEGINNINGS if len(word) > n)]


def features(text: str) -> list[int]:
    """The distinct features of a text, in ascending order."""
    return sorted({f for w in set(WORD.findall(text.lower())) for f in features_of(w)})


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of the features that have one, and ascending thresholds between the grades."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]
    #: the probability of any grade above 0 from which on a text is toxic
    cut: float = 0.5

    def above(self, score: float) -> list[float]:
        """P(grade > k) for each threshold k."""
        return [float(1 / (1 + np.exp(np.clip(t - score, -500, 500)))) for t in self.thresholds]


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, penalty: float, min_rows: int = 4, steps: int = 200, screen: float = 0.0) -> OrdinalModel:
    """Least penalised negative log-likelihood by proximal gradient steps with a rate per weight.

    ``penalty`` is the L1 price of a weight; features in fewer than ``min_rows`` rows get none, nor do those that rows of
    grade 0 and the others hold alike, to ``screen`` standard deviations. Without rows, or with one grade only, the
    thresholds alone say what is known.
    """
    n = len(rows)
    share = [(np.sum(grades > k) + 0.5) / (n + 2) for k in range(n_grades - 1)]
    base = np.array([-np.log(s / (1 - s)) for s in share])
    base = np.maximum.accumulate(base + 1e-3 * np.arange(len(base)))
    if not n or len(set(grades.tolist())) < 2:
        return OrdinalModel({}, tuple(base.tolist()))
    flat = np.concatenate(rows).astype(np.int32)
    owner = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    count = np.bincount(flat, minlength=FEATURES)
    keep = (count >= min_rows) & (count <= 0.5 * n)
    if screen:
        rate = np.mean(grades > 0)
        with_it = np.bincount(flat[(grades > 0)[owner]], minlength=FEATURES)
        keep &= np.abs(with_it - count * rate) >= screen * np.sqrt(count * rate * (1 - rate))
    chosen = keep[flat]
    names = np.flatnonzero(keep)
    column, owner = (np.cumsum(keep) - 1)[flat[chosen]], owner[chosen]
    del flat, chosen, count, keep
    w = np.zeros(len(names))
    gaps = np.diff(base)
    cut = np.concatenate([base[:1], np.log(np.maximum(gaps, 1e-3))])
    seen_w, seen_cut = np.full(len(w), 1e-8), np.full(len(cut), 1e-8)

    def thresholds(c: np.ndarray) -> np.ndarray:
        return c[0] + np.concatenate([[0.0], np.cumsum(np.exp(c[1:]))])

    for _ in range(steps):
        t = thresholds(cut)
        score = np.bincount(owner, weights=w[column], minlength=n)
        passed = 1 / (1 + np.exp(np.clip(t[None, :] - score[:, None], -500, 500)))
        edge = np.concatenate([np.ones((n, 1)), passed, np.zeros((n, 1))], axis=1)
        slope = edge * (1 - edge)
        at = np.arange(n)
        p = np.maximum(edge[at, grades] - edge[at, grades + 1], 1e-12)
        low, high = slope[at, grades] / p, slope[at, grades + 1] / p
        g_score = (high - low) / n
        g_t = np.zeros(n_grades + 1)
        np.add.at(g_t, grades, low / n)
        np.add.at(g_t, grades + 1, -high / n)
        g_t = g_t[1:-1]
        g_cut = np.concatenate([[g_t.sum()], [g_t[k:].sum() * np.exp(cut[k]) for k in range(1, len(cut))]])
        g_w = np.bincount(column, weights=g_score[owner], minlength=len(w))
        seen_w += g_w**2
        seen_cut += g_cut**2
        rate = 0.5 / np.sqrt(seen_w)
        w = w - rate * g_w
        w = np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
        cut = cut - 0.5 / np.sqrt(seen_cut) * g_cut
    return OrdinalModel({int(names[k]): float(w[k]) for k in np.flatnonzero(w)}, tuple(thresholds(cut).tolist()))


def fit_severity(rows: list[np.ndarray], toxic: np.ndarray, price: float = 0.1) -> OrdinalModel:
    """A model of three grades from labels that only say toxic or not: 0 not, 1 toxic, 2 severe.

    A first fit with two grades picks the words that speak for the label; its L1 price falls with the root of the
    number of rows, as chance does, so words of single mislabelled texts are left out. Toxic texts with more evidence
    than the median one are severe. The ordinal model is then fitted on the picked words.
    """
    toxic = (toxic > 0).astype(np.int64)
    first = fit(rows, toxic, 2, penalty=price / np.sqrt(max(1, len(rows))), screen=2.0)
    picked = np.array(sorted(first.weights), dtype=np.int64)
    rows = [r[np.isin(r, picked)] for r in rows]
    evidence = np.array([sum(first.weights[int(f)] for f in r) for r in rows], dtype=np.float64)
    told = evidence[(toxic == 1) & (evidence > 0)]
    middle = np.median(told) if len(told) else 0.0
    return fit(rows, toxic + ((toxic == 1) & (evidence > middle)), 3, penalty=5e-4, steps=500)


def fit_tuned(rows: list[np.ndarray], toxic: np.ndarray, prices: tuple[float, ...] = PRICES, left_alone: float = LEFT_ALONE) -> OrdinalModel:
    """``fit_severity`` at the price that foretells held-out labels best, with a cut that leaves clean ones alone.

    Each half of the rows is foretold by a model of the other half. The cut is the probability that the share
    ``left_alone`` of the clean rows stays under, one half at most; without clean or toxic rows it is one half.
    """
    toxic = (toxic > 0).astype(np.int64)
    if not 0 < toxic.sum() < len(toxic):
        return fit_severity(rows, toxic)
    half = np.arange(len(rows)) % 2
    best: tuple[float, float, np.ndarray] | None = None
    for price in prices:
        p = np.zeros(len(rows))
        for side in (0, 1):
            model = fit_severity([rows[k] for k in np.flatnonzero(half != side)], toxic[half != side], price)
            for k in np.flatnonzero(half == side):
                p[k] = model.above(sum(model.weights.get(int(f), 0.0) for f in rows[k]))[0]
        loss = -np.mean(np.log(np.maximum(np.where(toxic == 1, p, 1 - p), 1e-6)))
        if best is None or loss < best[0]:
            best = loss, price, p
    _, price, p = best
    cut = float(np.clip(np.quantile(p[toxic == 0], left_alone), 0.05, 0.5))
    return replace(fit_severity(rows, toxic, price), cut=cut)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    toxic_col: str = "toxic",
    max_rows: int = 10_000,
) -> OrdinalModel:
    """Fit on at most ``max_rows`` labelled documents, taken by the hash of their id.

    An id with several labels is toxic if one says so; labels without an id or a value, or of unknown documents, are
    ignored. Only the features of the sampled documents come to the driver.
    """
    clean = labels.select(F.col(id_col).alias("_id"), F.col(toxic_col).cast("int").alias("_toxic")).filter("_id IS NOT NULL AND _toxic IS NOT NULL")
    sample = clean.groupBy("_id").agg(F.max("_toxic").alias("_toxic")).orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    # bounded by max_rows, so it may be sent to every task
    joined = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")).join(F.broadcast(sample), "_id")

    def take(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [np.array(features(t.as_py()), dtype="<i4").tobytes() for t in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())], names=["id", "toxic", "features"])

    id_type = docs.schema[id_col].dataType.simpleString()
    found = map_batches(joined.select("_id", "_text", "_toxic"), take, f"id {id_type}, toxic int, features binary").toArrow()
    found = found.sort_by([("id", "ascending"), ("features", "ascending")])
    rows = [np.frombuffer(f.as_buffer(), dtype="<i4") for f in found["features"]]
    return fit_tuned(rows, found["toxic"].to_numpy().astype(np.int64))


class Scorer:
    """Scores texts with a model; the weights of words already met are kept, up to a bound."""

    def __init__(self, model: OrdinalModel, keep: int = 100_000) -> None:
        self.model, self.keep = model, keep
        self.words: dict[str, tuple[int, ...]] = {}

    def score(self, text: str) -> float:
        words = set(WORD.findall(text.lower()))
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > self.keep:
            self.words, new = {}, list(words)
        weights = self.model.weights
        self.words.update((w, tuple(f for f in features_of(w) if f in weights)) for w in new)
        # a feature counts once, also where several words have it
        held = {f for w in words if self.words[w] for f in self.words[w]}
        return sum(weights[f] for f in sorted(held))


def toxicity(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, severity, p_toxic, toxic``.

    ``severity`` is the expected grade, ``p_toxic`` the probability of any grade above 0; toxic from the model's cut on.

    * Null and empty texts hold no words and are judged by the thresholds alone. Texts may be of any length.
    * Repeated rows and null ids give a row each. Other columns are ignored. An empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    made: list[Scorer] = []

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Scorer(model))
        above = [model.above(made[0].score(t.as_py())) for t in batch.column(1)]
        columns = [
            pa.array([sum(p) for p in above], pa.float64()),
            pa.array([p[0] for p in above], pa.float64()),
            pa.array([p[0] >= model.cut for p in above], pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "severity", "p_toxic", "toxic"])

    schema = f"`{id_col}` {id_type}, severity double, p_toxic double, toxic boolean"
    return map_batches(docs.select(F.col(id_col), text_or_empty(text_col)), judge, schema)


def drop_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """The documents that are not toxic, all columns unchanged. Each row is judged where it is read; none moves.

    Null and empty texts are judged by the thresholds alone; repeated rows each for itself; an empty table stays empty.
    """
    place = docs.columns.index(text_col)
    made: list[Scorer] = []

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Scorer(model))
        keep = [model.above(made[0].score(t.as_py() or ""))[0] < model.cut for t in batch.column(place)]
        return batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, clean, docs.schema)
