"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled good; the rest of the training fold is unlabelled web text that
mixes good and bad. With the class prior ``p`` the classifier minimises the non-negative unbiased risk

    p * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - p * E_pos[loss(-f)])

so no text needs to be labelled bad. The prior is estimated from the same two samples: no set of
texts can be more frequent among the positives than ``1 / p`` times its frequency overall, and the
sets of high score come close to that bound.

The model adds up one weight per feature and quantile bin. It is fitted on bounded samples (``fit_rows``
positives and as many unlabelled texts, those with the smallest hash of their id) in the driver;
every text of any size is scored whole, in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>!?{}[]=_~^@+/\\"
FEATURES = 26
BINS = 12


def features(text: str) -> list[float]:
    """What the style of a text says, whatever its words mean; an empty text is all zeros but for its size."""
    found = text.split()
    n, chars = len(found), len(text)
    if not n:
        return [0.0] * FEATURES
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256) / max(1, chars)
    lengths = np.fromiter(map(len, found), np.float64, n)
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    counts = Counter(found)
    top = max(counts.values())
    share = 1.0 / n
    return [
        math.log1p(n),
        lengths.mean(),
        lengths.std(),
        lengths.max(),
        raw[65:91].sum(),
        raw[97:123].sum(),
        raw[48:58].sum(),
        raw[128:].sum(),
        sum(raw[ord(c)] for c in SYMBOLS),
        raw[ord("!")],
        raw[ord("|")],
        sum(raw[ord(c)] for c in "#*$%&"),
        raw[ord(".")],
        raw[ord(",")],
        raw[ord("@")] + raw[ord("/")] + raw[ord(":")],
        sum(map(str.isupper, found)) * share,
        sum(map(str.istitle, found)) * share,
        sum(map(str.isalpha, found)) * share,
        len(counts) / n**0.8,
        top * share,
        sum(map(eq, found, found[1:])) * share,
        1 - len(set(lines)) / max(1, len(lines)),
        len(lines) * share,
        len(set(zip(found, found[1:]))) / max(1, n - 1),
        sum(x == "|" for x in found) * share,
        sum(len(line) < 40 for line in lines) / max(1, len(lines)),
    ]


class Model:
    """``edges``: inner bin edges of each feature; ``weights``: a weight for each feature and bin."""

    def __init__(self, edges: np.ndarray, weights: np.ndarray, prior: float):
        self.edges, self.weights, self.prior = edges, weights, prior

    def places(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([k * BINS + np.searchsorted(e, rows[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def margin(self, rows: np.ndarray) -> np.ndarray:
        return self.weights[self.places(rows)].sum(axis=1) + self.weights[-1]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def _descend(places: list[np.ndarray], slopes, size: int, steps: int = 400, rate: float = 0.05, shrink: float = 2e-3) -> np.ndarray:
    """Adam over the weights; ``slopes`` gives the risk's derivative by each sample's margins."""
    weights, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        margins = [weights[p].sum(axis=1) + weights[-1] for p in places]
        slope = shrink * weights
        for p, s in zip(places, slopes(*margins)):
            slope = slope + np.bincount(p.ravel(), np.repeat(s, p.shape[1]), size)
            slope[-1] += s.sum()
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The smallest ratio of frequencies, unlabelled to positive, over sets of highest scores that
    hold enough positives to be measured (each ratio raised by its sampling error)."""
    best = 1.0
    for kept in np.linspace(0.3, 1.0, 36):
        least = np.quantile(positive, 1 - kept)
        p, u = float(np.mean(positive >= least)), float(np.mean(unlabelled >= least))
        error = math.sqrt(p * (1 - p) / len(positive)) + math.sqrt(max(u * (1 - u), 0) / len(unlabelled))
        best = min(best, (u + error) / p)
    return min(0.99, max(0.05, best))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """Fit on feature rows. Without positives, or without unlabelled texts, every score is 0.5."""
    size = FEATURES * BINS + 1
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros((FEATURES, BINS - 1)), np.zeros(size), 0.5)
    pool = np.concatenate([positive, unlabelled])
    edges = np.quantile(pool, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    model = Model(edges, np.zeros(size), 0.5)
    here = [model.places(positive), model.places(unlabelled)]
    n, m = len(positive), len(unlabelled)

    def apart(pos, unl):  # logistic loss, positives against unlabelled, equal weight
        return -_sigmoid(-pos) / (2 * n), _sigmoid(unl) / (2 * m)

    model.weights = _descend(here, apart, size, steps=200)
    prior = estimate_prior(model.margin(positive), model.margin(unlabelled))

    def risk(pos, unl):  # non-negative risk with the sigmoid loss
        at_pos, at_unl = _sigmoid(pos), _sigmoid(unl)
        bend_pos, bend_unl = at_pos * (1 - at_pos), at_unl * (1 - at_unl)
        negative = at_unl.mean() - prior * at_pos.mean()
        if negative >= 0:
            return -2 * prior * bend_pos / n, bend_unl / m
        return prior * bend_pos / n, -bend_unl / m  # back out of what only fits the sample

    model.weights = _descend(here, risk, size)
    model.prior = prior
    return model


def held_out(id_col: str, folds: int = 3, fold: int = 1):
    """Rows whose labels must not be learnt from; a null id is not among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _measure(batches):
    for batch in batches:
        rows = [features(t.as_py() or "") for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["good", "features"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = 20000) -> Model:
    """Fit on the training fold. A document with several labels is a positive if all of them are 1."""
    order = F.xxhash64("_id", F.lit("fit"))
    fold = docs.select(F.col(id_col).alias("_id")).filter(~held_out("_id") & F.col("_id").isNotNull())
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).filter(~held_out("_id") & F.col("_id").isNotNull())
    trusted = marks.groupBy("_id").agg(F.min("_label").alias("_label")).filter("_label = 1").select("_id")
    chosen = (
        trusted.orderBy(order, "_id").limit(fit_rows).select("_id", F.lit(True).alias("good"))
        .unionByName(fold.orderBy(order, "_id").limit(fit_rows).select("_id", F.lit(False).alias("good")))
    )
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("text"))
    # at most 2 * fit_rows ids
    sample = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("good", "text")
    found = sample.mapInArrow(_measure, "good boolean, features array<double>").toPandas()
    rows = np.array(found["features"].tolist(), dtype=float).reshape(len(found), FEATURES)
    good = found["good"].to_numpy(dtype=bool)
    order = np.lexsort(rows.T)  # the fit does not depend on the order in which tasks end
    rows, good = rows[order], good[order]
    return fit(rows[good], rows[~good])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row.

    Null and empty texts get the score of a text without words; repeated rows are scored each; an
    empty table gives no row; a null id is kept. Further columns are ignored.
    """

    def run(batches):
        for batch in batches:
            rows = np.array([features(t.as_py() or "") for t in batch.column(2)], dtype=float).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(rows))], ["doc_id", "held_out", "score"])

    own = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = dict(own.dtypes)["doc_id"]
    scored = own.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
