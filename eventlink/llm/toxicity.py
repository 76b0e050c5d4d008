"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct words and their leading 4 and 5 letters, hashed to
``DIMS`` places.  The machine adds a weight per term and, for each pair of terms
that occur together, the product of their factor vectors, so that a pair can
weigh more, or less, than its parts.  It is fitted on a bounded sample of
labelled rows (``max_rows``, taken in the order of a hash of the id) from four
of five folds; the terms are those of the sample that differ most between the
classes (chi-square, up to ``TERMS`` of them) and, among these and the most
frequent others, those that tell the classes apart only together with another
term.  Scoring reads every whole text in parallel.

Defined cases: a null or empty text has no term and scores by the bias; rows
with a null id are scored and not held out; a document with several labels
counts as toxic if any says so; repeated rows are each scored and train once;
without any usable label every score is 0; columns other than the named ones
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from .common import take_columns, text_of

DIMS = 1 << 18
MAX_ROWS = 10_000
TERMS = 8192
FACTORS = 8
MIN_CHI = 10.83  # a chance of one in a thousand
LEAST_ROWS = 10
CHANCE = 1e-3
EPOCHS = 30
RATE = 0.1
DECAY = 1e-4
FOLDS = 5
SEED = 7
WORD = re.compile(r"[^\W_]+")
HELD = 200_000


class TermPlaces(dict):
    """Hashed places by word: the word itself and its leading letters.  Emptied
    at its bound."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= HELD:
            self.clear()
        parts = {word} | {f"{word[:k]}*" for k in (4, 5) if len(word) >= k}
        self[word] = places = tuple({xxh32_intdigest(p) % DIMS for p in parts})
        return places


PLACES = TermPlaces()


def terms(text: str) -> list[int]:
    """Distinct places of a text's terms."""
    found: set[int] = set()
    for word in set(WORD.findall(text.lower())):
        found.update(PLACES[word])
    return sorted(found)


class Machine:
    """Bias, weights and factors over a few places; scores by place lists."""

    def __init__(self, places: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors
        self.row = {int(p): i for i, p in enumerate(places)}

    def score(self, found: list[int]) -> float:
        rows = [self.row[p] for p in found if p in self.row]
        z = self.bias
        if rows:
            v = self.factors[rows]
            z += self.weights[rows].sum() + 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def chosen(lists: list[np.ndarray], y: np.ndarray, most: int) -> np.ndarray:
    """The places whose presence differs most between the classes, and then those
    that matter in a pair among them and the most frequent others."""
    have = [np.bincount(np.concatenate([x for x, t in zip(lists, y) if t == c] or [np.empty(0, np.int64)]),
                        minlength=DIMS).astype(float) for c in (0, 1)]
    n0, n1 = float((y == 0).sum()), float((y == 1).sum())
    total, n = have[0] + have[1], n0 + n1
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = np.nan_to_num((have[1] * n - total * n1) ** 2 * n / (total * (n - total) * n0 * n1))
    chi[total < 3] = 0
    best = np.argsort(-chi, kind="stable")[:most]
    best = best[chi[best] > MIN_CHI]
    total[best] = 0
    rest = np.argsort(-total, kind="stable")[:most - len(best)]
    pool = np.concatenate([best, rest[total[rest] >= 2 * LEAST_ROWS]])
    found = paired(lists, y, pool)
    return np.concatenate([best, found[~np.isin(found, best)]])


def paired(lists: list[np.ndarray], y: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The places that matter in a pair: the share of toxic rows with both differs
    from what the shares with either and with none add up to.  Each of the four
    cases needs ``LEAST_ROWS``; the bound holds for all pairs together."""
    n, k = len(y), len(places)
    if not k:
        return places
    at = np.full(DIMS, -1, np.int32)
    at[places] = np.arange(k)
    rows = [(r := at[x])[r >= 0] for x in lists]
    sizes = np.array([len(r) for r in rows])
    flat, doc = np.concatenate(rows), np.repeat(np.arange(n, dtype=np.int32), sizes)
    have, toxic = np.bincount(flat, minlength=k), np.bincount(flat, y[doc], k)
    holders = np.split(doc[np.argsort(flat, kind="stable")], np.cumsum(have)[:-1])

    def beside(some: np.ndarray) -> np.ndarray:
        found = np.zeros(k, np.int64)
        for lo in range(0, len(some), 500):
            found += np.bincount(np.concatenate([rows[i] for i in some[lo:lo + 500]]), minlength=k)
        return found

    noise = y.mean() * (1 - y.mean())
    strength = np.zeros(k)
    for a in range(k):
        held = holders[a]
        bad = beside(held[y[held] == 1])
        both = bad + beside(held[y[held] == 0])
        counts = np.stack([both, have[a] - both, have - both, n - have[a] - have + both])
        rate = (np.stack([bad, toxic[a] - bad, toxic - bad, y.sum() - toxic[a] - toxic + bad]) + 0.5) / (counts + 1)
        spread = (np.maximum(rate * (1 - rate), noise) / (counts + 1)).sum(axis=0)
        z = np.abs(rate[0] - rate[1] - rate[2] + rate[3]) / np.sqrt(spread)
        strength[a] = z[counts.min(axis=0) >= LEAST_ROWS].max(initial=0)
    order = np.argsort(-strength, kind="stable")
    return places[order[strength[order] > NormalDist().inv_cdf(1 - CHANCE / k ** 2)]]


def fit(lists: list[np.ndarray], y: np.ndarray, most: int = TERMS, factors: int = FACTORS, epochs: int = EPOCHS) -> Machine:
    """Logistic loss, Adagrad over batches, weight decay; the same for the same rows."""
    places = chosen(lists, y, most)
    at = np.full(DIMS, -1)
    at[places] = np.arange(len(places))
    rows = [(r := at[x])[r >= 0] for x in lists]
    rng = np.random.default_rng(SEED)
    w, v = np.zeros(len(places)), rng.normal(0, 0.01, (len(places), factors))
    bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    gw, gv, gb = np.full(len(places), 1e-6), np.full(v.shape, 1e-6), 1e-6
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
            ids = np.concatenate([rows[i] for i in batch])
            doc = np.repeat(np.arange(len(batch)), [len(rows[i]) for i in batch])
            used, inverse = np.unique(ids, return_inverse=True)
            sums = np.stack([np.bincount(doc, v[ids, f], len(batch)) for f in range(factors)], axis=1)
            squares = np.bincount(doc, (v[ids] ** 2).sum(axis=1), len(batch))
            z = bias + np.bincount(doc, w[ids], len(batch)) + 0.5 * ((sums ** 2).sum(axis=1) - squares)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) / len(batch)
            step_w = np.bincount(inverse, err[doc], len(used)) + DECAY * w[used]
            pulls = err[doc][:, None] * (sums[doc] - v[ids])
            step_v = np.stack([np.bincount(inverse, pulls[:, f], len(used)) for f in range(factors)], axis=1) + DECAY * v[used]
            step_b = err.sum()
            gw[used] += step_w ** 2
            gv[used] += step_v ** 2
            gb += step_b ** 2
            w[used] -= RATE * step_w / np.sqrt(gw[used])
            v[used] -= RATE * 0.3 * step_v / np.sqrt(gv[used])
            bias -= RATE * step_b / np.sqrt(gb)
    return Machine(places, bias, w, v)


def _fold(doc_id: str):
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Machine | None:
    """Fit on at most ``max_rows`` labelled documents outside fold 0.  ``docs``:
    doc_id, text; ``labels``: doc_id, toxic."""
    usable = labels.where(F.col("toxic").isin(0, 1) & (_fold("doc_id") != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    picked = docs.join(F.broadcast(some), "doc_id")  # max_rows ids and labels

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "terms": [terms(x) for x in b["text"]]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = picked.mapInPandas(run, f"doc_id {kind}, toxic int, terms array<int>")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("terms").alias("terms")).orderBy("doc_id").collect()
    y = np.array([r["toxic"] for r in rows])
    if not len(y) or y.min() == y.max():
        return None
    return fit([np.array(r["terms"], np.int64) for r in rows], y)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_id_col: str = "doc_id", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted per row."""
    own = take_columns(docs, doc_id=id_col, text=text_col).select("doc_id", text_of("text").alias("text"))
    known = take_columns(labels, doc_id=label_id_col, toxic=label_col).withColumn("toxic", F.col("toxic").cast("int"))
    machine = train(own, known, max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # TERMS places at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        active = Active(model) if model else None
        for b in batches:
            scores = [model.score(active.places(x)) if model else 0.0 for x in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": scores})

    kind = own.schema["doc_id"].dataType.simpleString()
    scored = own.mapInPandas(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(_fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


class Active(dict):
    """The model's places by word, empty for most words.  Emptied at its bound."""

    def __init__(self, model: Machine):
        super().__init__()
        self.known = model.row

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= HELD:
            self.clear()
        parts = {word} | {f"{word[:k]}*" for k in (4, 5) if len(word) >= k}
        self[word] = found = tuple(p for p in {xxh32_intdigest(x) % DIMS for x in parts} if p in self.known)
        return found

    def places(self, text: str) -> list[int]:
        found: set[int] = set()
        for word in set(WORD.findall(text.lower())):
            if hit := self[word]:
                found.update(hit)
        return sorted(found)
