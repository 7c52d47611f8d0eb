"""Toxicity classifier from positive and unlabelled texts (non-negative risk estimator).

Inputs are the distinct words of a text (runs of letters, lower case) and the first 4, 5 and 6
letters of longer words, present or not, as 32-bit hashes. Confirmed toxic texts are the positives; the unlabelled
texts are drawn from all texts of the training fold, whatever their label. With the share of
toxic texts `prior` (measured over all labels of the fold) the risk of a linear score g is

    prior * E_pos[l(g)] + max(0, E_unl[l(-g)] - prior * E_pos[l(-g)]),   l(z) = log(1 + exp(-z));

when the second term is negative, its gradient is reversed instead, as the method prescribes.
Inputs that are not clearly more frequent among the positives than among the unlabelled texts
are screened out first, so that rare words of long texts add no noise.

Training runs in one task over bounded samples (`MAX_POSITIVE`, `MAX_UNLABELLED`), one text per id; the model is
a table of at most `MAX_INPUTS` weights. Scoring reads whole texts.

Null and empty texts get the score of a text without any input. Null labels are left out,
several for one id are averaged. Without a positive text every score is 0.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bounded_sample, fold_is, in_small_batches, one_per_id
from stratalake.llm.quality import label_table

STEMS, MAX_INPUTS, LEAST_POSITIVE, LEAST_Z, STEPS, PULL = (4, 5, 6), 4096, 3, 4.0, 400, 2e-4
WORDS_HELD = 300_000
#: Texts used at most for training.
MAX_POSITIVE, MAX_UNLABELLED = 4000, 12_000
LETTERS = re.compile(r"[^\W\d_]+")


def word_inputs(word: str) -> list[int]:
    """The word and its stems; a stem ends in a mark that no word has."""
    stems = [word[:n] + "~" for n in STEMS if len(word) > n]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in (word, *stems)]


def inputs(text: str | None) -> np.ndarray:
    words = set(LETTERS.findall((text or "").lower()))
    return np.array(sorted({x for w in words for x in word_inputs(w)}), np.int64)


class Weights(dict):
    """Word -> its inputs that have a weight; filled while words are met."""

    def __init__(self, bias: float | None, names: np.ndarray, weights: np.ndarray):
        super().__init__()
        self.bias, self.weights = bias, dict(zip(names.tolist(), weights.tolist()))

    def __reduce__(self):
        return Weights, (self.bias, np.array(list(self.weights), np.int64), np.array(list(self.weights.values())))

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(x for x in word_inputs(word) if x in self.weights)
        if len(self) >= WORDS_HELD:
            self.clear()
        self[word] = found
        return found

    def score(self, text: str | None) -> float:
        if self.bias is None:
            return 0.0
        words = set(LETTERS.findall((text or "").lower()))
        present = set().union(*filter(None, map(self.__getitem__, words)))
        total = self.bias + sum(map(self.weights.__getitem__, sorted(present)))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def joined(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and inputs, one after the other."""
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([*rows, np.empty(0, np.int64)])


def screened(positive: np.ndarray, n: int, unlabelled: np.ndarray, m: int) -> np.ndarray:
    """Inputs clearly more frequent among the n positive texts."""
    names, a = np.unique(positive, return_counts=True)
    names, a = names[keep := a >= max(LEAST_POSITIVE, 0.002 * n)], a[keep]
    if not len(names):
        return names
    place = np.minimum(np.searchsorted(names, unlabelled), len(names) - 1)
    b = np.bincount(place[names[place] == unlabelled], minlength=len(names))
    both = (a + b) / (n + m)
    z = (a / n - b / max(m, 1)) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n + 1 / max(m, 1)))
    order = np.lexsort((names, -z))[:MAX_INPUTS]
    return np.sort(names[order[z[order] >= LEAST_Z]])


Side = tuple[np.ndarray, np.ndarray, int]


def risk(theta: np.ndarray, positive: Side, unlabelled: Side, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The two parts of the risk under the logistic loss and their slopes: what positive texts cost as positives,
    and what unlabelled texts cost as negatives less the share of it that is due to positives among them
    (below zero only by overfitting; the risk counts it as zero there).

    `theta` holds the weights, then the bias; a side is (text, input) pairs and its number of texts."""
    k = len(theta) - 1
    pr, pi, n = positive
    ur, ui, m = unlabelled

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def slope(row, index, weight):
        return np.concatenate([np.bincount(index, weight[row], k) if k else np.empty(0), [weight.sum()]])

    gp = theta[k] + np.bincount(pr, theta[pi], n)
    cost = prior * np.logaddexp(0, -gp).mean()
    rise = prior * slope(pr, pi, -sigmoid(-gp) / n)
    negative = -prior * np.logaddexp(0, gp).mean()
    move = -prior * slope(pr, pi, sigmoid(gp) / n)
    if m:
        gu = theta[k] + np.bincount(ur, theta[ui], m)
        negative += np.logaddexp(0, gu).mean()
        move = move + slope(ur, ui, sigmoid(gu) / m)
    return cost, negative, rise, move


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Weights:
    """Full-batch Adam on the non-negative risk."""
    if not positive:
        return Weights(None, np.empty(0, np.int64), np.empty(0))
    prior = min(max(prior, 1e-4), 0.9)
    sides = joined(positive), joined(unlabelled)
    names = screened(sides[0][1], len(positive), sides[1][1], len(unlabelled))

    def chosen(row, x):
        place = np.minimum(np.searchsorted(names, x), max(len(names) - 1, 0))
        keep = names[place] == x if len(names) else np.zeros(len(x), bool)
        return row[keep], place[keep]

    (pr, pi), (ur, ui) = chosen(*sides[0]), chosen(*sides[1])
    n, m, k = len(positive), len(unlabelled), len(names)
    theta = np.zeros(k + 1)
    theta[k] = np.log(prior / (1 - prior))
    first, second = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, STEPS + 1):
        _, negative, rise, move = risk(theta, (pr, pi, n), (ur, ui, m), prior)
        grad = rise + (move if negative >= 0 else -move)
        grad[:k] += PULL * theta[:k]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta -= 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Weights(float(theta[k]), names, theta[:k])


def train(docs: DataFrame, labels: DataFrame, held: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Weights:
    known = label_table(labels, label, held, doc_id)
    share = known.agg(F.avg("label")).first()[0]
    sure = bounded_sample(known.where("label = 1"), F.col("doc_id"), MAX_POSITIVE).select("doc_id")
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    positive = one_per_id(source.join(F.broadcast(sure), "doc_id"), "doc_id", "body").select(F.lit(1).alias("positive"), "body")
    drawn = bounded_sample(docs.where(~held), F.col(doc_id), MAX_UNLABELLED).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    other = one_per_id(drawn, "doc_id", "body").select(F.lit(0).alias("positive"), "body")

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"positive": frame.positive, "inputs": [inputs(t) for t in frame.body]})

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sides = ([], [])
        for frame in frames:
            for side, found in zip(frame.positive, frame.inputs):
                sides[side].append(np.asarray(found, np.int64))
        yield pd.DataFrame({"model": [pickle.dumps(fit(sides[1], sides[0], float(share or 0)))]})

    texts = in_small_batches(positive.unionByName(other)).mapInPandas(rows, "positive int, inputs array<long>")
    found = texts.repartition(1).mapInPandas(learn, "model binary").first()
    return pickle.loads(found.model) if found else fit([], [], 0.0)


def assess(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`."""
    held = fold_is(F.col(doc_id), 3, 1)
    model = train(docs, labels, held, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    source = docs.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"), F.col(text).alias("body"))
    out = in_small_batches(source).mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
