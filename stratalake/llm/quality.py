"""Quality classifier: a factorisation machine.

Inputs of a text: its words, hashed, with damped counts scaled to length one; structure
statistics (lengths, shares of capitals, digits, symbols and repeated words, lines ...), each as
a scaled number and as one of some bins cut at quantiles of the training texts; metadata
columns, treated like the statistics. The score is the logistic function of

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ],

which is the sum over all pairs of <v_i, v_j> x_i x_j in time linear in the inputs.

Training runs in one task over a bounded sample of labelled texts (`MAX_TRAIN`, drawn by a hash
of the id, one text per id); the sampled labels are what is joined with the documents. The model has a fixed
size, whatever the corpus.

Null texts count as empty, null metadata as 0. Labels that are null are left out, several for
one id are averaged (1 from one half on). Without both labels in training, every text gets the
share of label 1 (0.5 without any). Whole texts are read. Repeated rows get the same score.
"""

from __future__ import annotations

import sys
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bounded_sample, fold_is, in_small_batches, one_per_id

BUCKETS, FACTORS, BINS, EPOCHS, BATCH, SEED = 1 << 14, 6, 12, 8, 64, 7
#: Few texts are gone over more often, up to so many row visits or epochs.
VISITS, MOST_EPOCHS = 24_000, 60
#: Labelled texts used at most.
MAX_TRAIN = 6000
UPPER, LOWER, DIGIT, BLANK, PLAIN, SYMBOL = range(6)


@lru_cache(1)
def kinds() -> np.ndarray:
    """Kind of every code point."""
    out = np.full(sys.maxunicode + 1, SYMBOL, np.uint8)
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind[0] in "LN":
            out[cp] = UPPER if kind == "Lu" else LOWER if kind[0] == "L" else DIGIT
        elif c.isspace():
            out[cp] = BLANK
        elif c in ".,;:'\"-()":
            out[cp] = PLAIN
    return out


def kind_counts(text: str) -> np.ndarray:
    total = np.zeros(SYMBOL + 1, np.int64)
    for at in range(0, len(text), 1 << 20):
        codes = np.frombuffer(text[at : at + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)
        total += np.bincount(kinds()[codes], minlength=SYMBOL + 1)
    return total


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    chars, n = max(1, len(text)), max(1, len(words))
    share = kind_counts(text) / chars
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        float(lengths.mean()),
        share[UPPER],
        share[DIGIT],
        share[SYMBOL],
        share[BLANK],
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        sum(len(x) < 40 for x in lines) / m,
        np.log1p(len(lines)),
        1 - len(set(lines)) / m,
        min(200.0, len(words) / m),
        float(lengths.std()),
        sum(1 for w in words if not (w[-1].isalnum() or w[-1] in ".,;:'\"-)")) / n,
        sum(map(str.istitle, words)) / n,
    ]


def features(text: str | None, meta: list) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Hashed word indexes and values, and the dense inputs."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    lowered: dict[int, int] = {}
    for w, c in counts.items():
        i = zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % BUCKETS
        lowered[i] = lowered.get(i, 0) + c
    index = np.fromiter(lowered.keys(), np.int32, len(lowered))
    value = np.log1p(np.fromiter(lowered.values(), np.float64, len(lowered)))
    value /= max(1e-9, float(np.sqrt((value**2).sum())))
    dense = statistics(text, words, counts) + [float(np.sign(m) * np.log1p(abs(m))) if m is not None and m == m else 0.0 for m in meta]
    return index, value.astype(np.float32), dense


class Machine:
    """A trained factorisation machine; `scores` takes texts and metadata."""

    def __init__(self, mean, scale, edges, w0, w, v, constant=None):
        self.mean, self.scale, self.edges, self.w0, self.w, self.v, self.constant = mean, scale, edges, w0, w, v, constant

    def dense(self, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and value rows for dense inputs: numbers, then bins."""
        k = dense.shape[1]
        z = np.clip((dense - self.mean) / self.scale, -4, 4)
        bins = np.stack([np.searchsorted(self.edges[j], dense[:, j]) for j in range(k)], axis=1)
        index = np.concatenate([np.tile(BUCKETS + np.arange(k), (len(dense), 1)), BUCKETS + k + np.arange(k) * BINS + bins], axis=1)
        return index, np.concatenate([z / 4, np.full(bins.shape, 0.5)], axis=1)

    def rows(self, words: list, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All inputs of a batch: row number, index, value."""
        di, dv = self.dense(dense)
        sizes = [len(i) for i, _ in words]
        row = np.concatenate([np.repeat(np.arange(len(words)), sizes), np.repeat(np.arange(len(words)), di.shape[1])])
        index = np.concatenate([*[i for i, _ in words], di.reshape(-1)]).astype(np.int64)
        return row, index, np.concatenate([*[v for _, v in words], dv.reshape(-1)])

    def raw(self, row, index, value, n):
        """Scores before the logistic function, and the factor sums."""
        linear = np.bincount(row, self.w[index] * value, n)
        sums = np.stack([np.bincount(row, self.v[index, f] * value, n) for f in range(FACTORS)], axis=1)
        squares = np.bincount(row, (self.v[index] ** 2).sum(axis=1) * value**2, n)
        return self.w0 + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def scores(self, texts: list, meta: list[list]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        found = [features(t, m) for t, m in zip(texts, meta)]
        if not found:
            return np.empty(0)
        raw, _ = self.raw(*self.rows([f[:2] for f in found], np.array([f[2] for f in found])), len(found))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(words: list, dense: np.ndarray, label: np.ndarray) -> Machine:
    """Logistic loss, AdaGrad over small batches, weights pulled towards zero."""
    if len(set(label.tolist())) < 2:
        return Machine(None, None, None, None, None, None, float(label.mean()) if len(label) else 0.5)
    order = np.lexsort([*dense.T, label])  # whatever order the rows came in
    words, dense, label = [words[i] for i in order], dense[order], label[order]
    rng, k = np.random.default_rng(SEED), dense.shape[1]
    edges = [np.quantile(dense[:, j], np.arange(1, BINS) / BINS) for j in range(k)]
    size = BUCKETS + k + k * BINS
    m = Machine(dense.mean(axis=0), dense.std(axis=0) + 1e-6, edges, 0.0, np.zeros(size), rng.normal(0, 0.02, (size, FACTORS)))
    rate = label.mean()
    m.w0 = float(np.log(rate / (1 - rate)))
    gw, gv, g0 = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2), 1e-2
    for _ in range(min(MOST_EPOCHS, max(EPOCHS, VISITS // len(label)))):
        shuffled = rng.permutation(len(label))
        for at in range(0, len(label), BATCH):
            pick = shuffled[at : at + BATCH]
            row, index, value = m.rows([words[i] for i in pick], dense[pick])
            raw, sums = m.raw(row, index, value, len(pick))
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[pick]) / len(pick)
            used, place = np.unique(index, return_inverse=True)
            slope = error[row] * value
            dw = np.bincount(place, slope, len(used)) + 1e-4 * m.w[used]
            dv = np.empty((len(used), FACTORS))
            for f in range(FACTORS):
                dv[:, f] = np.bincount(place, slope * (sums[row, f] - m.v[index, f] * value), len(used))
            dv += 1e-4 * m.v[used]
            gw[used] += dw**2
            gv[used] += dv**2
            g0 += error.sum() ** 2
            m.w[used] -= 0.1 * dw / np.sqrt(gw[used])
            m.v[used] -= 0.05 * dv / np.sqrt(gv[used])
            m.w0 -= 0.1 * error.sum() / np.sqrt(g0)
    m.w, m.v = m.w.astype(np.float32), m.v.astype(np.float32)
    return m


def label_table(labels: DataFrame, label: str, held: Column, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label 0 or 1) of the rows that may be learned from."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held)
    return known.groupBy(F.col(doc_id).alias("doc_id")).agg((F.avg(label) >= 0.5).cast("int").alias("label"))


def train(docs: DataFrame, labels: DataFrame, label: str, held: Column, meta: tuple[str, ...], doc_id: str, text: str, most: int = MAX_TRAIN) -> Machine:
    """Learn from about `most` labelled texts at most that are not `held` (an expression over the id), one text per id."""
    import pickle

    sample = bounded_sample(label_table(labels, label, held, doc_id), F.col("doc_id"), most)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"), F.array(*[F.col(c).cast("double") for c in meta]).alias("meta"))
    texts = one_per_id(source.join(F.broadcast(sample), "doc_id"), "doc_id", "body")  # the sample: about `most` rows of two numbers

    def inputs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [features(t, list(m)) for t, m in zip(frame.body, frame.meta)]
            yield pd.DataFrame({"label": frame.label, "index": [f[0] for f in found], "value": [f[1] for f in found], "dense": [f[2] for f in found]})

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, dense, label = [], [], []
        for frame in frames:
            words += list(zip(frame["index"], frame["value"]))
            dense += list(frame["dense"])
            label += list(frame["label"])
        model = fit(words, np.array(dense, np.float64).reshape(len(dense), -1 if dense else 0), np.array(label, np.float64))
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    shape = "label int, index array<int>, value array<float>, dense array<double>"
    found = in_small_batches(texts.select("body", "meta", "label")).mapInPandas(inputs, shape).repartition(1).mapInPandas(learn, "model binary").first()
    return pickle.loads(found.model) if found else fit([], np.empty((0, 0)), np.empty(0))


def score(docs: DataFrame, model: Machine, meta: tuple[str, ...], keep: list[Column], text: str) -> DataFrame:
    """The `keep` columns and the score of every row."""
    names = [f"k{i}" for i in range(len(keep))]
    kept = docs.select(*[c.alias(n) for c, n in zip(keep, names)])
    source = docs.select(
        *[c.alias(n) for c, n in zip(keep, names)], F.array(*[F.col(c).cast("double") for c in meta]).alias("meta"), F.col(text).alias("body")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = model.scores(part.column("body").to_pylist(), part.column("meta").to_pylist())
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(scores, pa.float64())], [*names, "score"])

    shape = ", ".join([*[f"{n} {t}" for n, t in kept.dtypes], "score double"])
    return in_small_batches(source).mapInArrow(run, shape)


def assess(docs: DataFrame, labels: DataFrame, meta: tuple[str, ...] = ("n_chars",), doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`."""
    held = fold_is(F.col(doc_id), 5, 0)
    model = train(docs, labels, "quality", held, meta, doc_id, text)
    found = score(docs, model, meta, [F.col(doc_id), held], text)
    found = found.select(F.col("k0").alias("doc_id"), F.col("k1").alias("held_out"), "score")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
