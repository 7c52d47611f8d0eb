"""Language identification with hyperdimensional profiles.

Every letter gets a random vector of +1 and -1. A trigram is its three letter vectors, the
earlier ones shifted (permuted) once per place, multiplied element by element; a text is the
sum of its trigram vectors, a language the sum over its training texts. A text belongs to the
language whose vector has the largest cosine with its own.

Letters are Unicode letters in lower case; anything else counts as one gap between words. The
letter vectors follow from the code point and a fixed seed, so every task draws the same ones.

Null texts and texts without a letter are `und` with score 0; without a training text all are.
Ties go to the language that sorts first. Only id, text and language columns are read.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bounded_per_group, fold_is, in_small_batches

DIMENSIONS, SEED, GRAMS_HELD, UNKNOWN = 1024, 20, 40_000, "und"
#: Training texts of each language used at most (drawn by a hash of the id), so a rare language keeps all of its own.
MAX_TRAIN = 5_000


@lru_cache(1)
def letter_codes() -> np.ndarray:
    """Code point of the letter, 0 for anything else."""
    codes = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    codes[[cp for cp in range(sys.maxunicode + 1) if unicodedata.category(chr(cp))[0] != "L"]] = 0
    return codes


@lru_cache(1 << 16)
def letter(code: int) -> np.ndarray:
    return np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, dtype=np.int8) * np.int8(2) - np.int8(1)


class Bundler:
    """Vectors of trigrams, kept while there is room."""

    def __init__(self):
        self.places: dict[int, int] = {}
        self.vectors = np.empty((0, DIMENSIONS), np.int8)

    def rows(self, grams: list[int]) -> np.ndarray:
        new = [g for g in grams if g not in self.places]
        if new:
            if len(self.places) + len(new) > GRAMS_HELD:
                self.places, self.vectors, new = {}, np.empty((0, DIMENSIONS), np.int8), grams
            if len(self.places) + len(new) > len(self.vectors):
                room = np.empty((2 * (len(self.places) + len(new)), DIMENSIONS), np.int8)
                room[: len(self.vectors)] = self.vectors
                self.vectors = room
            for g in new:
                a, b, c = g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF
                self.vectors[len(self.places)] = np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
                self.places[g] = len(self.places)
        return np.fromiter(map(self.places.__getitem__, grams), np.int64, len(grams))

    def encode(self, text: str | None) -> np.ndarray | None:
        """The text's vector; None without a letter. Long texts are counted in blocks."""
        if not text:
            return None
        total, letters = np.zeros(DIMENSIONS, np.float32), False
        for at in range(0, len(text), 1 << 20):
            part = text[max(0, at - 2) : at + (1 << 20)].lower()
            codes = letter_codes()[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
            codes = np.concatenate([[0], codes, [0]])
            codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]  # one gap between words
            if not codes.any():
                continue
            letters = True
            grams, counts = np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)
            for i in range(0, len(grams), 4096):
                rows = self.rows(grams[i : i + 4096].tolist())
                total += counts[i : i + 4096].astype(np.float32) @ self.vectors[rows].astype(np.float32)
        return total if letters else None


@lru_cache(1)
def bundler() -> Bundler:
    return Bundler()


def profiles(training: DataFrame, lang: str, text: str) -> dict[str, np.ndarray]:
    """The sum of the text vectors of each language: one vector per task and language is added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (vector := bundler().encode(body)) is not None:
                    sums[name] = sums.get(name, 0) + vector.astype(np.float64) / np.linalg.norm(vector)
        names = [n for n in sums for _ in range(DIMENSIONS)]
        places = np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(sums))
        values = np.concatenate([*sums.values(), np.empty(0)])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(places), pa.array(values)], ["lang", "place", "value"])

    parts = in_small_batches(training).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("body")).mapInArrow(run, "lang string, place int, value double")
    # Rounded, so that the order in which partial sums arrive does not show.
    rows = parts.groupBy("lang", "place").agg(F.round(F.sum("value"), 6).alias("value")).collect()  # languages x dimensions
    out: dict[str, np.ndarray] = {}
    for r in rows:
        out.setdefault(r.lang, np.zeros(DIMENSIONS))[r.place] = r.value
    return out


def predict(docs: DataFrame, models: dict[str, np.ndarray], doc_id: str, text: str) -> DataFrame:
    """(doc_id, held_out, lang_pred, score)."""
    names = sorted(models)
    matrix = np.stack([models[n] / np.linalg.norm(models[n]) for n in names]).astype(np.float32) if names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for i in range(batch.num_rows):
                vector = bundler().encode(batch.column(2)[i].as_py()) if names else None
                if vector is None or not (size := np.linalg.norm(vector)):
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosine = matrix @ vector / size
                best = int(np.argmax(cosine))
                found.append(names[best])
                scores.append(float(np.clip(cosine[best], 0, 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"]
            )

    source = docs.select(F.col(doc_id).alias("doc_id"), fold_is(F.col(doc_id), 5, 0).alias("held_out"), F.col(text).alias("body"))
    return in_small_batches(source).mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MAX_TRAIN) -> DataFrame:
    """Learn from the rows that are not held out and have a language, predict all rows."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~fold_is(F.col(doc_id), 5, 0))
    training = bounded_per_group(known, F.col(lang).cast("string"), F.col(doc_id), most)
    return predict(docs, profiles(training, lang, text), doc_id, text)
