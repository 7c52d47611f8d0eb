"""Periodic runs of words, by an online sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q (words q apart are the same) that
is at least `LEAST_WORDS` words and `LEAST_PERIODS` periods long and that no neighbouring word
extends. In the table of all pairs of words such a stretch is a diagonal of matches at lag q, at
least 3 q long.

The words are read in order, one octave of lags [s, 2 s) at a time. A word's earlier occurrences
at these lags add one to the match lengths of their diagonals; a diagonal without a match ends,
and if it was long enough its run is emitted. Two facts keep this sparse, and exact:

* A diagonal that counts is at least 3 s long, so it passes three neighbouring multiples of s. Only
  words at such places look up their earlier occurrences, so an octave has at most as many
  matches as there are words, however often a word is repeated. What lies between two matches
  of a diagonal is looked at only where both are there.
* A match whose two words lie in one known run of period p, with p a divisor of the lag, belongs
  to no run of its own (a stretch with period q that has period p | q over q words has it
  everywhere). Octaves go up, so these runs are known by then, and the match starts nothing.

Null texts have no words and no runs, as have empty and blank ones. Rows are independent:
repeated rows give equal results, null ids stay, an empty table gives no rows, and other columns
are not read. A text is held whole by its task; all else is proportional to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import in_small_batches

LEAST_WORDS, LEAST_PERIODS = 6, 4
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def runs_of(ids: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in a sequence of word numbers.

    The sequence holds several texts: text k is ids[bounds[k] : bounds[k + 1]]; no run crosses."""
    found: list[tuple[int, int, int]] = []
    n = len(ids)
    if not n:
        return found
    sizes = np.diff(bounds)
    # Occurrences of every word in order: one sorted list for all words.
    keys = np.sort(ids.astype(np.int64) * n + np.arange(n))
    octave = 1
    while LEAST_PERIODS * octave <= sizes.max():
        found += _octave(ids, bounds, keys, octave, found)
        octave *= 2
    return found


def _octave(ids: np.ndarray, bounds: np.ndarray, keys: np.ndarray, s: int, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs with a period from s up to 2 s."""
    n = len(ids)
    places = np.arange(0, n, s)
    text = np.searchsorted(bounds, places, "right") - 1
    first = bounds[text]
    wide = (bounds[text + 1] - first >= LEAST_PERIODS * s) & (places - first >= s)
    steps, at, first = np.flatnonzero(wide), places[wide], first[wide]
    # Earlier occurrences of the word at each place, at the lags of the octave.
    base = ids[at].astype(np.int64) * n
    low = np.searchsorted(keys, base + np.maximum(at - 2 * s + 1, first))
    counts = np.searchsorted(keys, base + at - s, "right") - low
    total = int(counts.sum())
    if not total:
        return []
    owner = np.repeat(np.arange(len(at)), counts)
    earlier = keys[np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(total)] % n
    step, lag = steps[owner], at[owner] - earlier
    if known:
        new = ~_explained(step, lag, earlier, s, len(places), known)
        step, lag = step[new], lag[new]
    # Diagonals: matches of one lag at neighbouring steps, with matches between them.
    diagonal = np.sort(lag * len(places) + step)
    link = np.flatnonzero(np.diff(diagonal) == 1)
    lag, here = np.divmod(diagonal[link], len(places))
    here = here * s
    same = np.searchsorted(bounds, here, "right") == np.searchsorted(bounds, here + s, "right")
    for k in range(1, min(s, 8)):
        between = here + (k * s // 8 if s > 8 else k)
        same &= ids[between] == ids[between - lag]
    link, lag, here = link[same], lag[same], here[same]
    if len(link) < 2:
        return []
    begins = np.flatnonzero(np.append(True, np.diff(link) != 1))
    ends = np.append(begins[1:], len(link)) - 1
    out = []
    for a, b in zip(begins[ends > begins].tolist(), ends[ends > begins].tolist()):
        out += _ended(ids, bounds, int(lag[a]), int(here[a]), int(here[b]) + s, s)
    return out


def _explained(step: np.ndarray, lag: np.ndarray, earlier: np.ndarray, s: int, steps: int, known: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether both words of a match lie in one known run whose period divides the lag."""
    start, period = np.zeros(steps, np.int64), np.zeros(steps, np.int64)
    for a, length, p in sorted((r for r in known if r[1] > s), key=lambda r: r[1]):
        covered = slice(-(-a // s), (a + length - 1) // s + 1)
        start[covered], period[covered] = a, p
    p = period[step]
    return (p > 0) & (earlier >= start[step]) & (lag % np.maximum(p, 1) == 0)


def _ended(ids: np.ndarray, bounds: np.ndarray, lag: int, a: int, b: int, s: int) -> list[tuple[int, int, int]]:
    """Runs of a diagonal that has matches from step a to step b and none at the steps around."""
    k = int(np.searchsorted(bounds, a, "right"))
    low, high = max(int(bounds[k - 1]) + lag, a - s), min(int(bounds[k]), b + s + 1)
    match = np.zeros(high - low + 2, bool)
    match[1:-1] = ids[low:high] == ids[low - lag : high - lag]
    edge = np.flatnonzero(match[1:] != match[:-1])
    lengths = edge[1::2] - edge[::2] + lag
    enough = lengths >= max(LEAST_WORDS, LEAST_PERIODS * lag)
    return [(low + x - lag, n, lag) for x, n in zip(edge[::2][enough].tolist(), lengths[enough].tolist())]


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Equal words get equal numbers; and where each text begins, with the end of the last."""
    numbers: dict[bytes, int] = {}
    bounds = np.cumsum([0, *map(len, texts)])
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for words in texts for w in words), np.int32, bounds[-1])
    return ids, bounds


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run contains after its first period, joined by a blank."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of `docs`.

    `runs` has (start, length, period) by start, then period, in words from 0; `collapsed` is the
    text with one period of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Python splits bytes at the blank and at the control characters 9 to 13, as WORD does.
            texts = [(body or b"").split() for body in batch.column(1).cast(pa.binary()).to_pylist()]
            ids, bounds = word_numbers(texts)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for start, length, period in runs_of(ids, bounds):
                k = int(np.searchsorted(bounds, start, "right")) - 1
                runs[k].append((start - int(bounds[k]), length, period))
            for found in runs:
                found.sort(key=lambda r: (r[0], r[2]))
            flat = list(zip(*[r for found in runs for r in found])) or [[], [], []]
            structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in flat], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, runs)]).astype(np.int32), structs)
            collapsed = [collapse(words, found).decode() for words, found in zip(texts, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in texts], pa.int64()), lists, pa.array(collapsed, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    return in_small_batches(source).mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, n_words long, runs array<{RUN}>, collapsed string")
