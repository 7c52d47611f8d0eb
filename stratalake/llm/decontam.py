"""Benchmark decontamination by latent semantic retrieval, then order and answer checks.

1. Document frequencies of hashed words are counted over all documents.
2. The benchmark's passages become TF-IDF rows of length one, in spaces of about `SPACE` passages.
   Randomised SVD of each space: a random start is multiplied by the rows and their transpose a few
   times; every task adds up its share of the product, the shares are added by blocks of terms, and the
   driver only orthogonalises a table of fixed size (terms x rank), one space at a time. A passage's
   image is its row in the space of the leading directions, seen in terms again.
3. Every document is read whole, once for all items. Windows at every block of `STEP` words that are
   wide enough to hold an item at any offset are compared with its image: the product of the image and
   of the window's TF-IDF vector, words foreign to the item left out, so they cost nothing. A
   hit leaves out at most 1 - `ORDER` of the item's words, so its product is no less than what remains
   of the item without its heaviest such words; this sum is the item's limit, and no window that the
   next step would accept is below it. The product takes the item's rarest words, as many as tell
   other windows best; a count of the same words, with the limit got in the same way, must agree.
4. A candidate is a hit if the longest common subsequence of words covers `ORDER` of the item and
   that with its last sentence (the answer) covers `ANSWER` of that sentence. Of an item's hits the
   one with the longest subsequence stands, then the one with the larger cosine (of the window's words
   that the item has, and the item's image).

The prepared items are stored in the shared folder; tasks read them there, so neither the driver nor
a plan holds the benchmark. Items of fewer than `LEAST_WORDS` words are hits where all their words
stand one after the other. Null and empty texts and items without a word have no hits; repeated rows
have equal hits; several rows of one item id (or without one) count as several items, of which the
best stands. Long documents are read in overlapping stretches.

Words are runs of letters, marks and digits of any script and _ after lower-casing. In scripts
without blanks (`SINGLE`) every character is a word. Format characters inside a word count nothing.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import in_small_batches, staged
from stratalake.llm.warc import located
from stratalake.session import scratch_path

TERMS, RANK, EXTRA, ROUNDS, SEED = 1 << 15, 256, 16, 2, 11
STEP, STRETCH, SPACE, LEAST_WORDS = 8, 1 << 15, 200, 8
ORDER, ANSWER = 0.6, 0.6
TERM_BLOCK = 4096
#: An item of which the space holds less than this share is not searched but an error.
FAINT = 1e-3
# Of UTF-8, after everything that is no part of a word has become a blank.
BYTE_VALUES = np.array([c + 1 if c >= 128 or chr(c).isalnum() or c == 95 else 0 for c in range(256)], np.uint32)
PLACES = np.random.default_rng(SEED).integers(1 << 30, 1 << 31, 64, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
# Han, kana, bopomofo, Thai, Lao, Burmese, Khmer, Tai Lue, Tai Tham, Javanese and their extensions.
SINGLE = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3021, 0x312F), (0x31A0, 0x31BF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F),
    (0x20000, 0x3FFFF),
)
BLANK, LETTER, ALONE, NOTHING = range(4)


@lru_cache(1)
def kinds_of_characters() -> np.ndarray:
    """What each code point is in a text."""
    kinds = np.zeros(sys.maxunicode + 1, np.uint8)
    for code in range(sys.maxunicode + 1):
        category = unicodedata.category(chr(code))
        if category[0] in "LMN" or code == 95:
            kinds[code] = LETTER
        elif category == "Cf" and code != 0x200B:  # a zero-width space parts words
            kinds[code] = NOTHING
    for a, b in SINGLE:
        part = kinds[a : b + 1]
        part[part == LETTER] = ALONE
    return kinds


def plain(text: str) -> bytes:
    """The text in lower case as UTF-8, with blanks for all that is no part of a word beyond ASCII."""
    text = text.lower()
    raw = text.encode("utf-8", "surrogatepass")
    if text.isascii():
        return raw
    lead = np.frombuffer(raw, np.uint8)
    # Beyond ASCII only Latin letters of two bytes (those begin with C3 to CA).
    if not ((lead == 0xC2) | (lead > 0xCA)).any() and "\xd7" not in text and "\xf7" not in text:
        return raw
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = kinds_of_characters()[codes]
    codes = np.where(kinds == BLANK, np.uint32(32), codes)[kinds != NOTHING]
    alone = kinds[kinds != NOTHING] == ALONE
    if alone.any():
        size = np.where(alone, 3, 1)
        ends = np.cumsum(size)[alone]
        codes = np.repeat(codes, size)
        codes[ends - 1] = codes[ends - 3] = 32
    return codes.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")


class Words:
    """The words of a text: their hashed terms at once, the words themselves when asked for."""

    def __init__(self, text: str | None):
        self.raw = plain(text or "")
        values = BYTE_VALUES[np.frombuffer(self.raw, np.uint8)]
        self.inside = np.zeros(len(values) + 1, bool)
        self.inside[1:] = values
        self.starts = np.flatnonzero(self.inside[1:] > self.inside[:-1])
        if not len(self.starts):
            self.terms = np.empty(0, np.int32)
            return
        values = values[self.starts[0] :]
        first = self.starts - self.starts[0]
        offset = np.arange(len(values), dtype=np.int32) - np.repeat(first.astype(np.int32), np.diff(first, append=len(values)))
        # other characters count nothing
        sums = np.add.reduceat(values * PLACES[offset & 63], first, dtype=np.uint32)
        self.terms = (sums * np.uint32(0x9E3779B1) >> np.uint32(17)).astype(np.int32)

    def __len__(self) -> int:
        return len(self.starts)

    def part(self, a: int = 0, b: int | None = None) -> list[bytes]:
        starts = self.starts[a:b]
        if not len(starts):
            return []
        stop = int(self.starts[b]) if b is not None and b < len(self.starts) else len(self.raw)
        inside = self.inside[1 + starts[0] : 1 + stop]
        ends = starts[0] + 1 + np.flatnonzero(inside & ~np.append(inside[1:], False))
        return [self.raw[i:j] for i, j in zip(starts.tolist(), ends.tolist())]


def document_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """Inverse document frequency of each term, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for body in batch.column(0):
                counts[np.unique(Words(body.as_py()).terms)] += 1
            rows += batch.num_rows
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(counts[used], rows))], ["term", "n"])

    found = in_small_batches(docs.select(F.col(text).alias("body"))).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts, rows = np.zeros(TERMS), 0
    for r in found.collect():  # at most one row per term
        if r.term < 0:
            rows = r.n
        else:
            counts[r.term] = r.n
    return np.log((1 + rows) / (1 + counts)) + 1e-3


def passages_of(bench: DataFrame) -> DataFrame:
    """Distinct terms and their counts of each passage, stored."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [np.unique(Words(body).terms, return_counts=True) for body in frame.item_text]
            yield pd.DataFrame({"terms": [r[0] for r in rows], "counts": [r[1].astype(np.float32) for r in rows]})

    return staged(bench.select("item_text").mapInPandas(run, "terms array<int>, counts array<float>"), "decontam-passages")


def latent_basis(passages: DataFrame, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terms, terms x rank): the passages' terms and the leading right singular vectors of their
    TF-IDF rows."""
    used = passages.select(F.explode("terms").alias("t")).distinct().collect()  # at most TERMS
    terms = np.array(sorted(r.t for r in used), np.int64)
    if not len(terms):
        return terms, np.empty((0, 0), np.float32)
    place = np.zeros(TERMS, np.int64)
    place[terms] = np.arange(len(terms))
    basis = np.random.default_rng(SEED).standard_normal((len(terms), min(RANK + EXTRA, len(terms))))
    basis = np.linalg.qr(basis)[0].astype(np.float32)
    for _ in range(ROUNDS + 1):
        product = _gram_product(passages, idf.astype(np.float32), place, basis)
        left, size, _ = np.linalg.svd(product, full_matrices=False)
        basis = left.astype(np.float32)
    return terms, basis[:, :RANK] * (size[:RANK] > 1e-6 * max(size[0], 1e-30))


def _gram_product(passages: DataFrame, idf: np.ndarray, place: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'(A basis) for the length-one TF-IDF rows A."""
    blocks = range(0, len(basis), TERM_BLOCK)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(basis.shape, np.float32)
        for frame in frames:
            for terms, counts in zip(frame.terms, frame.counts):
                if len(terms):
                    at, row = place[terms], counts * idf[terms]
                    row /= np.sqrt((row**2).sum())
                    total[at] += np.outer(row, row @ basis[at])
        yield pd.DataFrame({"block": list(blocks), "part": [total[b : b + TERM_BLOCK].tobytes() for b in blocks]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:  # one share per task
        parts = sum(np.frombuffer(p, np.float32).astype(np.float64) for p in sorted(frame.part))
        return pd.DataFrame({"block": frame.block[:1], "part": [parts.astype(np.float32).tobytes()]})

    shape = "block int, part binary"
    out = np.zeros(basis.shape)
    for r in passages.mapInPandas(run, shape).groupBy("block").applyInPandas(add, shape).collect():
        out[r.block : r.block + TERM_BLOCK] = np.frombuffer(r.part, np.float32).reshape(-1, basis.shape[1])
    return out


def spare_of(n: int) -> int:
    """So many of an item's n words a hit leaves out at most."""
    return max((k for k in range(n) if (n - k) / n >= ORDER), default=0)


class Item:
    """A benchmark item with what the order check needs."""

    def __init__(self, item_id, text: str):
        found = Words(text)
        self.id, self.words, self.terms, (self.kinds, self.counts) = item_id, found.part(), found.terms, np.unique(found.terms, return_counts=True)
        sentences = [w for w in (Words(x).part() for x in re.split(r"(?<=[.!?])\s+|(?<=[。！？｡])|\n", text or "")) if w]
        self.answer = sentences[-1] if sentences else []
        self.blocks = -(-len(self.words) // STEP) + 1
        self.spare = spare_of(len(self.words))
        self.places, self.answer_places = self._places(self.words), self._places(self.answer)

    @staticmethod
    def _places(words: list[bytes]) -> dict[bytes, int]:
        out: dict[bytes, int] = {}
        for i, w in enumerate(words):
            out[w] = out.get(w, 0) | 1 << i
        return out


def common_subsequence(places: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence, one bit per word of the item."""
    full = (1 << size) - 1
    row = full
    for w in words:
        if w in places:
            hit = row & places[w]
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def rarest(kinds: np.ndarray, counts: np.ndarray, often: np.ndarray, spare: int, width: int) -> tuple[np.ndarray, int]:
    """The rarest words that tell most, and how many of their occurrences a hit has at least.

    Whatever the number taken, no hit is lost; the one is taken that other windows reach least."""
    order = np.argsort(often[kinds], kind="stable")
    least = np.cumsum(counts[order]) - spare
    expected = np.cumsum(often[kinds[order]]) * width + 1e-9
    odds = np.where(least > expected, least * np.log(expected / np.maximum(least, 1)) + least - expected, 0.0)
    odds[least <= 0] = 1.0
    best = int(np.argmin(odds))
    return order[: best + 1], int(least[best])


def prepared(item_id: list, texts: list[str | None], idf: np.ndarray, terms: np.ndarray, basis: np.ndarray) -> pd.DataFrame:
    """What the search needs of the items of a space; items without a word are left out.

    `kinds` are an item's terms and `image` its row in the space there; `chosen` terms, of which
    it has `counts`, weigh `weights`; a hit reaches `need` with them, and `least` of their occurrences. Of a short item
    only the rarest term is `chosen`, its place in the item is `least`."""
    place = np.full(TERMS, -1)
    place[terms] = np.arange(len(terms))
    often = np.exp(-idf) / max(np.exp(-idf).sum(), 1e-12)
    rows = []
    for name, text in zip(item_id, texts):
        ids = Words(text).terms
        if not len(ids):
            continue
        kinds, counts = np.unique(ids, return_counts=True)
        row = counts * idf[kinds]
        row /= np.linalg.norm(row)
        own = basis[place[kinds]].astype(np.float64)
        image = own @ (row @ own)
        if row @ image < FAINT:
            raise RuntimeError(f"the space has lost item {name!r}: more directions are needed")
        if len(ids) < LEAST_WORDS:
            at = int(np.argmax(idf[ids]))
            rows.append((name, text, len(ids), kinds, image, ids[at : at + 1], np.ones(1), np.ones(1, np.int32), at, 0.0))
            continue
        spare, width = spare_of(len(ids)), STEP * (-(-len(ids) // STEP) + 2)
        chosen, least = rarest(kinds, counts, often, spare, width)
        weights = idf[kinds[chosen]] * np.maximum(image[chosen], 0.0)
        # The lightest of the chosen words, all but those that a hit may leave out.
        need = np.sort(np.repeat(weights, counts[chosen]))[: max(least, 0)].sum()
        rows.append((name, text, len(ids), kinds, image, kinds[chosen], weights, counts[chosen], least, need))
    return pd.DataFrame(rows, columns=["item_id", "text", "n", "kinds", "image", "chosen", "weights", "counts", "least", "need"])


PREPARED = "text string, n int, kinds array<int>, image array<double>, chosen array<int>, weights array<double>, counts array<int>, least int, need double"


def _spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers from each low up to its high, one after the other."""
    length = high - low
    return np.repeat(low - np.cumsum(length) + length, length) + np.arange(length.sum())


class Finder:
    """Hits of prepared items in whole texts."""

    def __init__(self, rows: pa.Table, idf: np.ndarray):
        self.idf, self.rows, self._items = idf, rows, {}
        numbers = lambda name: rows[name].to_numpy()
        size, self.least, self.need = numbers("n"), numbers("least"), numbers("need") * (1 - 1e-9)
        self.blocks = -(-size // STEP) + 2
        chosen = rows["chosen"].combine_chunks()
        owner = np.repeat(np.arange(len(size)), np.diff(chosen.offsets.to_numpy()))
        terms, weights = chosen.flatten().to_numpy().astype(np.int64), rows["weights"].combine_chunks().flatten().to_numpy()
        short = size[owner] < LEAST_WORDS
        self.short: dict[int, list[int]] = {}
        for term, k in zip(terms[short].tolist(), owner[short].tolist()):
            self.short.setdefault(term, []).append(k)
        self.anchors = np.zeros(TERMS, bool)
        self.anchors[list(self.short)] = True
        # Inverted lists: the items that chose a term, with its weight and count there.
        terms, owner, weights, counts = terms[~short], owner[~short], weights[~short], rows["counts"].combine_chunks().flatten().to_numpy()[~short]
        order = np.argsort(terms, kind="stable")
        self.first = np.searchsorted(terms[order], np.arange(TERMS + 1))
        self.listed = np.diff(self.first) > 0
        self.list_term, self.list_item, self.list_weight, self.list_count = terms[order], owner[order], weights[order], counts[order]
        self.reach = STEP * int(self.blocks[size >= LEAST_WORDS].max(initial=0))

    def item(self, k: int) -> Item:
        if k not in self._items:
            self._items[k] = Item(self.rows["item_id"][k].as_py(), self.rows["text"][k].as_py())
        return self._items[k]

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item number, first words) of the windows of a stretch that may hold an item."""
        # Items that the stretch as a whole may hold: each of its words as often as the item has it.
        seen = np.zeros(TERMS, bool)
        seen[ids] = True
        distinct = np.flatnonzero(seen & self.listed)
        lists = _spread(self.first[distinct], self.first[distinct + 1])
        items, counts = self.list_item[lists], self.list_count[lists]
        often = np.bincount(items, counts, len(self.need))
        product = np.bincount(items, counts * self.list_weight[lists], len(self.need))
        near = (often >= np.maximum(self.least, 1)) & (product >= self.need - 1e-9)
        lists = lists[near[items]]
        if not len(lists):
            return
        # Their words, block by block.
        terms = self.list_term[lists]
        low, high = np.searchsorted(terms, ids), np.searchsorted(terms, ids, "right")
        places = np.flatnonzero(high > low)
        entry, length = lists[_spread(low[places], high[places])], (high - low)[places]
        items = self.list_item[entry]
        order = np.argsort(items, kind="stable")
        blocks, items, weights = np.repeat(places // STEP, length)[order], items[order], self.list_weight[entry][order]
        n = -(-len(ids) // STEP)
        edges = np.flatnonzero(np.diff(items, prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            k = int(items[a])
            wide = min(int(self.blocks[k]), n)
            sums = np.zeros((2, n + 1))
            np.cumsum(np.bincount(blocks[a:b], weights[a:b], n), out=sums[0, 1:])
            np.cumsum(np.bincount(blocks[a:b], minlength=n), out=sums[1, 1:])
            product, often = sums[:, wide:] - sums[:, : n + 1 - wide]
            starts = np.flatnonzero((product >= self.need[k] - 1e-9) & (often >= self.least[k])) * STEP
            if len(starts):
                item = self.item(k)
                starts = starts[self._shared(item, ids, starts) >= len(item.words) - item.spare]
                if len(starts):
                    yield k, starts

    @staticmethod
    def _shared(item: Item, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Words that each window shares with the item, repeats as often as both have them: no subsequence is longer."""
        out = []
        for at in range(0, len(starts), 1024):
            places = starts[at : at + 1024, None] + np.arange(STEP * (item.blocks + 1))
            terms = np.where(places < len(ids), ids[np.minimum(places, len(ids) - 1)], TERMS)
            kind = np.minimum(np.searchsorted(item.kinds, terms), len(item.kinds) - 1)
            cell = np.arange(len(terms))[:, None] * len(item.kinds) + kind
            counts = np.bincount(cell[item.kinds[kind] == terms], minlength=len(terms) * len(item.kinds))
            out.append(np.minimum(counts.reshape(len(terms), -1), item.counts).sum(axis=1))
        return np.concatenate(out)

    def cosine(self, k: int, ids: np.ndarray) -> float:
        """Of a window's TF-IDF vector, in the terms that the item has, and the item's image."""
        kinds, image = (np.array(self.rows[c][k].as_py()) for c in ("kinds", "image"))
        own = self.item(k)
        found, counts = np.unique(ids[np.isin(ids, kinds)], return_counts=True)
        if not len(found):
            return 0.0
        at = np.searchsorted(kinds, found)
        window = np.minimum(counts, own.counts[at]) * self.idf[found]
        return float(min(1.0, window @ image[at] / max(np.linalg.norm(window) * np.linalg.norm(image), 1e-12)))

    def _short_hits(self, words: Words) -> dict:
        """Hits of the items that are too short for windows: their words one after the other."""
        best: dict = {}
        ids = words.terms
        for at in np.flatnonzero(self.anchors[ids]).tolist() if self.short else ():
            for k in self.short[int(ids[at])]:
                item = self.item(k)
                a = at - int(self.least[k])
                b = a + len(item.words)
                if item.id not in best and a >= 0 and np.array_equal(ids[a:b], item.terms) and words.part(a, b) == item.words:
                    best[item.id] = (item.id, 1.0, self.cosine(k, ids[a:b]), 1.0)
        return best

    def hits(self, text: str | None) -> list[tuple]:
        """(item id, cosine, share of the item in order, share of the answer), the best of each item."""
        words = Words(text)
        ids = words.terms
        best = self._short_hits(words)
        for at in range(0, max(1, len(ids)), STRETCH):
            part = ids[at : at + STRETCH + self.reach]
            if len(part) == 0 or (at and len(part) <= self.reach):
                continue
            for k, starts in self.candidates(part):
                item = self.item(k)
                for a in (at + starts).tolist():
                    if best.get(item.id, (0, 0))[1] == 1.0:
                        break
                    b = a + STEP * item.blocks
                    window = words.part(a, b + STEP)
                    order = common_subsequence(item.places, len(item.words), window) / len(item.words)
                    if order < max(ORDER, best.get(item.id, (0, 0))[1]):
                        continue
                    answer = common_subsequence(item.answer_places, len(item.answer), window) / len(item.answer)
                    if answer >= ANSWER:
                        cosine = self.cosine(k, ids[a : b + STEP])
                        if (order, cosine) > best.get(item.id, (0, 0, 0))[1:3]:
                            best[item.id] = (item.id, order, cosine, answer)
        return [(i, c, o, a) for i, o, c, a in best.values()]


@lru_cache(1)
def stored_finder(path: str, idf: bytes) -> Finder:
    """The prepared items at `path`, read once by a worker."""
    system, place = located(path)
    files = system.get_file_info(fs.FileSelector(place))
    names = sorted(f.path for f in files if f.is_file and f.base_name.endswith(".parquet"))
    return Finder(pa.concat_tables([pq.read_table(n, filesystem=system) for n in names]), np.frombuffer(idf))


def store_items(bench: DataFrame, idf: np.ndarray) -> str:
    """Prepare the items (item_id, item_text) space by space; the folder that holds them."""
    spark, kind = bench.sparkSession, dict(bench.dtypes)["item_id"]
    spaces = max(1, round(bench.count() / SPACE))
    bench = bench.withColumn("space", F.pmod(F.xxhash64("item_id", "item_text"), F.lit(spaces)))
    bench = bench if spaces == 1 else staged(bench, "decontam-items")
    path = scratch_path(spark, "decontam-prepared")
    for k in range(spaces):
        items = bench.where(F.col("space") == k).select("item_id", "item_text")
        terms, basis = latent_basis(passages_of(items), idf)

        def run(frames: Iterator[pd.DataFrame], terms=terms, basis=basis) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield prepared(frame.item_id.tolist(), frame.item_text.tolist(), idf, terms, basis)

        shape = f"item_id {kind}, {PREPARED}"
        items.mapInPandas(run, shape).write.mode("append").parquet(path)
    return path


def contaminated(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, cosine, order_share, answer_share): one row per row of `docs` and benchmark
    item that it holds; `key` is any column of `docs`."""
    from pyspark.sql.pandas.types import to_arrow_schema

    bench = bench.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item_text"))
    item_type = dict(bench.dtypes)["item_id"]
    idf = document_frequencies(docs, text)
    path, weights = store_items(bench, idf), idf.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = stored_finder(path, weights)
        for batch in batches:
            rows = [(i, h) for i, body in enumerate(batch.column(1)) for h in finder.hits(body.as_py())]
            columns = list(zip(*[h for _, h in rows])) or [[], [], [], []]
            keys = batch.column(0).take(pa.array([i for i, _ in rows], pa.int64()))
            kinds = [item_kind, pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    names = ["key", "item_id", "cosine", "order_share", "answer_share"]
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    shape = f"key {dict(source.dtypes)['key']}, item_id {item_type}, cosine double, order_share double, answer_share double"
    item_kind = to_arrow_schema(docs.sparkSession.createDataFrame([], f"x {item_type}").schema).field(0).type
    return in_small_batches(source).mapInArrow(run, shape)
