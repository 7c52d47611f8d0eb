"""Token counts of a byte-level BPE vocabulary, by two compiled finite-state transducers.

The first one splits a text into pieces (contractions; letters, digits or symbols with a space
before them; white space). It has twelve states; a transition says whether a piece starts at
this character or at the one before. Its input is cut into chunks that are run side by side:
a chunk is first run from every state, the state maps of the chunks are composed by a parallel
prefix scan, and a second run from the states so found marks the pieces.

The second one counts the tokens of a piece. After each byte exactly one token can end the
encoding so far: the longest suffix that is a token and, put after the token before it, is left
alone by the merges. So the last token is the state, "token b may follow token a" is a
transition that emits one token, and which transitions exist is compiled from the merges the
first time one is asked for. Every piece starts in the first state, so pieces are chunks whose
maps are just numbers: the distinct pieces of a block are run side by side, one byte of each at
a time. Long pieces use the deterministic form: there a state holds the last tokens and
relative counts as far back as a token can still begin, and a transition on a byte carries the
change of the count.

Null and empty texts have no tokens. Texts are handled whole, long ones in pieces cut where a
piece must begin anyway. The special string counts as one token, as the library does by default.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import in_small_batches

# Character classes.
OTHER, LETTER, NUMBER, BLANK, SPACE, QUOTE, ONE, TWO, ELL, EE, END = range(11)
# States: in a run of letters, digits, symbols; white space that ends in a blank or not, one
# character long or longer; after a quote that starts a piece, then r or v, then l; after a contraction.
(START, IN_L, IN_N, IN_O, BLANK1, BLANKS, SPACE1, SPACES, QUOTED, QUOTED_RV, QUOTED_L, DONE) = STATES = range(12)
HERE, BEFORE = 1, 2
LANE, BLOCK = 256, 1 << 20
MAX_STATES, MAX_WORDS, MAX_PAIRS, SHORT = 50_000, 300_000, 1 << 20, 32
WHITE = "\t\n\x0b\x0c\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))


def begin(c: int) -> tuple[int, int]:
    """The character starts a piece."""
    if c == END:
        return START, 0
    return {OTHER: IN_O, NUMBER: IN_N, BLANK: BLANK1, SPACE: SPACE1, QUOTE: QUOTED}.get(c, IN_L), HERE


def step(state: int, c: int) -> tuple[int, int]:
    """Next state and where pieces start."""
    letter, symbol = c in (LETTER, ONE, TWO, ELL, EE), c in (OTHER, QUOTE)
    if state in (BLANK1, BLANKS, SPACE1, SPACES):
        if c in (BLANK, SPACE):
            return (BLANKS if c == BLANK else SPACES), 0
        if c == END:
            return START, 0
        if state in (BLANK1, BLANKS):  # the blank belongs to what follows
            return (IN_L if letter else IN_O if symbol else IN_N), (0 if state == BLANK1 else BEFORE)
        after, out = begin(c)
        return after, out | (0 if state == SPACE1 else BEFORE)
    if (state == IN_L and letter) or (state == IN_N and c == NUMBER) or (state in (IN_O, QUOTED) and symbol):
        return (IN_O if state == QUOTED else state), 0
    if state == QUOTED and c in (ONE, TWO, ELL):
        return {ONE: DONE, TWO: QUOTED_RV, ELL: QUOTED_L}[c], 0
    if state in (QUOTED_RV, QUOTED_L):
        if c == (EE if state == QUOTED_RV else ELL):
            return DONE, 0
        if letter:
            return IN_L, BEFORE
        after, out = begin(c)
        return after, out | BEFORE
    return begin(c)


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every code point; next states; outputs."""
    classes = np.zeros(sys.maxunicode + 1, np.uint8)
    for cp in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(cp))[0]
        classes[cp] = LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    for c in WHITE:
        classes[ord(c)] = SPACE
    for chars, kind in ((" ", BLANK), ("'", QUOTE), ("stmd", ONE), ("rv", TWO), ("l", ELL), ("e", EE)):
        for c in chars:
            classes[ord(c)] = kind
    moves = [[step(s, c) for c in range(END + 1)] for s in STATES]
    pick = lambda i: np.array([[m[i] for m in row] for row in moves], np.uint8)
    return classes, pick(0), pick(1)


def scan(maps: np.ndarray) -> np.ndarray:
    """Row i becomes row i after row i-1 after ... after row 0."""
    maps, d = maps.copy(), 1
    while d < len(maps):
        maps[d:] = np.take_along_axis(maps[d:], maps[:-d].astype(np.intp), axis=1)
        d *= 2
    return maps


def piece_starts(kinds: np.ndarray) -> np.ndarray:
    """Positions at which pieces start, for the classes of a character stream."""
    _, moves, outs = tables()
    n = len(kinds)
    lanes = -(-n // LANE)
    stream = np.full(lanes * LANE, END, np.uint8)
    stream[:n] = kinds
    columns = np.ascontiguousarray(stream.reshape(lanes, LANE).T)
    state = np.tile(np.arange(len(STATES), dtype=np.uint8), (lanes, 1))
    for t in range(LANE):
        state = moves[state, columns[t][:, None]]
        if state.shape[1] > 1 and t % 8 == 7 and (state == state[:, :1]).all():
            state = state[:, :1]  # all starts have met in every chunk
    if state.shape[1] == 1:
        state = np.repeat(state, len(STATES), axis=1)
    state = np.concatenate([[START], scan(state)[:-1, START]]).astype(np.uint8)
    marks = np.empty((LANE, lanes), np.uint8)
    for t in range(LANE):
        marks[t] = outs[state, columns[t]]
        state = moves[state, columns[t]]
    marks = marks.T.reshape(-1)
    starts = (marks & HERE).astype(bool)
    starts[:-1] |= (marks[1:] & BEFORE).astype(bool)
    return np.flatnonzero(starts[:n])


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable Latin-1 as it is, the
    rest in order from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Table:
    """Hash table from non-negative longs to ints that is read and filled by whole arrays."""

    def __init__(self, bits: int = 12):
        self.bits, self.size = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where there is none."""
        out, open_, slot = np.full(len(keys), -1, np.int32), np.arange(len(keys)), self.slots(keys)
        while len(open_):
            there = self.keys[slot]
            hit = there == keys
            out[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            open_, keys, slot = open_[on], keys[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New distinct keys."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            old, kept = self.keys, self.keys >= 0
            bits = self.bits
            while 2 * (self.size + len(keys)) > 1 << bits:
                bits += 1
            old, before, self.size = old[kept], self.values[kept], 0
            self.bits, self.keys, self.values = bits, np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
            self.put(old, before)
        self.size += len(keys)
        slot = self.slots(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) & (len(self.keys) - 1)


class PieceCounts(dict):
    """Piece -> number of tokens, filled by `learn`."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        super().__init__()
        self.tokens = [bytes((b,)) for b in range(256)]  # single bytes, then what each merge makes
        self.ids = {t: i for i, t in enumerate(self.tokens)}
        left, right, rank = [-1] * 256, [-1] * 256, [-1] * 256
        for i, (a, b) in enumerate(merges):
            if a + b not in self.ids:
                self.ids[a + b] = len(self.tokens)
                self.tokens.append(a + b)
                left.append(self.ids[a])
                right.append(self.ids[b])
                rank.append(i)
        self.left, self.right, self.rank = np.array(left), np.array(right), np.array(rank)
        self.merges = Table()
        self.merges.put(np.array([self.ids[a] * len(self.tokens) + self.ids[b] for a, b in merges]), np.arange(len(merges)))
        # A token stands alone when its two halves do and nothing crosses between them before.
        whole = np.concatenate([np.ones(256, bool), self.apart(self.left[256:], self.right[256:], self.rank[256:])])
        for i in range(256, len(whole)):
            whole[i] &= whole[left[i]] & whole[right[i]]
        self.whole = whole
        nodes, keys = {b"": 0}, []
        for token in sorted(self.tokens):
            for i in range(1, len(token) + 1):
                if token[:i] not in nodes:
                    nodes[token[:i]] = len(nodes)
                    keys.append(nodes[token[: i - 1]] * 256 + token[i - 1])
        self.prefixes = nodes
        self.children = Table()
        self.children.put(np.array(keys), np.arange(1, len(nodes)))
        self.node_token = np.array([self.ids.get(t, -1) for t in nodes], np.int32)
        self.pairs = Table()
        self.reset()

    def reset(self) -> None:
        self.moves, self.known = [{}], {(b"", (-1,), (0,)): 0}
        self.held = [(b"", (-1,), (0,))]

    def apart(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | int = 1 << 40) -> np.ndarray:
        """Whether no merge of a rank below `until` joins the end of a with the start of b.

        The merges inside a and b are undone, the last one first. A merge across the border
        happens when its rank comes before those that consume the piece on either side; of
        equal ranks the left one is first.
        """
        out, open_ = np.ones(len(a), bool), np.arange(len(a))
        stop_a = stop_b = np.broadcast_to(np.asarray(until, np.int64), a.shape)
        a, b, stop_b = a.astype(np.int64), b.astype(np.int64), stop_b - (stop_b < 1 << 40)
        while len(open_):
            across = self.merges.get(a * len(self.tokens) + b)
            joined = (across >= 0) & (across < stop_a) & (across <= stop_b)
            out[open_[joined]] = False
            on = ~joined & ((self.rank[a] >= 0) | (self.rank[b] >= 0))
            open_, a, b, stop_a, stop_b = (x[on] for x in (open_, a, b, stop_a, stop_b))
            undo = self.rank[a] > self.rank[b]
            stop_a, stop_b = np.where(undo, self.rank[a], stop_a), np.where(undo, stop_b, self.rank[b])
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return out

    def fits(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether `token` may follow `before` (-1: start)."""
        keys = before.astype(np.int64) * len(self.tokens) + token
        first = before < 0
        out = np.where(first, self.whole[token], False)
        keys = keys[~first]
        found = self.pairs.get(keys)
        if (found < 0).any():
            if self.pairs.size > MAX_PAIRS:
                self.pairs = Table()
                found[:] = -1
            new = np.unique(keys[found < 0])
            last, token = np.divmod(new, len(self.tokens))
            self.pairs.put(new, (self.whole[token] & self.apart(last, token)).astype(np.int32))
            found = self.pairs.get(keys)
        out[~first] = found > 0
        return out

    def learn(self, pieces: set[str]) -> None:
        """Count pieces that are not there yet."""
        if len(self) + len(pieces) > MAX_WORDS:
            self.clear()
        raw = [(p, p.encode()) for p in pieces]
        self.update((p, self.long_count(b)) for p, b in raw if len(b) > SHORT)
        if short := [(p, b) for p, b in raw if len(b) <= SHORT]:
            self.update(zip((p for p, _ in short), self.run([b for _, b in short]).tolist()))

    def run(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each short piece."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-sizes, kind="stable")  # the pieces still running come first
        sizes = sizes[order]
        stream = np.frombuffer(b"".join(pieces[i] for i in order.tolist()), np.uint8)
        base = np.cumsum(sizes) - sizes
        ends = np.repeat(base + sizes, sizes)
        alive, node, ending = np.arange(len(stream)), np.zeros(len(stream), np.int64), []
        for size in range(1, int(sizes[0]) + 1):  # tokens of each size, by their first position
            alive, node = (x[alive + size <= ends[alive]] for x in (alive, node))
            node = self.children.get(node * 256 + stream[alive + size - 1]).astype(np.int64)
            alive, node = alive[node >= 0], node[node >= 0]
            if not len(alive):
                break
            tokens = np.full(len(stream), -1, np.int32)
            tokens[alive] = self.node_token[node]
            ending.append(tokens)
        places = base + np.arange(len(pieces))  # one place before the first byte and one after each
        last, count = np.full(len(stream) + len(pieces), -1, np.int32), np.zeros(len(stream) + len(pieces), np.int32)
        for i in range(1, int(sizes[0]) + 1):
            todo = np.arange(int(np.searchsorted(-sizes, -i, side="right")))
            for size in range(min(i, len(ending)), 0, -1):
                token = ending[size - 1][base[todo] + i - size]
                maybe = np.flatnonzero(token >= 0)
                if not len(maybe):
                    continue
                at = places[todo[maybe]] + i
                good = self.fits(last[at - size], token[maybe])
                at = at[good]
                last[at], count[at] = token[maybe[good]], count[at - size] + 1
                todo = np.delete(todo, maybe[good])
                if not len(todo):
                    break
        totals = np.empty(len(pieces), np.int32)
        totals[order] = count[places + sizes]
        return totals

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        seen, tokens, counts = self.held[state]
        depth, seen = len(seen), seen + bytes((byte,))
        reach = next(d for d in range(len(seen), 0, -1) if seen[-d:] in self.prefixes)
        for size in range(reach, 0, -1):
            token, at = self.ids.get(seen[-size:]), depth + 1 - size
            if token is not None and self.fits(np.array([tokens[at]]), np.array([token]))[0]:
                break
        more = counts[at] + 1
        kept = depth + 1 - reach
        held = (seen[-reach:], (*tokens[kept:], token), (*(c - more for c in counts[kept:]), 0))
        if held not in self.known:
            self.known[held] = len(self.moves)
            self.moves.append({})
            self.held.append(held)
        self.moves[state][byte] = move = (self.known[held], more)
        return move

    def long_count(self, piece: bytes) -> int:
        state = total = 0
        for byte in piece:
            move = self.moves[state].get(byte) or self.compile(state, byte)
            state, total = move[0], total + move[1]
        if len(self.moves) > MAX_STATES:
            self.reset()
        return total


class TokenCounter:
    """Counts for whole texts; `path` is a tokenizer file (byte-level BPE with the usual pattern)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, model = spec["pre_tokenizer"] or {}, spec["model"]
        usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if model["type"] != "BPE" or not usual or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.special = [t["content"] for t in spec["added_tokens"]]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.pieces = PieceCounts([(raw(a), raw(b)) for a, b in pairs])
        self.marker = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        totals, parts, owners, size = [0] * len(texts), [], [], 0
        for i, text in enumerate(texts):
            for segment in self.segments(text or "", totals, i):
                parts.append(segment)
                owners.append(i)
                size += len(segment) + 1
                if size >= BLOCK:
                    self._add(parts, owners, totals)
                    parts, owners, size = [], [], 0
        if parts:
            self._add(parts, owners, totals)
        return totals

    def segments(self, text: str, totals: list[int], i: int) -> Iterator[str]:
        at = 0
        for m in self.marker.finditer(text):
            totals[i] += 1
            yield from blocks(text[at : m.start()])
            at = m.end()
        yield from blocks(text[at:] if at else text)

    def _add(self, parts: list[str], owners: list[int], totals: list[int]) -> None:
        stream = "\0".join(parts) + "\0"
        kinds = tables()[0][np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), np.uint32)]
        stops = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        kinds[stops] = END
        starts = piece_starts(kinds)
        edges = np.sort(np.concatenate([starts, stops]))
        whole = np.searchsorted(edges, starts)
        ends = edges[whole + 1]
        pieces = [stream[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        if new := set(pieces).difference(self.pieces):
            if len(new) + len(self.pieces) > MAX_WORDS:
                new = set(pieces)
            self.pieces.learn(new)
        counts = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        per_part = np.bincount(np.searchsorted(stops, starts), counts, len(parts)).astype(np.int64).tolist()
        for owner, n in zip(owners, per_part):
            totals[owner] += n


def blocks(text: str) -> Iterator[str]:
    """Parts of a long text, cut where white space follows something else: a piece starts there."""
    at = 0
    while len(text) - at > 2 * BLOCK:
        cut = max((m.start() + 1 for m in re.finditer(r"[!-~][ \n]", text[at + BLOCK : at + 2 * BLOCK])), default=None)
        if cut is None:
            break
        yield text[at : (at := at + BLOCK + cut)]
    yield text[at:] if at else text


@lru_cache(2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                tokens = count.count(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("body"))
    out = in_small_batches(source).mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
