"""Periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q and a length of
at least max(6, 4q) that no neighbouring word extends keeping the period.

The words of a slice of texts, each text between letters of its own, are one
string. Recompression alternates two steps until no question is open: block
compression (a maximal block of one letter becomes a letter for letter and
length) and pair compression (the letters are split into left and right ones
and every left letter followed by a right one becomes one letter). Equal
stretches are parsed alike but for a symbol at each end of a level, so the
levels are a run-length grammar that answers how far two places agree (LCE):
climb while both places start symbols, step over at most one pair half or the
shorter rest of a block on each level, and come down at the first difference.

Candidates are a harmonic grid: a run of period q holds a multiple x of 3q
with word x equal to word x + q, so each q is asked about at n / 3q places.
Exact extensions to both sides give the maximal stretch; of equal stretches
the smallest period stays. No suffix array, no bound on period or length.

Defined results: null, empty and wordless texts have no words and no run; a
null doc_id is never planted (its words stay as they are); repeated rows have
a row each; other columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame

from . import common as C

LEAST_LENGTH = 6
LEAST_PERIODS = 4
QUESTIONS = 1 << 19   # grid places asked about at once
PLANT_EVERY = 10      # documents whose hash is a multiple of it get a periodic tail


def planted(words: list, doc_id: int | None) -> list:
    """The words with a periodic tail for every tenth id: word i >= a becomes word a + (i - a) % p."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % PLANT_EVERY:
        return words
    g = h // PLANT_EVERY
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * (-(-(n - a) // p)))[:n - a]


class Level:
    """One step of the grammar: symbols below, and where each symbol above starts among them."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, block: bool):
        self.symbols, self.first, self.block = symbols, first, block
        size = np.diff(first)
        self.up = np.repeat(np.arange(len(size)), size)

    def mirrored(self) -> Level:
        out = Level.__new__(Level)
        n, m = len(self.symbols), len(self.first) - 1
        out.symbols, out.first, out.block = self.symbols[::-1], (n - self.first)[::-1], self.block
        out.up = (m - 1 - self.up)[::-1]
        return out


class Grammar:
    """Run-length grammar of a string by recompression, built level by level as questions need it.

    letters: the string, which starts and ends with a letter that occurs once.
    """

    def __init__(self, letters: np.ndarray):
        self.top = np.unique(letters, return_inverse=True)[1].astype(np.int64)
        self.levels: list[Level] = []
        self.mirrors: list[Level] = []

    def level(self, k: int, back: bool) -> Level:
        while len(self.levels) <= k:
            self._compress_blocks()
            self._compress_pairs()
        return (self.mirrors if back else self.levels)[k]

    def _push(self, level: Level, above: np.ndarray) -> None:
        self.levels.append(level)
        self.mirrors.append(level.mirrored())
        self.top = np.unique(above, return_inverse=True)[1].astype(np.int64)

    def _compress_blocks(self) -> None:
        s = self.top
        first = np.append(np.flatnonzero(np.diff(s, prepend=s[0] - 1)), len(s))
        size = np.diff(first)
        self._push(Level(s, first, True), s[first[:-1]] * (int(size.max()) + 1) + size)

    def _compress_pairs(self) -> None:
        s = self.top
        n = int(s.max()) + 1
        letters = np.arange(n, dtype=np.uint64)
        for seed in range(1, 1000):  # neighbours differ, so a split joins an eighth of them at least at every third try
            left = C.mix(letters + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))) & np.uint64(1) == 0
            one = left[s]
            up, down = one[:-1] & ~one[1:], ~one[:-1] & one[1:]
            join = up if up.sum() >= down.sum() else down
            if 8 * join.sum() >= len(join):
                break
        start = np.ones(len(s), bool)
        start[1:] = ~join
        first = np.append(np.flatnonzero(start), len(s))
        at = first[:-1]
        paired = np.diff(first) == 2
        above = s[at] * (n + 1)
        above[paired] += s[at[paired] + 1] + 1
        self._push(Level(s, first, False), above)

    def lce(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many letters agree from i and from j (i != j) on, or, going back, up to i and j."""
        n = len(self.level(0, False).symbols)
        if back:
            i, j = n - 1 - i, n - 1 - j
        a, b = i.copy(), j.copy()
        open_ = np.arange(len(i))
        came: list[np.ndarray] = []  # questions that differ first at each level
        k = 0
        while len(open_):
            lev = self.level(k, back)
            x, y = a[open_], b[open_]
            same = lev.symbols[x] == lev.symbols[y]
            came.append(open_[~same])
            open_, x, y = open_[same], x[same], y[same]
            ux, uy = lev.up[x], lev.up[y]
            inside = (lev.first[ux] != x) | (lev.first[uy] != y)
            if lev.block:
                rx, ry = lev.first[ux + 1] - x, lev.first[uy + 1] - y
                step = np.where(inside, np.minimum(rx, ry), 0)
                apart = inside & (rx != ry)
            else:
                step = inside.astype(np.int64)
                apart = np.zeros(len(x), bool)
            x, y = x + step, y + step
            a[open_], b[open_] = x, y
            came[k] = np.concatenate([came[k], open_[apart]])
            open_ = open_[~apart]
            a[open_], b[open_] = lev.up[a[open_]], lev.up[b[open_]]
            k += 1
        falling = np.zeros(0, np.int64)
        for k in range(len(came) - 1, 0, -1):
            falling = np.concatenate([falling, came[k]])
            lev = self.level(k - 1, back)
            x, y = a[falling], b[falling]
            px, py = lev.first[x], lev.first[y]
            same = lev.symbols[px] == lev.symbols[py]
            step = np.minimum(lev.first[x + 1] - px, lev.first[y + 1] - py) if lev.block else 1
            a[falling], b[falling] = px + step * same, py + step * same
        return a - i


def grid(first: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) in pieces: in each text the multiples of 3q below its end less q, for every q up to a quarter of it."""
    own = np.repeat(np.arange(len(count)), count // LEAST_PERIODS)
    q = C.spans(np.ones(len(count), np.int64), count // LEAST_PERIODS)
    step = (LEAST_PERIODS - 1) * q
    many = -(-(count[own] - q) // step)
    for s in C.slices(many.tolist(), QUESTIONS):
        m = many[s]
        which = np.repeat(np.arange(s.start, s.stop), m)
        nth = C.spans(np.zeros(len(m), np.int64), m)
        yield first[own[which]] + nth * step[which], q[which]


def runs_of(letters: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs, ordered by start, then period.

    letters: the string of a slice of texts; first, count: place and number of
    the words of each. Every text has a letter of its own on either side.
    """
    grammar = Grammar(letters)
    found = [np.zeros((0, 3), np.int64)]
    for at, q in grid(first, count):
        hit = letters[at] == letters[at + q]
        at, q = at[hit], q[hit]
        if not len(at):
            continue
        ahead, behind = grammar.lce(at, at + q), grammar.lce(at - 1, at + q - 1, back=True)
        start, end = at - behind, at + q + ahead
        ok = end - start >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * q)
        found.append(np.unique(np.stack([start, end, q], axis=1)[ok], axis=0))
    out = np.unique(np.concatenate(found), axis=0)  # by start, end, period
    new = np.ones(len(out), bool)
    new[1:] = (out[1:, :2] != out[:-1, :2]).any(axis=1)
    out = out[new]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _digest(words: list, runs: np.ndarray) -> tuple:
    """Result values of one text; runs: (start, end, period), places within the text."""
    said = "".join(f"{s},{e - s},{p}\n" for s, e, p in runs.tolist())
    best = (None,) * 4
    kept = words
    if len(runs):
        drop = np.zeros(len(words) + 1, np.int64)
        np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
        np.add.at(drop, runs[:, 1], -1)
        stay = np.cumsum(drop[:-1]) == 0
        kept = [w for w, k in zip(words, stay.tolist(), strict=True) if k]
        s, e, p = max(runs.tolist(), key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]))
        best = (s, e - s, p, 1000 * (e - s) // p)
    return (len(runs), *best, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


NAMES = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def word_runs(texts: list[list]) -> list[np.ndarray]:
    """(start, end, period) of the runs of each list of words."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    count = np.array([len(w) for w in texts], np.int64)
    first = np.cumsum(count + 1) - count
    letters = np.empty(int((count + 1).sum()) + 1, np.int64)
    for f, w in zip(first.tolist(), texts, strict=True):
        letters[f:f + len(w)] = [number[x] for x in w]
    between = np.append(first - 1, len(letters) - 1)
    letters[between] = len(number) + np.arange(len(between))
    runs = runs_of(letters, first, count)
    own = np.searchsorted(first, runs[:, 0], side="right") - 1
    cut = np.searchsorted(own, np.arange(len(texts) + 1))
    return [runs[cut[i]:cut[i + 1]] - np.array([first[i], first[i], 0]) for i in range(len(texts))]


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Columns of docs but text, plus the number of runs, the strongest one and the digests.

    docs: (doc_id, text, ...). plant: give every tenth document by the hash of
    its id the periodic tail of planted() first.
    """

    def make(cols: dict[str, list]) -> dict:
        words = [(t or "").encode("utf-8", "surrogatepass").split() for t in cols["text"]]  # bytes split at ASCII white space
        if plant:
            words = [planted(w, d) for w, d in zip(words, cols["doc_id"], strict=True)]
        rows = [_digest(w, r) for w, r in zip(words, word_runs(words), strict=True)]
        return dict(zip(NAMES, map(list, zip(*rows, strict=True)), strict=True))

    ddl = ", ".join(f"{n} {'string' if n.endswith('sha256') else 'long'}" for n in NAMES)
    return C.by_rows(docs, ["text", "doc_id"], ddl, make, drop=["text"])
