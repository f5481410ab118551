"""SimHash near-dedup by a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Two fingerprints that differ in at
most two bits differ in at most two bytes, so they share six positional bytes
at least: the guaranteed minimum. The index holds each distinct fingerprint
under every choice of six positions with the bytes there (28 entries), and a
pair that shares t positional bytes meets in C(t, 6) of its lists: the count
reaches the minimum exactly when the pair meets. In a list only the two bytes
left differ, so it never has more than 65,536 entries, whatever the input; the
bits in those two are verified.

Lists are dealt by hash into parts of some PART entries. In a part, entries of
lists up to NEAR long meet by shifted comparison; longer lists look up the 136
places at one or two bits' distance instead of trying all pairs. What is linked
in a list becomes a star on its smallest fingerprint, so a list of any size
passes on fewer links than entries; links() gives the pairs themselves.

Copies share one fingerprint and are one entry. The hot fingerprints of large
groups come back to their rows by broadcast (fewer than a fixed number can be
hot), the others by a shuffle.

Defined results: null, empty and wordless texts have fingerprint zero and are
linked like any other; texts of one or two words have one shingle; a null
doc_id has no part in the smallest id, so its row has the component of its
links or null; repeated rows have a row each; other columns pass through,
those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components

SHINGLE = 3
SEED = 42
BYTES = 8
DIFFERENT = 2              # bits
SHARED = BYTES - DIFFERENT  # positional bytes that a linked pair shares at least
PART = 1 << 17             # index entries in a part, about
NEAR = 128                 # entries of a list up to which all of its pairs are compared
PIECE = 1 << 16            # shingle hashes unpacked into bits at once

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str | None) -> np.ndarray:
    """XXH64 (seed 42) of the 3-word shingles of the lower-cased text, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()  # bytes split at ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start, end = (end - size).tolist(), end[min(SHINGLE, len(words)) - 1:].tolist()
    of = xxhash.xxh64_intdigest
    return np.array([of(line[s:e], SEED) for s, e in zip(start, end, strict=False)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 when it is set in over half of the hashes; zero for none."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), PIECE):
        part = hashes[i:i + PIECE].astype("<u8").view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, name: str = "fp") -> DataFrame:
    """Columns of docs but text, plus the fingerprint as a (signed) long."""

    def make(cols: dict[str, list]) -> dict:
        return {name: np.array([fingerprint(shingle_hashes(t)) for t in cols["text"]], np.uint64).view(np.int64)}

    return C.by_rows(docs, ["text"], f"{name} long", make, drop=["text"])


def _masks() -> list[tuple[int, int, int]]:
    """(mask of the two free bytes, shift of the one, shift of the other) of every list kind."""
    return [((0xFF << 8 * i) | (0xFF << 8 * j), 8 * i, 8 * j) for i, j in combinations(range(BYTES), 2)]


def _near_places() -> np.ndarray:
    """The patterns of one or two set bits in the 16 free ones."""
    one = [1 << i for i in range(16)]
    return np.array(one + [a | b for a, b in combinations(one, 2)], np.int64)


def index(prints: DataFrame, parts: int) -> DataFrame:
    """(part, kind, fp): every fingerprint under each choice of six positional bytes."""
    masks = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(~m & (1 << 64) - 1 if ~m & (1 << 63) == 0 else ~m).cast("long").alias("keep"))
                      for k, (m, _, _) in enumerate(_masks())])
    rows = prints.select("fp", F.explode(masks).alias("m")).select(
        F.pmod(F.xxhash64(F.col("fp").bitwiseAND(F.col("m.keep")), "m.kind"), F.lit(parts)).cast("int").alias("part"),
        F.col("m.kind").alias("kind"), "fp")
    return rows


def _list_pairs(fp: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows x < y of entries of one list whose fingerprints differ in at most DIFFERENT bits.

    fp, kind: entries ordered by list, then by the free bytes; no entry twice.
    """
    masks = np.array([m for m, _, _ in _masks()], np.uint64)[kind]
    key = fp & ~masks
    edge = np.ones(len(fp), bool)
    edge[1:] = (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])
    begin = np.flatnonzero(edge)
    size = np.diff(begin, append=len(fp))
    own = np.repeat(np.arange(len(begin)), size)
    out = []
    x = np.flatnonzero(size[own] <= NEAR)
    for step in range(1, NEAR):
        x = x[x + step < (begin + size)[own[x]]]
        if not len(x):
            break
        ok = np.bitwise_count(fp[x] ^ fp[x + step]) <= DIFFERENT
        out.append((x[ok], x[ok] + step))
    places = _near_places()
    free = np.array([(i, j) for _, i, j in _masks()], np.uint64)
    for g in np.flatnonzero(size > NEAR):
        at = np.arange(begin[g], begin[g] + size[g])
        i, j = free[kind[at[0]]]
        low = ((fp[at] >> i & np.uint64(255)) | (fp[at] >> j & np.uint64(255)) << np.uint64(8)).astype(np.int64)
        row = np.full(1 << 16, -1, np.int64)
        row[low] = at
        for p in places:
            y = row[low ^ p]
            ok = y > at
            out.append((at[ok], y[ok]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _least(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows is connected with."""
    low = np.arange(n)
    while True:
        before = low.copy()
        m = np.minimum(low[x], low[y])
        np.minimum.at(low, x, m)
        np.minimum.at(low, y, m)
        low = low[low]
        if (low == before).all():
            return low


def _over_parts(prints: DataFrame, pairs: Callable, part: int) -> DataFrame:
    """(a, b) longs that pairs(fp, kind) makes of the entries of each part of the index."""
    entries = prints.count() * len(_masks())

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fp, kind = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["kind"].to_numpy(np.int64)
        masks = np.array([m for m, _, _ in _masks()], np.uint64)[kind]
        order = np.lexsort((fp & masks, fp & ~masks, kind))
        fp, kind = fp[order], kind[order]
        x, y = pairs(fp, kind)
        return pd.DataFrame({"a": fp[x].view(np.int64), "b": fp[y].view(np.int64)})

    parts = max(1, entries // part)
    return index(prints, parts).groupBy("part").applyInPandas(meet, "a long, b long")


def links(prints: DataFrame, part: int = PART) -> DataFrame:
    """(a, b, shared): all pairs of distinct fingerprints at two bits or fewer, and the positional bytes they share.

    prints: (fp) distinct. A pair is tallied over the lists where it meets:
    C(shared, 6) of them, at least one.
    """
    found = _over_parts(prints, _list_pairs, part)
    tally = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).groupBy("a", "b").agg(F.count("*").alias("lists"))
    return tally.select("a", "b", F.when(F.col("lists") == BYTES - 1, BYTES - 1).otherwise(SHARED).alias("shared"))


def stars(prints: DataFrame, part: int = PART) -> DataFrame:
    """(a, b) links with the same components as links(), fewer than entries of the index."""

    def star(fp: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = _least(len(fp), *_list_pairs(fp, kind))
        y = np.flatnonzero(low != np.arange(len(fp)))
        return low[y], y

    return _over_parts(prints, star, part).distinct()


def near_duplicates(docs: DataFrame, part: int = PART) -> DataFrame:
    """Columns of docs but text, plus fingerprint (16 hex digits) and component_id (smallest linked doc_id).

    docs: (doc_id, text, ...).
    """
    C.prepare(docs.sparkSession)
    docs = docs.drop(*[c for c in ("fingerprint", "component_id") if c in docs.columns])
    rows = C.staged(fingerprints(docs, "_sh_fp"), "fingerprints")
    classes = C.staged(rows.groupBy(F.col("_sh_fp").alias("fp")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")), "classes")
    named = classes.join(components(stars(classes.select("fp"), part)).withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    named = C.staged(named, "roots")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    table = C.staged(named.join(least, "root").select(F.col("fp").alias("_sh_fp"), "n", "component_id"), "components")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return C.join_keyed(rows, table, "_sh_fp", total).select(
        *[c for c in docs.columns if c != "text"], F.lpad(F.lower(F.hex("_sh_fp")), 16, "0").alias("fingerprint"), "component_id")
