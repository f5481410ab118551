"""Language-model scores by a weighted backoff automaton.

Training tokens are counted over all training documents. Every word and every
n-gram seen at least twice (an absolute count, the same at every size) becomes
a state and an arc, so the automaton grows with the input; its arcs and failure
weights are tables keyed by a 64-bit hash and never on one machine. Absolute
discounting gives each arc its weight; what it leaves is the weight of the
state's failure arc to the state one word shorter, down to the root, where
every word has its add-0.1 probability from exact counts.

A token whose n-gram has an arc takes it; otherwise it takes the failure arc of
every state before it until a shorter one has an arc. So a text's score is its
score at the root plus, for each occurrence of an n-gram in the automaton, one
gain: the failure weight of its state, and its arc's weight less what the
failure path would have given. Occurrences are joined with the gains by key and
summed per document.

N-grams are counted in parts of the hash space of their state, to which tasks
send packed runs of (state, shorter n-gram, count): a part sees all arcs of a
state, so it drops those seen once and knows what is left for the failure arc.
States of very many arcs are spread over all parts and summed after. Looked-up
occurrences travel in the same way, as keys per run of texts and part, and
come back as sums per document of the run.

The most frequent keys (HEAD, HEAD_GRAMS) have their gains in every task, and
bitmaps of hashes that drop most keys without a row go along. Both only spare
rows of the lookup; the scores are the same without them.

Defined results: null, empty and blank texts have one token (the end); a null
id is never held out; repeated rows are learned from and scored each; without
training tokens every probability is that of an unknown word.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

WORDS = math.inf        # a finite value adds a relative floor: words from a frequency of 1/WORDS take part in longer n-grams
GRAMS = math.inf        # a finite value adds a relative floor: n-grams from 1/GRAMS become arcs
LEAST = 2               # words and n-grams seen this often take part, at every size
HEAD = 2_000_000        # words from a relative frequency of 1/HEAD have their counts in every task; others are joined
HEAD_GRAMS = 2_000_000  # the same for n-grams of each length
ORDER = 3
DISCOUNT = 0.75
ADD = 0.1
END = np.uint64(0x5851F42D4C957F2D)
FLUSH = 1_000_000       # keys gathered before a task passes on their counts
PART = 1 << 19          # training tokens to a part of the states, about
LOOK = 1 << 20          # rows of the automaton to a part of the lookup, about
BATCH_BYTES = 8 << 20   # bytes of an Arrow batch, which holds two runs
RUN_SLICES = 16         # slices of text whose lookups travel as one run for each part
FRAME = 32              # parts that a task sends on at once
HOT = 1 << 18           # a state seen this often has its arcs spread over all parts
OTHER = np.uint64(0x2545F4914F6CDD1D)  # stands for all words after a state that cannot be arcs
SLOTS = 20              # a bitmap has 2**SLOTS numbers of 64 bits


def held_out(doc_id: Column, parts: int = 10, part: int = 0) -> Column:
    """crc32 of the id as text, modulo parts, equals part; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts (END after each text) and the first token of each text (one more entry)."""
    w = C.Words(texts, lower=True)
    n = len(texts)
    first = np.concatenate([[0], np.cumsum(w.count + 1)])
    out = np.full(int(first[-1]), END, np.uint64)
    body = np.ones(len(out), bool)
    body[first[1:] - 1] = False
    out[body] = w.hashes()
    return out, first[: n + 1]


def _turn(n: int) -> int:
    """Bits by which the key of an n-gram's last n-1 words is turned before it is mixed with that of its first n-1."""
    return (14 * n - 11) % 64


def _join_keys(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    t = _turn(n)
    return a ^ (b << np.uint64(t) | b >> np.uint64(64 - t))


def grams_of(tokens: np.ndarray, first: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For n = 1..order, the key of the n-gram that starts at each token and whether it lies within the text."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(tokens))
    keys, ok = [tokens], [np.ones(len(tokens), bool)]
    for n in range(2, order + 1):
        keys.append(_join_keys(keys[-1], np.roll(keys[-1], -1), n))
        ok.append(left >= n)
    return keys, ok


def _bitmap(df: DataFrame) -> np.ndarray:
    """Bits of the hashes in column key: at most 2**SLOTS rows, whatever the input."""
    rows = df.groupBy(F.col("key").bitwiseAND(F.lit((1 << SLOTS) - 1)).alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, cast(shiftrightunsigned(key, 58) as int)))").alias("bits")).toArrow()  # Arrow, as a million Row objects do not fit
    out = np.zeros(1 << SLOTS, np.uint64)
    out[rows["slot"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _may_have(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return (bits[keys & np.uint64((1 << SLOTS) - 1)] >> (keys >> np.uint64(58)) & np.uint64(1)).astype(bool)


def _counted(df: DataFrame, keys: Callable[[list], np.ndarray]) -> DataFrame:
    """(key, c) over the rows of df; keys(texts) gives the keys of a run of texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (all_,) in _gathered(batches, lambda texts: (keys(texts),)):
            key, c = np.unique(all_, return_counts=True)
            yield pd.DataFrame({"key": key.view(np.int64), "c": c})
            del key, c, all_
            C.trimmed()

    return df.select("text").mapInPandas(count, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def _gathered(batches: Iterator[pd.DataFrame], make: Callable[[list], tuple]) -> Iterator[list[np.ndarray]]:
    """make(texts), a tuple of arrays, of runs of texts, joined until about FLUSH entries are held."""
    held, size = [], 0
    for b in batches:
        texts = b["text"].tolist()
        for s in C.text_slices(texts):
            held.append(make(texts[s]))
            size += len(held[-1][0])
            if size >= FLUSH:
                yield [np.concatenate(x) for x in zip(*held, strict=True)]
                held, size = [], 0
    if size:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _among(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key is one of sorted_keys."""
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)] == keys


def _keys_of(df: DataFrame) -> np.ndarray:
    return np.sort(df.select("key").toArrow()["key"].to_numpy().view(np.uint64))


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _order(*keys: np.ndarray) -> np.ndarray:
    """np.lexsort of arrays of small numbers, the last one first: packed with the place into one number, values are sorted faster than places."""
    n = len(keys[0])
    widths = [int(k.max()).bit_length() if n else 0 for k in keys]
    place = n.bit_length()
    if sum(widths) + place > 64:
        return np.lexsort(keys)
    packed = np.zeros(n, np.uint64)
    for k, w in zip(reversed(keys), reversed(widths), strict=True):
        packed = packed << np.uint64(w) | k.astype(np.uint64)
    packed = packed << np.uint64(place) | np.arange(n, dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << place) - 1)).astype(np.int64)


def _found_at(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """np.searchsorted, by the keys in order: neighbours find theirs in the cache."""
    order = np.argsort(keys)
    out = np.empty(len(keys), np.int64)
    out[order] = np.searchsorted(sorted_keys, keys[order])
    return out


def _runs(x: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _bounds(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    at = _runs(x)
    return zip(at, np.append(at, len(x))[1:], strict=True)


def _opened(table: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table[column].to_pylist()), kind)


ARCS = "kind int, key long, a long, b long, c long, seen long, used double"


def _arcs(docs: DataFrame, n: int, floor: float, total: int, states: np.ndarray, known: np.ndarray | None,
          hot: np.ndarray, discount: float) -> DataFrame:
    """Arcs of length n and their states (ARCS), by kind.

    0: an arc: its key, key b of its last n-1 words, count, and of its state
    how often it was seen and what its arcs use of that. 1: a state with arcs.
    2: an arc whose state a is in `hot`, without the state's figures. 3: a part
    of the figures of a hot state. states: bitmap of the n-grams one shorter;
    known: the words that may take part (None: the bitmap's).
    """
    parts = max(1, total // PART)
    shared = docs.sparkSession.sparkContext.broadcast((states, known, hot))

    def pairs(texts: list[str | None]) -> tuple:
        bits, words, _ = shared.value
        tokens, first = tokens_of(texts)
        key, ok = grams_of(tokens, first, n)
        state, follows = ok[n - 1] & _may_have(bits, key[n - 2]), _may_have(bits, np.roll(key[n - 2], -1))
        if words is not None:
            have = _among(words, tokens)
            for i in range(n - 1):
                state &= np.roll(have, -i)
            follows &= np.roll(have, 1 - n)
        at = np.flatnonzero(state)
        return key[n - 2][at], np.where(follows[at], np.roll(key[n - 2], -1)[at], OTHER)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for a, b in _gathered(batches, pairs):
            where = _part_of(np.where(_among(shared.value[2], a), C.mix(a + b), a), parts)
            # equal pairs stand together in order of the part, the state and both; two that others part are added up later
            bits = max(1, (parts - 1).bit_length())
            half = (64 - bits) // 2
            by = where.astype(np.uint64) << np.uint64(64 - bits)
            by |= C.mix(a) >> np.uint64(64 - half) << np.uint64(64 - bits - half)
            by |= C.mix(_join_keys(a, b, n)) >> np.uint64(bits + half)
            by = np.argsort(by)
            a, b, where = a[by], b[by], where[by]
            at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            c = np.diff(at, append=len(a)).astype("<u4")
            a, b, where = a[at], b[at], where[at]
            out = []
            for i, j in _bounds(where):
                run = _runs(a[i:j])
                out.append((where[i], a[i:j][run].tobytes(), np.diff(run, append=j - i).astype("<u4").tobytes(),
                            b[i:j].tobytes(), c[i:j].tobytes()))
            names = ["part", "states", "runs", "nexts", "counts"]
            for i in range(0, len(out), FRAME):  # frames of a few parts, as the JVM holds a frame whole
                yield pd.DataFrame(out[i:i + FRAME], columns=names)
            del a, b, c, where, at, by, out
            C.trimmed()

    def meet(table: pa.Table) -> pa.Table:
        C.trimmed()
        a = np.repeat(_opened(table, "states", "<u8"), _opened(table, "runs", "<u4"))
        b, c = _opened(table, "nexts", "<u8"), _opened(table, "counts", "<u4").astype(np.int64)
        by = np.argsort(_join_keys(a, b, n))  # first the pairs, then what is left by state
        a, b, c = a[by], b[by], c[by]
        start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        a, b, c = a[start], b[start], np.add.reduceat(c, start)
        by = np.argsort(a)
        a, b, c = a[by], b[by], c[by]
        at = _runs(a)
        own = np.repeat(np.arange(len(at)), np.diff(at, append=len(a)))
        arc = (c >= floor) & (b != OTHER)
        seen, used = np.add.reduceat(c, at), np.add.reduceat(np.where(arc, c - discount, 0.0), at)
        is_hot = _among(shared.value[2], a[at])
        state = np.flatnonzero((used > 0) | is_hot)
        arc = np.flatnonzero(arc)
        far, both = is_hot[own[arc]], len(arc) + len(state)
        none = np.arange(both) >= len(arc)  # rows of states
        gone = np.concatenate([far, np.zeros(len(state), bool)])
        join = lambda x, y, t: np.concatenate([x, y]).astype(t, copy=False)
        key = join(_join_keys(a[arc], b[arc], n), a[at][state], np.uint64).view(np.int64)
        blank = np.zeros(len(state), np.int64)
        return pa.table({
            "kind": pa.array(join(np.where(far, 2, 0), np.where(is_hot[state], 3, 1), np.int32)),
            "key": pa.array(key),
            "a": pa.array(join(a[arc].view(np.int64), blank, np.int64), mask=~gone),
            "b": pa.array(join(b[arc].view(np.int64), blank, np.int64), mask=none),
            "c": pa.array(join(c[arc], blank, np.int64), mask=none),
            "seen": pa.array(join(seen[own[arc]], seen[state], np.int64), mask=gone),
            "used": pa.array(join(used[own[arc]], used[state], np.float64), mask=gone)})

    rows = docs.select("text").mapInPandas(packed, "part long, states binary, runs binary, nexts binary, counts binary")
    return rows.groupBy("part").applyInArrow(meet, ARCS)


class Model:
    """Numbers of training tokens and words, and the tables of the automaton.

    counts: (key, c) of all words. gains: (n, key, c, gain) of the states whose
    failure weight and the arcs whose gain is not 0; an n-gram that is both has
    two rows, and what one occurrence adds is their sum.
    """

    def __init__(self, total: int, distinct: int, counts: DataFrame, shorter: DataFrame, arcs: DataFrame | None = None,
                 longest: str | None = None):
        self.total, self.distinct, self.counts, self.shorter = total, distinct, counts, shorter
        self.gains = shorter if arcs is None else shorter.unionByName(arcs)
        self.longest = longest  # folder of the longest arcs, the only gains of their length
        self.scale = math.log10(total + ADD * (distinct + 1))


def train(docs: DataFrame, words: float = WORDS, grams: float = GRAMS, order: int = ORDER,
          discount: float = DISCOUNT, hot: int = HOT) -> Model:
    """hot: a state seen this often (and in a share of 1/HEAD) has its arcs spread; no effect on the model."""
    spark = C.prepare(docs.sparkSession, BATCH_BYTES)
    counts = C.staged(_counted(docs, lambda texts: tokens_of(texts)[0]), "tokens")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    level = counts.where(F.col("c") >= max(LEAST, total / words)).select(
        "key", "c", ((F.col("c") + ADD) / (total + ADD * (distinct + 1))).alias("q"))
    known = _keys_of(level) if words < WORDS else None  # at most `words` rows
    floor = max(LEAST, total / grams)
    table = spark.createDataFrame([], "n int, key long, c long, gain double")
    longest = None
    for n in range(2, order + 1):
        many = _keys_of(level.where(F.col("c") >= max(hot, total / HEAD)))  # at most HEAD rows
        path = C.new_path(spark, f"raw{n}")
        raw = C.staged(_arcs(docs, n, floor, total, _bitmap(level), known, many, discount), path=path)
        spread = raw.where("kind = 3").groupBy("key").agg(F.sum("seen").alias("seen"), F.sum("used").alias("used"))
        arcs = raw.where("kind = 0").select("key", "b", "c", "seen", "used").unionByName(
            raw.where("kind = 2").select("key", "a", "b", "c").join(
                C.checked_broadcast(spread.withColumnRenamed("key", "a"), 24), "a").drop("a"))
        states = raw.where("kind = 1").select("key", "seen", "used").unionByName(spread.where("used > 0"))
        left = F.col("seen") - F.col("used")
        table = table.unionByName(C.staged(states.select(
            F.lit(n - 1).alias("n"), "key", F.col("seen").alias("c"), F.log10(left / F.col("seen")).alias("gain")), f"states{n - 1}"))
        rest = (F.col("c") - discount) / F.col("seen")
        q = rest + left / F.col("seen") * F.col("shorter")
        found = arcs.join(level.select(F.col("key").alias("b"), F.col("q").alias("shorter")), "b").select(
            "key", "c", q.alias("q"), F.log10(q * F.col("seen") / (left * F.col("shorter"))).alias("gain"))
        longest = C.new_path(spark, f"arcs{n}")
        found = C.staged(found if n < order else found.drop("q"), path=longest)
        C.discard(spark, path)
        arcs = found.select(F.lit(n).alias("n"), "key", "c", "gain")
        if n < order:
            table = table.unionByName(arcs)
            level = found.select("key", "c", "q")
    return Model(total, distinct, counts, table, arcs if order > 1 else None, longest)


FOUND = "run long, place int, doc_id long, n_tokens long, unknown long, logs double, gain double"


class Head:
    """The most frequent keys: count of a word (0 for longer ones) and gain."""

    def __init__(self, key: np.ndarray, c: np.ndarray, gain: np.ndarray):
        order = np.argsort(key)
        self.key, self.c, self.gain = key[order], c[order], gain[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key (-1: none)."""
        if not len(self.key):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(_found_at(self.key, keys), len(self.key) - 1)
        return np.where(self.key[at] == keys, at, -1)


def _heads(model: Model, head: int, head_grams: int) -> tuple[Head, Head]:
    """Of words (at most `head` rows) and of longer keys (at most `head_grams` of each length)."""
    top = model.counts.where(F.col("c") >= max(1, model.total / head)).join(
        model.gains.where("n = 1").select("key", "gain"), "key", "left").select(
            "key", "c", F.coalesce("gain", F.lit(0.0)).alias("gain")).toArrow()
    long = model.gains.where((F.col("n") > 1) & (F.col("c") >= max(1, model.total / head_grams))).toArrow()
    key, at, row = np.unique(long["key"].to_numpy().view(np.uint64), return_index=True, return_inverse=True)
    return (Head(top["key"].to_numpy().view(np.uint64), top["c"].to_numpy(), top["gain"].to_numpy()),
            Head(key, long["c"].to_numpy()[at], np.bincount(row, long["gain"].to_numpy(), len(key))))


def _looked_up(docs: DataFrame, table: DataFrame, lengths: list[int], shared) -> DataFrame:
    """One pass over the texts for n-grams of `lengths`: FOUND of every row of docs.

    docs: (doc_id, text); table: (key, c, gain), where c is of words only. A task
    numbers its runs of texts; a run sends its keys that are in no head to
    their parts, each part sends back sums by place in the run, and these
    meet the run's own sums (ids, tokens, head words, head gains) again.
    """
    parts = max(1, table.count() // LOOK)
    with_words = 1 in lengths
    kinds = "run long, near boolean, docs binary, sums binary"

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, longer, maps = shared.value
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            texts = b["text"].tolist()
            null = b["doc_id"].isna().to_numpy()
            ids = b["doc_id"].fillna(0).to_numpy(np.int64)
            for s in C.text_slices(texts, RUN_SLICES * C.SLICE_BYTES):
                key, own, near = [], [], []
                for piece in C.text_slices(texts[s]):
                    tokens, first = tokens_of(texts[s][piece])
                    begin = first[:-1]
                    doc = np.repeat(np.arange(len(begin), dtype=np.uint32), np.diff(first)) + np.uint32(piece.start)
                    keys, ok = grams_of(tokens, first, max(lengths))
                    n_far, base, gain = np.zeros(len(begin), np.int64), np.zeros(len(begin)), np.zeros(len(tokens))
                    for n in lengths:
                        at = np.flatnonzero(ok[n - 1])
                        if n > 1:
                            at = at[_may_have(maps[n], keys[n - 1][at])]
                        head = words if n == 1 else longer
                        row = head.find(keys[n - 1][at])
                        found = row >= 0
                        gain[at[found]] += head.gain[row[found]]
                        if n == 1:  # every token is a word
                            log = np.zeros(len(tokens))
                            log[found] = np.log10(words.c[row[found]] + ADD)
                            base, n_far = np.add.reduceat(log, begin), np.add.reduceat(~found, begin, dtype=np.int64)
                        at = at[~found]
                        key.append(keys[n - 1][at])
                        own.append(doc[at])
                    near.append((np.diff(first), n_far, base, np.add.reduceat(gain, begin)))
                key, own = np.concatenate(key), np.concatenate(own)
                where = _part_of(key, parts)
                by = _order(own, where)
                key, own, where = key[by], own[by], where[by]
                sums = b"".join(np.concatenate(x).tobytes() for x in zip(*near, strict=True))
                home = _part_of(C.mix(np.array([number], np.uint64)), parts)[0]
                out = [(home, number, True, ids[s].tobytes(), null[s].tobytes(), sums)]
                for i, j in _bounds(where):
                    run = _runs(own[i:j])
                    out.append((where[i], number, False, own[i:j][run].tobytes(), np.diff(run, append=j - i).astype("<u4").tobytes(),
                                key[i:j].tobytes()))
                yield pd.DataFrame(out, columns=["part", "run", "near", "docs", "runs", "keys"])
                number += 1
                del key, own, where, by, sums, out
                C.trimmed()

    def meet(rows: pa.Table, gains: pa.Table) -> pa.Table:
        C.trimmed()
        have, row = np.unique(gains["key"].to_numpy().view(np.uint64), return_inverse=True)
        c = np.bincount(row, gains["c"].to_numpy(), len(have))
        gain = np.bincount(row, gains["gain"].to_numpy(), len(have))
        log = np.where(c > 0, np.log10(c + ADD), 0.0)
        out = []
        for r in range(rows.num_rows):  # one run of texts at a time: the numbers of a whole part are many
            number, near, docs, runs, keys = (rows[k][r] for k in ("run", "near", "docs", "runs", "keys"))
            if near.as_py():
                out.append((number.as_py(), True, docs.as_py() + runs.as_py(), keys.as_py()))
                continue
            docs, runs, keys = (np.frombuffer(x.as_buffer(), t) for x, t in ((docs, "<u4"), (runs, "<u4"), (keys, "<u8")))
            at = np.minimum(_found_at(have, keys), max(0, len(have) - 1))
            hit = have[at] == keys if len(have) else np.zeros(len(keys), bool)
            if not hit.any():
                continue
            own, at = np.repeat(np.arange(len(docs)), runs)[hit], at[hit]
            some = _runs(own)
            values = (log, c > 0, gain) if with_words else (gain,)
            sums = [np.add.reduceat(x[at].astype(np.float64, copy=False), some) for x in values]
            out.append((number.as_py(), False, docs[own[some]].tobytes(), b"".join(x.tobytes() for x in sums)))
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table({k: pa.array(x, t) for k, t, x in zip(
            ("run", "near", "docs", "sums"), (pa.int64(), pa.bool_(), pa.binary(), pa.binary()), columns, strict=True)})

    def total(rows: pa.Table) -> pa.Table:
        C.trimmed()
        at = rows["near"].to_pylist().index(True)
        docs = rows["docs"][at].as_py()
        n = len(docs) // 9
        tokens, far = np.frombuffer(rows["sums"][at].as_py()[:16 * n], "<i8").reshape(2, n)
        base, near = np.frombuffer(rows["sums"][at].as_py()[16 * n:], "<f8").reshape(2, n)
        base, near, more = base.copy(), near.copy(), np.zeros(n)
        for r in range(rows.num_rows):
            if r != at:
                place = np.frombuffer(rows["docs"][r].as_buffer(), "<u4")  # each once
                sums = np.frombuffer(rows["sums"][r].as_buffer(), "<f8").reshape(-1, len(place))
                near[place] += sums[-1]
                if with_words:
                    base[place] += sums[0]
                    more[place] += sums[1]
        null = np.frombuffer(docs[8 * n:], "?")
        return pa.table({"run": pa.array(np.full(n, rows["run"][0].as_py(), np.int64)), "place": pa.array(np.arange(n, dtype=np.int32)),
                         "doc_id": pa.array(np.frombuffer(docs[:8 * n], "<i8"), mask=null), "n_tokens": pa.array(tokens),
                         "unknown": pa.array(far - more.astype(np.int64)), "logs": pa.array(base), "gain": pa.array(near)})

    rows = docs.mapInPandas(packed, "part long, run long, near boolean, docs binary, runs binary, keys binary")
    part = F.shiftrightunsigned(F.shiftrightunsigned("key", 32) * F.lit(parts).cast("long"), 32)
    back = rows.groupBy("part").cogroup(table.withColumn("part", part).groupBy("part")).applyInArrow(meet, kinds)
    return back.groupBy("run").applyInArrow(total, FOUND)


def scores(docs: DataFrame, parts: int = 10, part: int = 0, head: int = HEAD, head_grams: int = HEAD_GRAMS,
           order: int = ORDER, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    docs: (doc_id, text), read several times: its rows must come in the same
    order and partitions each time, as from a written table. Documents whose
    crc32(id) modulo parts equals part are held out of training. options: as
    of train().
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id"), parts, part))
    model = train(docs.where(~F.col("held_out")), order=order, **options)
    maps = {n: _bitmap(model.gains.where(F.col("n") == n)) for n in range(2, order + 1)}
    shared = spark.sparkContext.broadcast((*_heads(model, head, head_grams), maps))

    # the same texts come in the same runs in every pass: a row is known by its run and its place there
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    far = model.counts.select(F.lit(1).alias("n"), "key", "c", F.lit(0.0).alias("gain")).unionByName(
        model.gains.select("n", "key", F.lit(0).cast("long").alias("c"), "gain"))

    def pass_of(ns: list[int]) -> DataFrame:
        return C.staged(_looked_up(texts, far.where(F.col("n").isin(ns)).drop("n"), ns, shared), "found")

    more = pass_of([order]) if order > 1 else None
    if more is not None:  # the longest arcs have served
        C.discard(spark, model.longest)
        far = model.counts.select(F.lit(1).alias("n"), "key", "c", F.lit(0.0).alias("gain")).unionByName(
            model.shorter.select("n", "key", F.lit(0).cast("long").alias("c"), "gain"))
    out = pass_of(list(range(1, max(order, 2))))
    if more is not None:
        more = more.select("run", "place", *[F.col(c).alias(f"_{c}") for c in ("doc_id", "n_tokens", "gain")])
        same = F.col("_doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_n_tokens") == F.col("n_tokens"))
        out = out.join(more, ["run", "place"], "left").withColumn("gain", F.when(same, F.col("gain") + F.col("_gain")).otherwise(
            F.raise_error(F.lit("the documents came in another order in the second pass")).cast("double"))).drop(*more.columns[2:])
    out = out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    out = out.withColumn("held_out", held_out(F.col("doc_id"), parts, part))
    base = F.col("logs") + F.col("unknown") * math.log10(ADD) - F.col("n_tokens") * model.scale
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_tokens") - F.col("unknown")).alias("n_known"),
                      F.lit(int(model.total)).cast("long").alias("train_tokens"), F.round(base, 6).alias("base_score"),
                      F.round(base + F.col("gain"), 6).alias("score"))
