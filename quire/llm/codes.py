"""Vector code compression with Drake-Hamerly adaptive bounds.

A vector of integers floor(256 x) is cut into equal parts; each part position
has a codebook, trained by a fixed number of Lloyd rounds that start at the
vectors of the smallest ids. Everything that decides is integer arithmetic.

Every pass over the vectors writes, for each part, its b closest entries in
order of distance, a lower bound of the distance to each of them but the first,
and one outer bound below the distance to all others. In the next pass bounds
shrink by how far their entry has moved (the outer bound by the largest move),
and the distance to the part's own entry is computed anew. A part whose
distance is below all bounds keeps its entry. If only bounds inside the list are
reached, the list up to the last one reached is verified with integer
distances; if the outer bound is reached, all entries are. b adapts: each batch
keeps as many entries as nine in ten of its parts needed, within limits; entries
that are cut off go into the outer bound. Bounds are stored as half-precision
floats rounded down, so a bound never promises too much; equal distances are
never certain and go to the lower index by the verification.

Sums and counts of the entries are added up by Spark; the codebooks, of a fixed
size, are what the driver holds and broadcasts.

Defined results: rows with a null vector, or one that holds nulls, NaN or
infinities, are dropped, as are empty vectors and those of another length than
the vector of the smallest kept id; of several vectors of one id the smallest
in array order starts a codebook; a null id starts none and is coded like any
other; fewer than 64 ids make smaller codebooks; repeated rows count each;
without rows the result is empty. A length that the number of parts does not
divide is an error. Components beyond 2^26 in size are worked with in Python
integers, up to 2^62; an error beyond a long fails the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
START_LIST = ENTRIES // 8   # b of the first pass
LEAST_LIST, MOST_LIST = ENTRIES // 16, ENTRIES // 4
ENOUGH = 0.9                # share of parts whose needs decide the next b
SMALL = 1 << 26             # components below this in size stay in 64-bit arithmetic
BATCH = 2048                # vectors worked on at once
LEARNED = "decimal(38,0)"

STATE = "x binary, ids binary, low binary"


def kept(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and finite, with the integer components as array<long> in `vector`."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    ok = F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))
    return vectors.where(ok).withColumn(vector, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def _exact(x: np.ndarray) -> np.ndarray:
    """Integers as they are, or as Python integers when products might not fit."""
    return x.astype(object) if x.size and max(abs(int(x.min())), abs(int(x.max()))) >= SMALL else x


def _pack(x: np.ndarray) -> list[bytes]:
    """Rows of int64 as bytes of the narrowest width that holds them all."""
    size = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    return [r.tobytes() for r in x.astype("<i2" if size < 1 << 15 else "<i4" if size < 1 << 31 else "<i8")]


def _unpack(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(rows), dim), np.int64)
    width = np.array([len(r) // dim for r in rows])
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        out[at] = np.frombuffer(b"".join(rows[i] for i in at), f"<i{w}").reshape(-1, dim)
    return out


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of x (n, d) to entries (k, d), or of x to entries (n, k, d), exactly."""
    diff = x[:, None, :] - entries
    return (diff * diff).sum(axis=-1)


def _down(x: np.ndarray) -> np.ndarray:
    """As half-precision floats that are not larger."""
    with np.errstate(over="ignore"):
        h = np.minimum(x, 60000.0).astype(np.float16)
    over = h.astype(np.float64) > x
    h[over] = np.nextafter(h[over], np.float16(-np.inf))
    h[np.isinf(x) & (x > 0)] = np.inf
    return h


def _root(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


SLACK = 1e-9  # more than what square roots and sums of doubles can be off by, relatively


class Lists:
    """The state of a part position for n parts: ordered ids (n, b) and bounds (n, b), the last of them the outer one.

    low[:, t] bounds the entry at place t + 1; low[:, b - 1] all entries off the list.
    """

    def __init__(self, ids: np.ndarray, low: np.ndarray):
        self.ids, self.low = ids, low


def closest(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[Lists, np.ndarray]:
    """Lists of the b closest entries by full comparison, and the squared distance to the first."""
    k = len(entries)
    b = min(b, k)
    d = distances(x, entries)
    order = np.lexsort((np.broadcast_to(np.arange(k), d.shape), d), axis=1) if d.dtype != object else np.argsort(d * k + np.arange(k), axis=1)
    near = np.take_along_axis(d, order[:, :b + 1], axis=1)
    low = np.full((len(x), b), np.inf)
    low[:, :near.shape[1] - 1] = _root(near[:, 1:]) * (1 - SLACK)
    return Lists(order[:, :b].astype(np.uint8), _down(low)), near[:, 0]


def moved(x: np.ndarray, lists: Lists, entries: np.ndarray, move: np.ndarray) -> tuple[Lists, np.ndarray, np.ndarray]:
    """Lists after the entries moved, squared distance to the first, and how far down each list was needed.

    entries: as they are now; move: upper bounds of how far each has moved.
    Needed: 1 when the part kept its entry by bounds alone, t when places up to
    t were verified, b + 1 when all entries were.
    """
    n, b = lists.ids.shape
    own = distances(x, entries[lists.ids[:, :1]])[:, 0]
    reach = _root(own) * (1 + SLACK)
    fall = np.concatenate([move[lists.ids[:, 1:]], np.full((n, 1), move.max())], axis=1)
    low = lists.low.astype(np.float64) - fall
    low -= SLACK * np.where(np.isinf(low), 0.0, np.abs(low) + fall)
    hit = low <= reach[:, None]
    outer = hit[:, -1]
    last = np.where(hit[:, :-1].any(axis=1), b - 1 - np.argmax(hit[:, :-1][:, ::-1], axis=1), 0) if b > 1 else np.zeros(n, np.int64)
    needed = np.where(outer, b + 1, last + 1)
    ids, best = lists.ids.copy(), own.copy()
    for t in np.unique(last[~outer & (last > 0)]):  # integers decide among the places up to t
        at = np.flatnonzero(~outer & (last == t))
        cand = ids[at, :t + 1].astype(np.int64)
        d = distances(x[at], entries[cand])
        order = np.lexsort((cand, d), axis=1) if d.dtype != object else np.argsort(d * len(entries) + cand, axis=1)
        d = np.take_along_axis(d, order, axis=1)
        ids[at, :t + 1] = np.take_along_axis(cand, order, axis=1)
        best[at] = d[:, 0]
        low[at, :t] = _root(d[:, 1:]) * (1 - SLACK)
    out = Lists(ids, _down(low))
    at = np.flatnonzero(outer)
    if len(at):
        full, best[at] = closest(x[at], entries, b)
        out.ids[at], out.low[at] = full.ids, full.low
    return out, best, needed


def shorter(lists: Lists, b: int) -> Lists:
    """The first b places; what is cut off goes into the outer bound."""
    if b >= lists.ids.shape[1]:
        return lists
    low = lists.low[:, :b].copy()
    low[:, b - 1] = lists.low[:, b - 1:].min(axis=1)
    return Lists(lists.ids[:, :b], low)


def adapted(needed: np.ndarray, b: int) -> int:
    """The next b: as many places as ENOUGH of the parts needed; twice as many if that was more than there were."""
    if not needed.size:
        return b
    want = int(np.quantile(needed, ENOUGH, method="higher"))
    return int(np.clip(2 * b if want > b else want, LEAST_LIST, MOST_LIST))


class Codebooks:
    """Entries (part, entry, component) and upper bounds of how far each moved in the last round."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None = None):
        self.entries = entries
        self.move = None
        if before is not None:
            diff = entries.astype(object) - before.astype(object)
            self.move = np.sqrt((diff * diff).sum(axis=-1).astype(np.float64)) * (1 + SLACK)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def assign(x: np.ndarray, books: Codebooks, ids: list[bytes] | None, low: list[bytes] | None, b: int = START_LIST
           ) -> tuple[list[bytes], list[bytes], np.ndarray, np.ndarray]:
    """State of vectors x (n, parts, d) as bytes, their codes (n, parts) and errors, from the state before (None: none)."""
    n, parts = x.shape[:2]
    out_ids, out_low = np.empty(n, object), np.empty(n, object)
    codes, error = np.empty((n, parts), np.uint8), np.zeros(n, object)
    x, entries = _exact(x), _exact(books.entries)
    if x.dtype != entries.dtype:
        x, entries = x.astype(object), entries.astype(object)
    length = np.array([len(i) // parts for i in ids]) if ids else np.zeros(n, np.int64)
    for had in np.unique(length):
        at = np.flatnonzero(length == had)
        new, needs = [], []
        if had:
            was_ids = np.frombuffer(b"".join(ids[i] for i in at), np.uint8).reshape(len(at), parts, had)
            was_low = np.frombuffer(b"".join(low[i] for i in at), "<f2").reshape(len(at), parts, had)
        for p in range(parts):
            if had:
                lists, best, needed = moved(x[at, p], Lists(was_ids[:, p], was_low[:, p]), entries[p], books.move[p])
                needs.append(needed)
            else:
                lists, best = closest(x[at, p], entries[p], b)
            new.append(lists)
            codes[at, p] = lists.ids[:, 0]
            error[at] += best
        if had:
            keep = min(adapted(np.concatenate(needs), had), had)
            new = [shorter(s, keep) for s in new]
        both = [np.stack([getattr(s, k) for s in new], axis=1) for k in ("ids", "low")]
        out_ids[at] = [r.tobytes() for r in both[0]]
        out_low[at] = [r.astype("<f2").tobytes() for r in both[1]]
    return list(out_ids), list(out_low), codes, error


def _first_entries(rows: DataFrame, vec_id: str, vector: str, parts: int, k: int) -> np.ndarray | None:
    """The entries that the k smallest ids start with, (parts, entries, d): a table of k rows."""
    least = [r[0] for r in rows.where(F.col(vec_id).isNotNull()).select(vec_id).distinct().orderBy(vec_id).limit(k).collect()]
    first = rows.where(F.col(vec_id) <= least[-1]).groupBy(vec_id).agg(F.min(vector).alias("v")).orderBy(vec_id).collect() if least else []
    if not first:  # only null ids: their smallest vector decides the length and starts the codebooks
        first = rows.select(F.col(vector).alias("v")).orderBy("v").limit(1).collect()
        if not first:
            return None
    dim = len(first[0].v)
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    v = np.array([r.v for r in first if len(r.v) == dim], np.int64)
    return np.ascontiguousarray(v.reshape(len(v), parts, dim // parts).swapaxes(0, 1))


def _learned(state: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round: floor of the mean of the parts of each entry, added up by (part, entry)."""
    parts, k, d = books.entries.shape

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((parts, k, d), object), np.zeros((parts, k), np.int64)
        for b in batches:
            x = _exact(_unpack(b["x"].tolist(), parts * d)).reshape(-1, parts, d)
            code = np.array([np.frombuffer(i, np.uint8)[:: len(i) // parts] for i in b["ids"]], np.int64).reshape(-1, parts)
            for p in range(parts):
                part = np.zeros((k, d), x.dtype)
                np.add.at(part, code[:, p], x[:, p])
                total[p] += part
                n[p] += np.bincount(code[:, p], minlength=k)
        p, j = np.nonzero(n)
        if not len(p):
            return
        yield pd.DataFrame({"p": p, "j": j, "n": n[p, j], "s": [[str(v) for v in total[q, e]] for q, e in zip(p, j, strict=True)]})

    sums = state.select("x", "ids").mapInPandas(add, "p int, j int, n long, s array<string>").groupBy("p", "j").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i].cast(LEARNED)) for i in range(d)]).alias("s"))
    entries = books.entries.astype(object)
    for r in sums.collect():  # one row for each entry of the codebooks
        entries[r.p, r.j] = [int(v) // r.n for v in r.s]
    return Codebooks(entries.astype(np.int64), books.entries)


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, start: int = START_LIST) -> tuple[DataFrame, Codebooks | None]:
    """Columns of the kept rows but the vector, plus code, error and the codebooks' digest; and the codebooks.

    Each pass reads the table of the pass before and writes its own.
    """
    spark = C.prepare(vectors.sparkSession)
    vectors = vectors.drop(*[c for c in ("code", "error", "codebooks_sha256") if c in vectors.columns and c not in (vec_id, vector)])
    rows = kept(vectors, vector)
    books = None
    first = _first_entries(rows, vec_id, vector, parts, entries)
    rest = [c for c in vectors.columns if c != vector]
    if first is None:
        empty = rows.select(*rest, F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256"))
        return empty.where("false"), None
    books = Codebooks(first)
    dim = parts * first.shape[2]
    made = rows.where(F.size(vector) == dim).select(*[F.col(c).alias(f"_vc_{i}") for i, c in enumerate(rest)], F.col(vector).alias("v"))
    for r in range(rounds + 1):
        shared = spark.sparkContext.broadcast(books)
        had, last = r > 0, r == rounds

        def run(batches: Iterator[pa.RecordBatch], shared=shared, had=had, last=last) -> Iterator[pa.RecordBatch]:
            books = shared.value
            for batch in batches:
                for i in range(0, batch.num_rows, BATCH):
                    b = batch.slice(i, BATCH)
                    if had:
                        col = lambda c, b=b: b.column(b.schema.get_field_index(c)).to_pylist()
                        x, state = _unpack(col("x"), dim), (col("ids"), col("low"))
                    else:
                        x, state = np.asarray(b.column(b.schema.get_field_index("v")).flatten(), np.int64).reshape(-1, dim), (None, None)
                    ids, low, codes, error = assign(x.reshape(len(x), parts, -1), books, *state, start)
                    stay = [b.column(k) for k in range(len(rest))]
                    if last:
                        new = [pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(list(map(int, error)), pa.int64())]
                    else:
                        new = [pa.array(v, pa.binary()) for v in (_pack(x), ids, low)]
                    yield pa.RecordBatch.from_arrays(stay + new, names=names)

        schema = ", ".join(f"`_vc_{i}` {made.schema[f'_vc_{i}'].dataType.simpleString()}" for i in range(len(rest)))
        schema = f"{schema}, " * bool(rest) + ("code string, error long" if last else STATE)
        names = [f"_vc_{i}" for i in range(len(rest))] + (["code", "error"] if last else ["x", "ids", "low"])
        made = C.staged(made.mapInArrow(run, schema), f"pass-{r}")
        if not last:
            books = _learned(made, books)
    return made.select(*[F.col(f"_vc_{i}").alias(c) for i, c in enumerate(rest)], "code", "error",
                       F.lit(books.sha256()).alias("codebooks_sha256")), books


def with_label_error(coded: DataFrame, label: str | Column = "label") -> DataFrame:
    """Adds label_error: the errors of all rows of the same label (nulls are one label), in place of the label."""
    coded = coded.withColumnRenamed(label, "_vc_label") if isinstance(label, str) else coded.withColumn("_vc_label", label)
    sums = coded.groupBy("_vc_label").agg(F.count("*").alias("n"), F.sum("error").alias("label_error"))
    sums = C.staged(sums, "labels")
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return C.join_keyed(coded, sums, "_vc_label", total).drop("_vc_label")
