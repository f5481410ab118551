"""Shared helpers: numpy word tables for Arrow batches, staged tables, size-checked broadcasts."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from quire.session import checkpoint_dir, ship_package

# Bytes of text turned into numpy arrays at once; longer single texts go alone.
SLICE_BYTES = 1 << 18
# Bytes of an Arrow batch, which the JVM and the Python worker of a task both hold.
BATCH_BYTES = 2 << 20
# A side of a join is broadcast only when its counted rows fit into this.
BROADCAST_BYTES = 48 << 20

# Spark's setting for removing the shuffle files of an execution at its end.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_MUL = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93
_STEP_INV = pow(_STEP, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(cols or ("doc_id", "text")))


def prepare(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> SparkSession:
    """What every operator with Python tasks needs: shared folder known, package shipped, batches of bounded bytes."""
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    ship_package(spark)
    return spark


def new_path(spark: SparkSession, name: str) -> str:
    """A folder below spark.checkpoint.dir that no other table has."""
    return f"{checkpoint_dir(spark).rstrip('/')}/quire-llm/{uuid.uuid4().hex}-{name}"


def staged(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """Write `df` once as Parquet below spark.checkpoint.dir (to `path` if given) and read it back.

    Cuts the lineage into files that every executor sees, so a lost executor
    costs its running tasks only. The shuffle files of the write go when it has
    ended: nothing reads them after that.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    with cleaned(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is run inside go when it has ended."""
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN, before)


def counted(df: DataFrame) -> int:
    """Rows of df; the shuffle files of the count go."""
    with cleaned(df.sparkSession):
        return df.count()


def only_row(df: DataFrame):
    """The row of a table of one row; the shuffle files of the query go."""
    with cleaned(df.sparkSession):
        return df.first()


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """staged() for tables that are removed together at the end of a `with` block, when nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, name: str = "table") -> DataFrame:
        self.paths.append(new_path(self.spark, name))
        return staged(df, name, self.paths[-1])

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            discard(self.spark, path)
        self.paths = []


def checked_broadcast(df: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`broadcast(df)` when its counted rows fit the bound, else `df` (a shuffle join)."""
    return F.broadcast(df) if counted(df) * row_bytes <= max_bytes else df


def join_keyed(df: DataFrame, table: DataFrame, key: str, total: int, heavy: int = 1000) -> DataFrame:
    """Left join of df with table (key, n, ...) on a key whose hot values df may hold in any share.

    n: rows of df with that key, total: all rows of df. Keys with more than
    1/heavy of the rows, fewer than `heavy` of them, are broadcast; the other
    rows of df, which have no hot key, are joined by shuffle. n is dropped.
    Keys match null-safely.
    """
    hot = F.broadcast(table.where(F.col("n") * heavy > total).drop("n").withColumnRenamed(key, "_hot_key"))
    rest = table.where(F.col("n") * heavy <= total).drop("n").withColumnRenamed(key, "_key")
    is_hot = F.col(key).eqNullSafe(F.col("_hot_key"))
    return df.join(hot, is_hot).drop("_hot_key").unionByName(
        df.join(hot.select("_hot_key"), is_hot, "left_anti").join(rest, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key"))


def trimmed() -> None:
    """Give freed memory of this Python worker back to the system (workers are reused by later stages)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pow2_at_least(n: int) -> int:
    return 1 << max(0, int(n) - 1).bit_length()


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(kind: str, step: int, n: int) -> np.ndarray:
    have = _POWERS.get(kind)
    if have is None or len(have) < n:
        p = np.full(max(n, SLICE_BYTES + 65536), step, np.uint64)
        p[0] = 1
        have = np.cumprod(p, dtype=np.uint64)
        if len(have) <= 4 * SLICE_BYTES:  # a single huge text does not stay in the worker's memory
            _POWERS[kind] = have
    return have


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a list of texts, as flat numpy arrays.

    raw: UTF-8 bytes of all texts, one newline after each; start, end: byte
    offsets of the words; first: index of the first word of each text (one
    more entry at the end); count: words per text.
    """

    def __init__(self, texts: list[str | None], lower: bool = False):
        enc = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.sizes = np.fromiter(map(len, enc), np.int64, len(enc))
        self.base = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        self.raw = np.frombuffer(b"\n".join(enc) + b"\n" if enc else b"", np.uint8)
        if lower:
            self.raw = _LOWER[self.raw]
        inside = ~_SPACE[self.raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.base)
        self.count = np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: polynomial over random byte values, then mixed."""
        n = len(self.raw)
        if not n:
            return np.zeros(0, np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.raw] * _powers("up", _STEP, n)[:n], out=total[1:])
        h = (total[self.end] - total[self.start]) * _powers("down", _STEP_INV, n)[self.start]
        return mix(h + (self.end - self.start).astype(np.uint64) * _MUL)

    def ngrams(self, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-word windows inside one text, and the window's first word."""
        at = windows(self.first, self.count, n)
        return roll(h, at, n), at


def windows(first: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Word indexes at which an n-word window inside one text starts."""
    have = np.maximum(count - n + 1, 0)
    return spans(first[:-1], have)


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (length[0] of them), then the same from start[1], ..."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(total)


def roll(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hash of h[at], ..., h[at+n-1]."""
    out = np.zeros(len(at), np.uint64)
    for i in range(n):
        out = (out ^ h[at + i]) * np.uint64(0xFF51AFD7ED558CCD)
        out = out ^ (out >> np.uint64(32))
    return mix(out)


def slices(sizes: Iterable[int], limit: int = SLICE_BYTES) -> Iterator[slice]:
    """Cut a batch into runs of texts of at most `limit` bytes (one longer text goes alone)."""
    begin, held = 0, 0
    i = -1
    for i, s in enumerate(sizes):
        if held and held + s > limit:
            yield slice(begin, i)
            begin, held = i, 0
        held += s
    if i >= begin:
        yield slice(begin, i + 1)


def text_slices(texts: list[str | None], limit: int = SLICE_BYTES) -> Iterator[slice]:
    return slices((len(t) if t else 0 for t in texts), limit)


def by_rows(df: DataFrame, needs: list[str], added: str, make: Callable[[dict[str, list]], dict],
            drop: Iterable[str] = ()) -> DataFrame:
    """Append columns computed from the columns `needs` of a run of rows.

    added: DDL of the new columns; make({column: values}) returns a list or
    array for each of them. The other columns pass through as they are, in
    Arrow, but for those in `drop`; a column of `df` with the name of a new one
    is replaced. needs[0] is a text; batches are cut into runs of bounded size
    by it before `make` sees them.
    """
    prepare(df.sparkSession)
    new = StructType.fromDDL(added)
    base = df.drop(*[f.name for f in new.fields if f.name in df.columns])
    gone = set(drop)
    schema = StructType([f for f in base.schema.fields if f.name not in gone] + new.fields)
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in new.fields]
    stay = [i for i, f in enumerate(base.schema.fields) if f.name not in gone]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(needs[0]))), 0)
            for s in slices(sizes.to_pylist()):  # only a slice at a time becomes Python objects
                part = b.slice(s.start, s.stop - s.start)
                made = make({k: part.column(b.schema.get_field_index(k)).to_pylist() for k in needs})
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in stay] + [pa.array(made[k], type=t) for k, t in kinds], names=names)
                del part, made
            del b
            trimmed()

    return base.mapInArrow(run, schema)


def by_text(df: DataFrame, added: str, make: Callable[[list[str | None]], dict], text: str = "text") -> DataFrame:
    """by_rows() for columns computed from one text column."""
    return by_rows(df, [text], added, lambda cols: make(cols[text]))
