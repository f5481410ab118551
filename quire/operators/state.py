"""Run state as tables: feed marks, generation history and the two caches.

Keyed tables are latest-wins: a change set is unioned with the current rows
and one row per key survives (`max_by` on a version), which aggregates
partially map-side, so a hot key never gathers in one task. Tables are kept
as parquet parts under the shared state root; a run's parts become visible
together, when its manifest is published, or not at all.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import fs, session

HISTORY_COLS = ["id", "feed_url", "last_processed_at", "created_at"]
FEED_COLS = ["url", "title", "last_processed_at"]


def latest_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the row with the greatest `order` tuple."""
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    agg = F.max_by(F.struct(*rest), ordering).alias("_row")
    return df.groupBy(*keys).agg(agg).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def upsert(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """INSERT OR REPLACE: a change replaces the current row with the same key."""
    cols = current.columns
    both = (current.select(*cols, F.lit(0).alias("_v"))
            .unionByName(changes.select(*cols, F.lit(1).alias("_v"))))
    return latest_wins(both, keys, ["_v"]).select(*cols)


# --- generation history ---------------------------------------------------

def latest_marks(history: DataFrame) -> DataFrame:
    """Per feed, the mark of its newest run (ties: greater id)."""
    return (history.groupBy("feed_url")
            .agg(F.max_by("last_processed_at", F.struct("created_at", "id")).alias("last_processed_at")))


def latest_generation_time(history: DataFrame) -> DataFrame:
    return history.agg(F.max("created_at").alias("created_at"))


def delete_latest_generation(history: DataFrame) -> DataFrame:
    """Drop every row of the newest run (all feeds with the global max created_at)."""
    newest = F.broadcast(latest_generation_time(history))  # one row by construction
    return history.join(newest, "created_at", "left_anti").select(*history.columns)


def append_history(history: DataFrame, marks: DataFrame, created_at: int) -> DataFrame:
    """Rows (feed_url, last_processed_at) of one run, sharing `created_at`.

    Ids grow past every existing id (the AUTOINCREMENT contract): the current
    maximum is a scalar, and the new ids come from a distributed sort by URL,
    so no step gathers the run into one task.
    """
    base = history.agg(F.max("id")).first()[0] or 0
    return history.select(*HISTORY_COLS).unionByName(history_rows(marks, created_at, base))


def history_rows(marks: DataFrame, created_at: int, base_id: int) -> DataFrame:
    """The history rows of one run (ids after `base_id`, one shared created_at)."""
    return (marks.select("feed_url", "last_processed_at").orderBy("feed_url")
            .select((F.lit(base_id + 1) + F.monotonically_increasing_id()).cast("long").alias("id"),
                    "feed_url", "last_processed_at", F.lit(created_at).cast("long").alias("created_at")))


def history_orphans(history: DataFrame, feeds: DataFrame) -> DataFrame:
    """History rows whose feed has no row in the feed table (declared key)."""
    return history.join(feeds.select(F.col("url").alias("feed_url")), "feed_url", "left_anti")


def feed_lookup(urls: DataFrame, feeds: DataFrame) -> DataFrame:
    """Point lookups of many feed URLs at once (left join, NULL when unknown)."""
    return urls.join(feeds, urls["feed_url"] == feeds["url"], "left").drop("url")


# --- state tables: parts that a commit makes visible -----------------------------

BUCKETS = 16  # folders a keyed table's parts are laid out in, by hash of the first key


def bucket_of(key: str | Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key) if isinstance(key, str) else key), F.lit(buckets)).cast("int")


class Change:
    """The parts that one run writes; nothing of it is visible before `commit`.

    All tables of a run go into folders of one commit number, which the run's
    manifest names. A run that dies before its commit leaves folders that no
    manifest lists, and its repetition overwrites them; a run whose manifest
    exists is finished and need not write anything.
    """

    def __init__(self, store: StateStore, run_id: str, n: int, live: dict[str, list[dict]]):
        self.store, self.run_id, self.n = store, run_id, n
        self.live = {t: list(parts) for t, parts in live.items()}

    def append(self, table: str, df: DataFrame, bucket_by: str | None = None) -> None:
        """Add a part; bucket_by: the key by whose hash its rows are laid out."""
        path = self.store.path(table, self.n)
        if bucket_by:
            laid = df.withColumn("_bucket", bucket_of(bucket_by, self.store.buckets))
            laid.hint("rebalance", F.col("_bucket")).write.mode("overwrite").partitionBy("_bucket").parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        self.live[table] = [*self.live.get(table, []), {"n": self.n, "by": bucket_by}]

    def replace(self, table: str, df: DataFrame, bucket_by: str | None = None) -> None:
        """A part that stands for the whole table from this commit on."""
        self.append(table, df, bucket_by)
        self.live[table] = self.live[table][-1:]

    def commit(self, info: dict | None = None) -> None:
        """Publish the manifest: the one step that makes the parts visible, all or none."""
        text = json.dumps({"n": self.n, "run": self.run_id, "buckets": self.store.buckets, "live": self.live, "info": info or {}})
        name = f"{self.n:012d}.{quote(self.run_id, safe='')}"
        if not fs.publish(self.store.spark, os.path.join(self.store.commits, name), text):
            raise RuntimeError(f"commit {self.n} exists: another writer used {self.store.root}")


class StateStore:
    """Run-state tables under one root (a shared folder on a cluster).

    `<root>/<table>/_seq=<n>/` holds what commit n wrote of a table and
    `<root>/_commits/<n>.<run id>` is its manifest, written last: the live
    parts of every table after it, and a few figures of the run. Readers take
    the newest manifest and read the parts it names, nothing else; parts are
    never changed once a manifest names them. A run appends only the rows it
    changed; a keyed table is read as the latest row per key (greatest commit).
    Parts of keyed tables are laid out in buckets by the hash of their key, so
    a reader of some keys prunes to their folders. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root or session.state_dir(spark)
        self.commits = os.path.join(self.root, "_commits")
        last = self._manifest()
        self.buckets = last["buckets"] if last else buckets

    def path(self, table: str, n: int) -> str:
        return os.path.join(self.root, table, f"_seq={n}")

    def _names(self) -> list[str]:
        return sorted(n for n in fs.list_names(self.spark, self.commits) if not n.startswith("."))

    def _manifest(self, name: str | None = None) -> dict | None:
        names = self._names() if name is None else [name]
        return json.loads(fs.read_text(self.spark, os.path.join(self.commits, names[-1]))) if names else None

    def committed(self, run_id: str) -> dict | None:
        """The manifest of a finished run, None when it did not commit."""
        done = [n for n in self._names() if n.split(".", 1)[1] == quote(run_id, safe="")]
        return self._manifest(done[-1]) if done else None

    def runs(self) -> list[str]:
        return [unquote(n.split(".", 1)[1]) for n in self._names()]

    def begin(self, run_id: str | None = None) -> Change:
        last = self._manifest()
        return Change(self, run_id or uuid.uuid4().hex, last["n"] + 1 if last else 0, last["live"] if last else {})

    def _live(self, table: str) -> list[dict]:
        last = self._manifest()
        return last["live"].get(table, []) if last else []

    def parts(self, table: str) -> list[int]:
        """Commit numbers of the live parts."""
        return [p["n"] for p in self._live(table)]

    def live_parts(self, table: str) -> int:
        return len(self._live(table))

    def _scan(self, table: str, schema: str, parts: list[dict]) -> DataFrame:
        """Rows of some parts with `_seq`, and `_bucket` when they have one."""
        frames = []
        for bucketed in (True, False):
            dirs = [self.path(table, p["n"]) for p in parts if bool(p["by"]) == bucketed]
            if dirs:
                full = f"{schema}, _seq long" + ", _bucket int" * bucketed
                df = self.spark.read.schema(full).option("basePath", os.path.join(self.root, table)).parquet(*dirs)
                frames.append(df if bucketed else df.withColumn("_bucket", F.lit(None).cast("int")))
        if not frames:
            return self.spark.createDataFrame([], f"{schema}, _seq long, _bucket int")
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def rows(self, table: str, schema: str) -> DataFrame:
        """Every live row, with its `_seq`."""
        return self._scan(table, schema, self._live(table)).drop("_bucket")

    def read(self, table: str, schema: str, keys: list[str] | None = None) -> DataFrame:
        """The table as of now: latest row per key, or every row of an append-only table."""
        r = self.rows(table, schema)
        if keys:
            r = latest_wins(r, keys, ["_seq"])
        return r.drop("_seq")

    def read_for(self, table: str, schema: str, keys: list[str], wanted: DataFrame, key: str | None = None) -> DataFrame:
        """The latest row of each of `keys` whose `key` (default: the first) is in `wanted`.

        First the key columns alone are read, from the buckets of the wanted
        keys, and tell which commit holds each key's latest row; then the
        other columns are read from those buckets of those commits.
        """
        key = key or keys[0]
        live = self._live(table)
        if not live:
            return self.spark.createDataFrame([], schema)
        names = {p.split()[0]: " ".join(p.split()[1:]) for p in schema_parts(schema)}
        want = wanted.select(key).distinct()
        buckets = [r.b for r in want.select(bucket_of(key, self.buckets).alias("b")).distinct().collect()]  # no more than there are buckets
        near = F.col("_bucket").isNull() | F.col("_bucket").isin(buckets)
        found = self._scan(table, ", ".join(f"{k} {names[k]}" for k in keys), live).where(near).join(
            session.bounded_broadcast(want), key, "left_semi")
        latest = session.materialize(found.groupBy(*keys).agg(F.max("_seq").alias("_seq")))
        used = {r[0] for r in latest.select("_seq").distinct().collect()}  # no more than there are live parts
        rows = self._scan(table, schema, [p for p in live if p["n"] in used]).where(near)
        return rows.join(session.bounded_broadcast(latest), [*keys, "_seq"]).select(*names)

    def append(self, table: str, df: DataFrame, bucket_by: str | None = None) -> int:
        """A commit of one part."""
        change = self.begin()
        change.append(table, df, bucket_by)
        change.commit()
        return change.n

    def compact(self, table: str, df: DataFrame, bucket_by: str | None = None) -> int:
        """A commit that makes `df` (usually `read(...)` of the table) the whole table."""
        change = self.begin()
        change.replace(table, df, bucket_by)
        change.commit()
        return change.n

    def maybe_compact(self, table: str, schema: str, keys: list[str] | None, max_parts: int, bucket_by: str | None = None) -> bool:
        """Fold the table into one part once it has more than `max_parts` live parts."""
        if self.live_parts(table) <= max_parts:
            return False
        self.compact(table, self.read(table, schema, keys), bucket_by)
        return True


def schema_parts(schema: str) -> list[str]:
    """Columns of a flat DDL string."""
    return [p.strip() for p in schema.split(",")]
