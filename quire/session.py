"""Session construction and the few cluster settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Broadcast threshold used by `bounded_broadcast` when the session sets none.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# Bytes that a row of the resource configuration takes at most, about.
RESOURCE_BYTES = 4096
# Bytes of an Arrow batch handed to a Python worker.
BATCH_BYTES = 8 << 20


def get_session(master: str | None = None, app: str = "quire",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and Arrow turned on.

    On a cluster, pass master=None and let spark-submit provide the master,
    the executors and `spark.checkpoint.dir`.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only when the setting is absent (local tests) a scratch folder is created
    and registered, so that `checkpoint()` and state tables have a home.
    """
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = tempfile.mkdtemp(prefix="quire-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def state_dir(spark: SparkSession) -> str:
    """Root of the run-state tables (history, feed marks, caches)."""
    d = spark.conf.get("spark.quire.state.dir", None)
    if d:
        return d
    return os.path.join(checkpoint_dir(spark), "quire-state")


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan (no job is run)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) if isinstance(size, int) else int(size.toString())  # Scala BigInt via py4j


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None, row_bytes: int | None = None) -> DataFrame:
    """Broadcast-hint `df` only when its estimated size is within the bound.

    Beyond the bound the frame is returned unchanged, so the join shuffles
    (and AQE may still switch to a broadcast once real sizes are known, but
    then the other side has been shuffled for nothing). row_bytes: for tables
    much smaller than what they are derived from, whose estimate follows their
    source; beyond the bound their rows are counted, so many bytes each.
    """
    if max_bytes is None:
        try:
            max_bytes = int(df.sparkSession.conf.get("spark.quire.broadcastBytes"))
        except Exception:
            max_bytes = DEFAULT_BROADCAST_BYTES
    try:
        size = estimated_bytes(df)
    except Exception:
        return df
    if size > max_bytes and row_bytes is not None:
        size = df.limit(max_bytes // row_bytes + 1).count() * row_bytes
    return F.broadcast(df) if size <= max_bytes else df


def spread(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Spread a scan over the cluster when it yields fewer splits than cores.

    Large inputs already arrive in many splits and pass through untouched (no
    shuffle); a small file with one row group would otherwise put every row
    of CPU-heavy text work into one task. Projections and filters written
    after this call are still pushed below the exchange into the scan.
    """
    spark = df.sparkSession
    par = spark.sparkContext.defaultParallelism
    try:
        n = df.rdd.getNumPartitions()
    except Exception:
        return df
    if n >= par:
        return df
    # hashing on an id spreads as evenly as round robin, without the local sort
    # that round robin needs to be deterministic on retry
    return df.repartition(par, *keys) if keys else df.repartition(par)


def materialize(df: DataFrame) -> DataFrame:
    """`checkpoint()` into the session's checkpoint folder (registered first if needed)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded bytes, which the JVM and the Python worker of a task both hold."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `quire` importable in the Python workers (what --py-files does).

    Needed by the operators that run Python on executors (agent chains and
    keyed streaming state); done once per application.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="quire-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    # Python functions carry sc.environment; the streaming runner reads the
    # package from there (the zip lives on the driver host, where it runs).
    prev = sc.environment.get("PYTHONPATH")
    sc.environment["PYTHONPATH"] = path + (os.pathsep + prev if prev else "")
    _SHIPPED.add(app)


def _sql_literal(v, dtype: str) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype})"
    if dtype.startswith("array<"):
        inner = dtype[len("array<"):-1]
        if not v:
            return f"CAST(array() AS {dtype})"
        return "array(" + ", ".join(_sql_literal(x, inner) for x in v) + ")"
    if dtype == "boolean":
        return "TRUE" if v else "FALSE"
    if dtype == "string":
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({v!r} AS {dtype})"


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small driver-side rows (configuration) as an inline VALUES relation.

    Unlike `createDataFrame`, whose size Catalyst cannot see, an inline table
    carries exact statistics, so `bounded_broadcast` can prove it small.
    """
    fields = spark.createDataFrame([], schema).schema.fields
    if not rows:
        return spark.createDataFrame([], schema)
    cols = [f"c{i}" for i in range(len(fields))]
    values = ", ".join("(" + ", ".join(_sql_literal(v, f.dataType.simpleString()) for v, f in zip(r, fields)) + ")"
                       for r in rows)
    select = ", ".join(f"CAST({c} AS {f.dataType.simpleString()}) AS `{f.name}`" for c, f in zip(cols, fields))
    return spark.sql(f"SELECT {select} FROM VALUES {values} AS t({', '.join(cols)})")
