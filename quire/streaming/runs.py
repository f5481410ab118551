"""The whole digest run as a Structured Streaming micro-batch.

Each micro-batch of items is one `run_once`: the state tables (marks, caches,
history) are the static side it reads and appends to, so content parsed in an
earlier batch is served from the cache in a later one (K5), and items at or
below their feed's mark are skipped (K1, K3). Digests go to a folder per batch.

The batch is the run id. A batch that dies before its manifest has changed
nothing and is run again from the same state; one that had committed when the
stream's own checkpoint was lost is not run again. Either way digest, marks,
history and caches are those of one run of each batch.
"""

from __future__ import annotations

import os
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from quire.operators.state import StateStore
from quire.plans import run as R


class RunJob:
    def __init__(self, resources: DataFrame, rule_sets: dict, store: StateStore, opts: R.RunOptions,
                 parse=None, name: str = "stream"):
        self.resources, self.rule_sets, self.store, self.opts = resources, rule_sets, store, opts
        self.parse, self.name = parse, name
        self.infos: dict[int, dict] = {}  # figures of each batch; its rows are in the store

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        opts = replace(self.opts, run_id=f"{self.name}-{batch_id}")
        if opts.out_dir:
            opts = replace(opts, out_dir=os.path.join(opts.out_dir, f"batch_id={batch_id}"))
        if opts.now is not None:
            opts = replace(opts, now=opts.now + batch_id)
        kw = {"parse": self.parse} if self.parse is not None else {}
        self.infos[batch_id] = R.run_once(batch.sparkSession, batch, self.resources, self.rule_sets,
                                          self.store, opts, **kw).info


def run(spark: SparkSession, items: DataFrame, resources: DataFrame, rule_sets: dict, store: StateStore,
        opts: R.RunOptions, checkpoint: str, parse=None, available_now: bool = True, name: str = "stream"):
    """Start the run job over a streaming `items` frame; returns (query, job). name: one for each stream of a store."""
    job = RunJob(resources, rule_sets, store, opts, parse, name)
    w = items.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(), job
