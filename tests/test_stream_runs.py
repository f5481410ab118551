"""Micro-batch runs equal one batch run when items arrive in time order."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF
from quire.operators import enrich as EN
from quire.operators import rules as RL
from quire.operators import state as ST
from quire.operators.state import StateStore
from quire.plans import run as R
from quire.sources import tables as S
from quire.streaming import runs as SR

SCHEMA = "resource_pos int, item_pos long, title string, link string, description string, published timestamp, guid string"


def test_stream_of_runs_equals_batch(spark, scratch):
    docs = S.read(spark, SF, "documents")
    items = S.items_from_documents(docs)
    res = S.resources_from_documents(docs)
    rules = RL.compile_rule_sets(RL.DEFAULT_RULE_SETS)
    batch = R.run_once(spark, items, res, rules, StateStore(spark, os.path.join(scratch, "b")), R.RunOptions(now=10))
    want = sorted((r.resource_pos, r.item_pos, r.content) for r in batch.pages.collect())

    landing = os.path.join(scratch, "landing")
    half = F.col("item_pos") < 100
    items.where(half).coalesce(1).write.parquet(os.path.join(landing, "part=0"))
    items.where(~half).coalesce(1).write.parquet(os.path.join(landing, "part=1"))
    stream = spark.readStream.schema(SCHEMA + ", part int").option("maxFilesPerTrigger", 1).parquet(landing) \
        .drop("part")
    q, job = SR.run(spark, stream, res, rules, StateStore(spark, os.path.join(scratch, "s")), R.RunOptions(now=10, keep_pages=True),
                    os.path.join(scratch, "ckpt"))
    q.awaitTermination()
    assert len(job.infos) == 2
    got = job.store.read("pages", R.PAGES_SCHEMA)
    assert sorted((r.resource_pos, r.item_pos, r.content) for r in got.collect()) == want  # each item arrives in one micro-batch
    assert {r.run for r in got.select("run").distinct().collect()} == {"stream-0", "stream-1"}
    assert sum(i["pages"] for i in job.infos.values()) == len(want)


def _state(store, out):
    """Everything a batch leaves behind: the rows of all tables and the digest files."""
    rows = {}
    for table, schema in [(t, s) for t, (s, _, _) in R.TABLES.items()] + [
            ("rejected", R.REJECTED_SCHEMA), ("errors", R.ERRORS_SCHEMA), ("pages", R.PAGES_SCHEMA)]:
        df = store.read(table, schema)
        rows[table] = sorted(str(tuple(r)) for r in df.collect())
    rows["digest"] = [(f.replace(out, ""), open(f).read()) for f in sorted(glob.glob(os.path.join(out, "*", "*", "part-*")))]
    rows["digest"] = sorted(line for _, text in rows["digest"] for line in text.splitlines())
    return rows


class Killed(Exception):
    pass


@pytest.mark.parametrize("when", ["before", "after"])
def test_batch_killed_round_its_commit(spark, scratch, monkeypatch, when):
    """A batch that dies just before or just after its manifest and is replayed leaves what an undisturbed one does."""
    items = S.items_from_documents(S.read(spark, SF, "documents")).where("item_pos < 60")
    res = S.resources_from_documents(S.read(spark, SF, "documents"))
    rules = RL.compile_rule_sets(RL.DEFAULT_RULE_SETS)
    batches = [items.where("item_pos < 30"), items.where("item_pos >= 20")]
    seen = {}
    for name in ("undisturbed", "killed"):
        out = os.path.join(scratch, name, "out")
        store = StateStore(spark, os.path.join(scratch, name, "state"))
        opts = R.RunOptions(now=10, out_dir=out, keep_pages=True, make_registry=EN.stand_in_registry,
                            policy=EN.RetryPolicy(initial_backoff=0.0, max_backoff=0.0))
        for k, batch in enumerate(batches):
            job = SR.RunJob(res, rules, store, opts)
            if name == "killed":
                commit = ST.Change.commit

                def dies(self, info=None):
                    if when == "after":
                        commit(self, info)
                    raise Killed

                monkeypatch.setattr(ST.Change, "commit", dies)
                with pytest.raises(Killed):
                    job(batch, k)
                monkeypatch.undo()
                assert (store.committed(f"stream-{k}") is not None) == (when == "after")
                job = SR.RunJob(res, rules, store, opts)  # the driver starts again
            job(batch, k)
            assert job.infos[k]["pages"] > 0
        seen[name] = _state(store, out)
    assert seen["killed"] == seen["undisturbed"]
    assert all(seen["killed"][t] for t in ("pages", "history", "feed", "parser_cache", "agent_cache", "rejected", "errors", "digest"))
