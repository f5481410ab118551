"""Append-only state tables: latest view, key-filtered reads, compaction, failed writes."""

import os

import pytest
from pyspark.sql import functions as F

from quire.operators.state import StateStore, bucket_of

SCHEMA = "url string, v long"


def test_append_latest_compact(spark, scratch):
    st = StateStore(spark, os.path.join(scratch, "s"))
    assert st.read("t", SCHEMA, ["url"]).count() == 0
    st.append("t", spark.createDataFrame([("a", 1), ("b", 1)], SCHEMA))
    st.append("t", spark.createDataFrame([("b", 2), ("c", 2)], SCHEMA))
    assert sorted(tuple(r) for r in st.read("t", SCHEMA, ["url"]).collect()) == [("a", 1), ("b", 2), ("c", 2)]
    assert st.read("t", SCHEMA).count() == 4  # append-only view keeps every row
    wanted = spark.createDataFrame([("b",), ("z",)], "url string")
    assert [tuple(r) for r in st.read_for("t", SCHEMA, ["url"], wanted).collect()] == [("b", 2)]
    st.compact("t", st.read("t", SCHEMA, ["url"]).where("url <> 'a'"))
    assert sorted(tuple(r) for r in st.read("t", SCHEMA, ["url"]).collect()) == [("b", 2), ("c", 2)]
    st.append("t", spark.createDataFrame([("a", 9)], SCHEMA))
    assert sorted(tuple(r) for r in st.read("t", SCHEMA, ["url"]).collect()) == [("a", 9), ("b", 2), ("c", 2)]
    assert st.parts("t") == [2, 3]


def test_a_change_shows_all_its_parts_or_none(spark, scratch):
    st = StateStore(spark, os.path.join(scratch, "s"))
    rows = lambda t: sorted(tuple(r) for r in st.read(t, SCHEMA).collect())
    st.append("t", spark.createDataFrame([("a", 1)], SCHEMA))
    dead = st.begin("run")
    dead.append("t", spark.createDataFrame([("a", 5)], SCHEMA))
    dead.append("u", spark.createDataFrame([("b", 5)], SCHEMA))  # dies here: nothing of it is read
    assert rows("t") == [("a", 1)] and rows("u") == [] and st.committed("run") is None
    again = st.begin("run")  # its repetition takes the same folders
    again.append("t", spark.createDataFrame([("a", 6)], SCHEMA))
    again.append("u", spark.createDataFrame([("b", 6)], SCHEMA))
    again.commit({"n": 2})
    assert rows("t") == [("a", 1), ("a", 6)] and rows("u") == [("b", 6)]
    assert st.committed("run")["info"] == {"n": 2} and StateStore(spark, st.root).parts("t") == [0, 1]
    with pytest.raises(RuntimeError):  # a second writer that began at the same time
        dead.commit()
    assert rows("t") == [("a", 1), ("a", 6)]


def test_run_ids_of_any_form(spark, scratch):
    st = StateStore(spark, os.path.join(scratch, "s"))
    for name in ("a.b/c d", "a", "é"):
        st.begin(name).commit()
    assert st.runs() == ["a.b/c d", "a", "é"] and st.committed("a.b/c d")["n"] == 0 and st.committed("b") is None


def test_buckets_of_the_wanted_keys_are_read(spark, scratch):
    """Latest rows by key, from the folders of the wanted keys and the commits that hold them."""
    st = StateStore(spark, os.path.join(scratch, "s"), buckets=8)
    for n in range(3):
        st.append("t", spark.createDataFrame([(f"u{i}", 100 * n + i) for i in range(40) if i % (n + 1) == 0], SCHEMA), bucket_by="url")
    st.append("t", spark.createDataFrame([("u1", 7)], SCHEMA))  # a part without buckets is read as well
    wanted = spark.createDataFrame([("u1",), ("u4",), ("u5",), ("none",)], "url string")
    got = st.read_for("t", SCHEMA, ["url"], wanted)
    assert sorted(tuple(r) for r in got.collect()) == [("u1", 7), ("u4", 104), ("u5", 5)]
    one = st.read_for("t", SCHEMA, ["url"], spark.createDataFrame([("u4",)], "url string"))
    at = spark.range(1).select(bucket_of(F.lit("u4"), 8)).first()[0]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "_bucket#" in plan and f"= {at})" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert {f.split("/_seq=")[1].split("/")[0] for f in one.inputFiles()} == {"1"}  # of one commit only
    assert sorted(r.url for r in st.read("t", SCHEMA, ["url"]).collect()) == sorted(f"u{i}" for i in range(40))


def test_maybe_compact(spark, scratch):
    st = StateStore(spark, os.path.join(scratch, "s"))
    for i in range(4):
        st.append("t", spark.createDataFrame([("a", i), (f"k{i}", i)], SCHEMA))
    assert st.maybe_compact("t", SCHEMA, ["url"], max_parts=8) is False
    assert st.maybe_compact("t", SCHEMA, ["url"], max_parts=3) is True
    assert st.live_parts("t") == 1
    assert sorted(tuple(r) for r in st.read("t", SCHEMA, ["url"]).collect()) == \
        [("a", 3), ("k0", 0), ("k1", 1), ("k2", 2), ("k3", 3)]
