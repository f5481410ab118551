"""Run scenarios: rerun skips, regenerate replays, include-all writes nothing, undated always pass."""

import os

from pyspark.sql import functions as F

from quire.operators import rules as RL
from quire.operators import state as ST
from quire.plans import run as R

RES_SCHEMA = ("resource_pos int, feed_url string, feed_title string, parser string, type string, "
              "agents array<string>, enabled boolean, filters array<string>")
ITEM_SCHEMA = "resource_pos int, item_pos long, title string, link string, description string, published timestamp, guid string"


def _items(spark, rows):
    df = spark.createDataFrame(rows, "resource_pos int, item_pos long, title string, link string, description string, ts long")
    return df.select("resource_pos", "item_pos", "title", "link", "description",
                     F.when(F.col("ts").isNotNull(), F.timestamp_seconds("ts")).alias("published"),
                     F.col("item_pos").cast("string").alias("guid"))


def _resources(spark):
    return spark.createDataFrame([
        (0, "https://a/feed", "A", "web", "rss", [], None, ["short"]),
        (1, "https://b/feed", "B", "telegram", "telegram_channel", ["summary"], True, []),
        (2, "https://c/feed", "C", "web", "rss", [], False, []),
    ], RES_SCHEMA)


RULES = RL.compile_rule_sets({"short": {"min_length": 12}})
ROWS = [(0, 1, "t1", "https://a/1", "long enough text", 100), (0, 2, "t2", "https://a/2", "tiny", 200),
        (0, 3, "t3", "https://a/3", "long enough text", None), (1, 1, "m1", "https://b/1", "**hi** there", 150),
        (2, 1, "x", "https://c/1", "disabled feed", 300)]


def _run(spark, store, rows=ROWS, **kw):
    opts = R.RunOptions(now=kw.pop("now", 1000), **kw)
    return R.run_once(spark, _items(spark, rows), _resources(spark), RULES, store, opts)


def _pages(res):
    return sorted((r.resource_pos, r.item_pos) for r in res.pages.collect())


def test_two_runs_and_regenerate(spark, scratch):
    store = ST.StateStore(spark, os.path.join(scratch, "state"))
    first = _run(spark, store)
    # filtered item (0,2) does not move the mark; undated (0,3) passes; disabled resource skipped
    assert _pages(first) == [(0, 1), (0, 3), (1, 1)]
    marks = {r.feed_url: r.last_processed_at for r in first.marks.collect()}
    assert marks == {"https://a/feed": 100, "https://b/feed": 150}
    rejected = [(r.item_pos, r.reason) for r in first.rejected.collect()]
    assert rejected == [(2, "short:min_length")]
    # rerun: only the undated item comes back
    second = _run(spark, store, now=2000)
    assert _pages(second) == [(0, 3)]
    hist = store.read("history", R.HISTORY_SCHEMA)
    assert hist.count() == 2  # the second run had only undated items: no history rows
    # regenerate deletes the newest run; the same items come again
    third = _run(spark, store, now=3000, regenerate=True)
    assert _pages(third) == [(0, 1), (0, 3), (1, 1)]


def test_include_all_writes_no_state(spark, scratch):
    store = ST.StateStore(spark, os.path.join(scratch, "state"))
    _run(spark, store)
    again = _run(spark, store, now=2000, include_all=True)
    assert _pages(again) == [(0, 1), (0, 3), (1, 1)]
    assert store.read("history", R.HISTORY_SCHEMA).count() == 2
    # caches warmed: chat item served from the parser cache now
    srcs = {(r.resource_pos, r.item_pos): r.content for r in again.pages.collect()}
    assert srcs[(1, 1)] == "<p><strong>hi</strong> there</p>"


def test_mark_boundary_same_second(spark, scratch):
    store = ST.StateStore(spark, os.path.join(scratch, "state"))
    rows = [(1, 1, "m", "https://b/1", "x", 150)]
    _run(spark, store, rows=rows)
    rows2 = [(1, 2, "m", "https://b/2", "same second", 150), (1, 3, "m", "https://b/3", "later", 151),
             (1, 4, "m", "https://b/4", "epoch zero", 0), (1, 5, "m", "https://b/5", "before 1970", -5)]
    res = _run(spark, store, rows=rows2, now=2000)
    assert _pages(res) == [(1, 3), (1, 4), (1, 5)]


def test_latest_wins_and_delete_latest(spark):
    h = spark.createDataFrame([(1, "a", 10, 100), (2, "a", 20, 100), (3, "b", 5, 90), (4, "b", 7, 50)],
                              "id long, feed_url string, last_processed_at long, created_at long")
    got = {r.feed_url: r.last_processed_at for r in ST.latest_marks(h).collect()}
    assert got == {"a": 20, "b": 5}  # newest created_at, ties by id
    left = sorted(r.id for r in ST.delete_latest_generation(h).collect())
    assert left == [3, 4]  # the global newest run is removed for every feed


def test_upsert_replaces(spark):
    cur = spark.createDataFrame([("u1", "t", 1), ("u2", "t", 2)], "url string, title string, last_processed_at long")
    new = spark.createDataFrame([("u2", "t2", 9), ("u3", "t3", 3)], "url string, title string, last_processed_at long")
    got = sorted(tuple(r) for r in ST.upsert(cur, new, ["url"]).collect())
    assert got == [("u1", "t", 1), ("u2", "t2", 9), ("u3", "t3", 3)]


def test_cache_view_after_runs(spark, scratch):
    store = ST.StateStore(spark, os.path.join(scratch, "state"))
    _run(spark, store, now=1000)
    _run(spark, store, now=2000, include_all=True)
    view = {r.url: (r.created_at, r.accessed_at)
            for r in R.cache_view(store, "parser_cache", "url string, parser_type string, output_data string, "
                                  "created_at long, accessed_at long", ["url", "parser_type"]).collect()}
    assert view["https://a/1"] == (1000, 2000)   # created by the first run, read by the second
    assert view["https://b/1"] == (1000, 1000)   # served by the agent cache: parser row not read
    R.run_once(spark, _items(spark, ROWS), _resources(spark), RULES, store, R.RunOptions(now=3000, clean=True))
    assert R.cache_view(store, "parser_cache", "url string, parser_type string, output_data string, "
                        "created_at long, accessed_at long", ["url", "parser_type"]).count() == 0


def test_failed_agent_chain_status(spark, scratch):
    from quire.operators import cache as C
    from quire.operators import enrich as EN
    store = ST.StateStore(spark, os.path.join(scratch, "state"))
    rows = [(1, 1, "m1", "https://b/1", "License text here", 150), (1, 2, "m2", "https://b/2", "fine text", 160)]
    pol = EN.RetryPolicy(initial_backoff=0.0, max_backoff=0.0)
    first = _run(spark, store, rows=rows, make_registry=EN.stand_in_registry, policy=pol)
    stored = {r.url: (r.status, r.output_data) for r in store.read("agent_cache", C.AGENT_CACHE_STORED,
                                                                  ["url", "parser_type", "agent_pipeline"]).collect()}
    assert stored["https://b/1"] == ("failed", "<p>License text here</p>")   # last good text, marked
    assert stored["https://b/2"][0] == "ok"
    # by default the failed output is served again; on request the chain is run again
    reuse = _run(spark, store, rows=rows, now=2000, include_all=True, make_registry=EN.stand_in_registry, policy=pol)
    assert reuse.errors.count() == 0
    retry = _run(spark, store, rows=rows, now=3000, include_all=True, make_registry=EN.stand_in_registry,
                 policy=pol, reuse_failed_agents=False)
    assert [r.item_pos for r in retry.errors.collect()] == [1]
