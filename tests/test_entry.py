"""Driver contract: entry runs, every query has a callable, oracle keys are queries."""

import __spark_entry__ as E


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["verdict", "n"]
    rows = df.collect()
    assert sum(r.n for r in rows) == 200  # every document of sf0.001 is counted once


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40
    numbered = {name for name in q if name.startswith("op") or name == "pipeline"}
    assert len(numbered) in (0, 14)  # all of the optional part, or nothing of it


def test_small_queries_run(spark):
    from conftest import SF
    for name in ["channel_names", "subtitle_choice", "latest_generation", "cache_stats"]:
        assert E.queries()[name](spark, SF).count() >= 1
