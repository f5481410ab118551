"""Cache cascade cases and digest shapes."""

from pyspark.sql import functions as F

from quire.operators import cache as C
from quire.operators import content as CT
from quire.operators import digest as DG
from quire.operators import state as ST

ITEMS = "resource_pos int, item_pos long, title string, link string, description string, parser string, agents array<string>"


def _items(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def test_cascade_cases(spark):
    items = _items(spark, [
        (0, 1, "t", "https://x/agent-hit", "d1", "web", ["summary"]),
        (0, 2, "t", "https://x/empty-hit", "d2", "web", ["summary"]),
        (0, 3, "t", "https://x/parser-hit", "d3", "web", []),
        (0, 4, "t", "https://x/corrupt", "d4", "web", []),
        (0, 5, "t", "https://x/wrong-type", "d5", "telegram", []),
        (0, 6, "t", "https://x/changed-agents", "d6", "web", ["summary", "format"]),
        (0, 7, "t", "https://x/dup", "**first**", "telegram", []),
        (1, 1, "t", "https://x/dup", "**second**", "telegram", []),
        (1, 2, "t", None, "no link", "web", []),
        (1, 3, "t", "", "empty link too", "web", []),
    ])
    pc = spark.createDataFrame([
        ("https://x/parser-hit", "web", '{"parser_type":"web","data":{"HTML":"cached3"}}', 1, 1),
        ("https://x/corrupt", "web", "{oops", 1, 1),
        ("https://x/wrong-type", "telegram", '{"parser_type":"web","data":{"HTML":"x"}}', 1, 1),
        ("https://x/changed-agents", "web", '{"parser_type":"web","data":{"HTML":"cached6"}}', 1, 1),
    ], C.PARSER_CACHE_SCHEMA)
    ac = spark.createDataFrame([
        ("https://x/agent-hit", "web", "summary", "agent1", 1, 1),
        ("https://x/empty-hit", "web", "summary", "", 1, 1),
        ("https://x/changed-agents", "web", "summary", "stale", 1, 1),
    ], C.AGENT_CACHE_SCHEMA)
    seen = []

    def parse(df):
        seen.append(df.count())
        return CT.parse_landed(df)

    out = {(r.resource_pos, r.item_pos): (r.content_source, r.content)
           for r in C.resolve(items, pc, ac, parse).collect()}
    assert out[(0, 1)] == ("agent_cache", "agent1")
    assert out[(0, 2)] == ("agent_cache", "")                       # empty string is a hit
    assert out[(0, 3)] == ("parser_cache", "cached3")
    assert out[(0, 4)] == ("parsed", "d4")                          # unreadable payload: parse again
    assert out[(0, 5)] == ("parsed", "<p>d5</p>")                   # payload of another parser
    assert out[(0, 6)] == ("parser_cache", "cached6")               # other pipeline: agent miss
    # the first occurrence of a link serves the later one
    assert out[(0, 7)] == out[(1, 1)] == ("parsed", "<p><strong>first</strong></p>")
    # NULL and empty links share the key ''
    assert out[(1, 2)] == out[(1, 3)]
    assert seen == [4]  # one parse per missed key: corrupt, wrong type, dup link, empty link


def test_touch_put_stats(spark):
    pc = spark.createDataFrame([("u1", "web", "a", 5, 5), ("u2", "web", "b", 6, 6)], C.PARSER_CACHE_SCHEMA)
    hits = spark.createDataFrame([("u1", "web")], "url string, parser_type string")
    new = spark.createDataFrame([("u2", "web", "b2"), ("u3", "web", "c")], "url string, parser_type string, output_data string")
    after = C.put(C.touch(pc, hits, ["url", "parser_type"], 100), new, ["url", "parser_type"], 200)
    got = sorted(tuple(r) for r in after.collect())
    assert got == [("u1", "web", "a", 5, 100), ("u2", "web", "b2", 200, 200), ("u3", "web", "c", 200, 200)]
    ac = spark.createDataFrame([], C.AGENT_CACHE_SCHEMA)
    assert C.stats(after, ac).first().asDict() == {"parser_entries": 3, "agent_entries": 0, "oldest_entry": 5}
    empty = C.stats(after.where("false"), ac.where("false")).first().asDict()
    assert empty == {"parser_entries": 0, "agent_entries": 0, "oldest_entry": None}


def test_digest_shapes(spark):
    pages = spark.createDataFrame([
        (0, 1, "T1", "https://a/1", "<p>c1</p>", "id1", 1704067200),
        (0, 2, "T2", "", "c2", "id2", None),
        (2, 1, "T3", "https://a/1", "c3", "id1", None),
    ], "resource_pos int, item_pos long, title string, link string, content string, page_id string, ts long") \
        .withColumn("published", F.when(F.col("ts").isNotNull(), F.timestamp_seconds("ts"))).drop("ts")
    res = spark.createDataFrame([(0, "Feed A"), (1, "Empty"), (2, "Feed A again")], "resource_pos int, feed_title string")
    lines = [r.line for r in DG.digest_lines(pages, res).orderBy("section", "resource_pos", "item_pos", "line_no").collect()]
    assert lines[0] == '<h2 class="toc-resource-name">Feed A</h2>'
    assert '<h2 class="toc-resource-name">Empty</h2>' not in lines           # resource without pages
    assert lines.count('<h2 class="toc-resource-name">Feed A again</h2>') == 1
    src = [l for l in lines if l.startswith('<div class="article-source">')]
    assert src == ['<div class="article-source">Source: <a href="https://a/1">https://a/1</a>'
                   '<br>Published: 2024-01-01 00:00:00 UTC</div>',
                   '<div class="article-source">Source: <a href="https://a/1">https://a/1</a></div>']
    totals = DG.run_totals(pages).first()
    assert (totals.resources, totals.pages) == (2, 3)


def test_history_newest_run_wins(spark):
    h = spark.createDataFrame([(1, "a", 50, 100), (2, "a", 10, 200), (3, "b", 7, 200), (4, "b", 9, 200)],
                              "id long, feed_url string, last_processed_at long, created_at long")
    assert {r.feed_url: r.last_processed_at for r in ST.latest_marks(h).collect()} == {"a": 10, "b": 9}
