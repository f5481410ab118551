"""Two-level content cache as keyed tables and joins.

parser_cache(url, parser_type, output_data, created_at, accessed_at)
agent_cache(url, parser_type, agent_pipeline, output_data, created_at, accessed_at)

Lookups are set joins: the run's distinct keys meet the cache once, and the
result is joined back to every item that shares the key (so the first
occurrence of a link serves later ones in the same run).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import state as ST

SEGMENTS = "array<struct<start:double,end:double,text:string>>"
TRANSCRIPTION = f"struct<title:string,language:string,segments:{SEGMENTS}>"
ENVELOPE = f"struct<parser_type:string,data:struct<HTML:string,Transcription:{TRANSCRIPTION}>>"
PARSER_CACHE_SCHEMA = ("url string, parser_type string, output_data string, "
                       "created_at long, accessed_at long")
AGENT_CACHE_SCHEMA = ("url string, parser_type string, agent_pipeline string, output_data string, "
                      "created_at long, accessed_at long")
# Stored agent-cache rows also keep the chain's status: a chain that failed part
# way is cached with its last good text (as the original does) and marked
# 'failed', so a run may choose not to serve it.
AGENT_CACHE_STORED = AGENT_CACHE_SCHEMA + ", status string"
TEXTS = ("description", "media")  # item columns that only the parsers read
KNOWN_PARSERS = ("web", "telegram", "youtube")


def pipeline_key(agents) -> Column:
    return F.array_join(F.coalesce(T._c(agents), F.array().cast("array<string>")), ",")


def encode_html(parser_type, html) -> Column:
    """Envelope of a web or chat response: {"parser_type": ..., "data": {"HTML": ...}}."""
    return F.to_json(F.struct(T._c(parser_type).alias("parser_type"),
                              F.struct(T._c(html).alias("HTML")).alias("data")))


def encode_transcript(transcription) -> Column:
    return F.to_json(F.struct(F.lit("youtube").alias("parser_type"),
                              F.struct(T._c(transcription).alias("Transcription")).alias("data")))


def decode(output_data, parser_type) -> Column:
    """Rendered content of a cached envelope, or NULL when it is unusable
    (bad JSON, other parser type, unknown parser)."""
    env = F.from_json(T._c(output_data), ENVELOPE)
    pt = T._c(parser_type)
    ok = env.isNotNull() & (env["parser_type"] == pt) & env["data"].isNotNull() & pt.isin(*KNOWN_PARSERS)
    tr = env["data"]["Transcription"]
    rendered = (F.when(pt == "youtube",
                       T.render_transcript(tr["title"], tr["language"],
                                           F.coalesce(tr["segments"], F.array().cast(SEGMENTS))))
                .otherwise(T.s(env["data"]["HTML"])))
    return F.when(ok, rendered)


def resolve(items: DataFrame, parser_cache: DataFrame, agent_cache: DataFrame, parse) -> DataFrame:
    """Content cascade: agent cache, else parser cache, else a fresh parse.

    `items` carries link, parser, agents and what `parse` reads;
    `parse(df) -> df + fresh` renders the content of items whose link missed.
    An agent hit needs a non-empty pipeline; an empty stored string still is a
    hit. A parser hit whose payload cannot be decoded counts as an access but
    yields no content, so the item is parsed again. A (link, parser) is parsed
    once in a run, whatever agent lists it stands under: its first occurrence
    (resource order, then feed order) without an agent hit serves the others.

    Keys are found from key columns alone; the item texts are read for the
    first occurrences that have to be parsed, and do not come out again.
    Output: the other item columns, pipeline, content, content_source, the hit flags.
    """
    it = items.withColumn("link", T.s("link")).withColumn("pipeline", pipeline_key("agents"))
    pos, page, full = ["resource_pos", "item_pos"], ["link", "parser"], ["link", "parser", "pipeline"]
    a = agent_cache.where(F.col("agent_pipeline") != "").select(
        F.col("url").alias("link"), F.col("parser_type").alias("parser"), F.col("agent_pipeline").alias("pipeline"),
        F.col("output_data").alias("agent_out"), F.lit(True).alias("agent_hit"))
    p = parser_cache.select(F.col("url").alias("link"), F.col("parser_type").alias("parser"),
                            F.col("output_data").alias("_payload"), F.lit(True).alias("_stored"))
    need = it.select(*pos, *full).join(a.select(*full), full, "left_anti").groupBy(*page).agg(F.min(F.struct(*pos)).alias("_first"))
    looked = need.join(p, page, "left").withColumn("parser_out", F.when(F.col("_stored"), decode("_payload", "parser"))).drop("_payload")
    missed = looked.where(F.col("parser_out").isNull()).select("_first.*")
    parsed = parse(it.join(missed, pos, "left_semi"))
    parsed = parsed.select(*page, *[c for c in ("fresh", "fresh_payload", "parse_error") if c in parsed.columns])
    served = looked.drop("_first").join(parsed, page, "left")
    slim = it.drop(*TEXTS)
    return (slim.join(a, full, "left").join(served, page, "left")
            .withColumn("agent_hit", F.coalesce("agent_hit", F.lit(False)))
            .withColumn("parser_hit", F.coalesce("_stored", F.lit(False)) & ~F.col("agent_hit"))
            .withColumn("parser_out", F.when(~F.col("agent_hit"), F.col("parser_out")))
            .withColumn("fresh", F.when(~F.col("agent_hit"), F.col("fresh")))
            .withColumn("content", F.coalesce("agent_out", "parser_out", "fresh"))
            .withColumn("content_source",
                        F.when(F.col("agent_hit"), "agent_cache")
                         .when(F.col("parser_out").isNotNull(), "parser_cache")
                         .when(F.col("fresh").isNotNull(), "parsed")
                         .otherwise("failed")).drop("_stored"))


# --- writes -----------------------------------------------------------------

def touch(cache: DataFrame, hit_keys: DataFrame, keys: list[str], now: int) -> DataFrame:
    """Set accessed_at on every row that was read in this run."""
    h = hit_keys.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return (cache.join(h, keys, "left")
            .withColumn("accessed_at", F.when(F.col("_hit"), F.lit(now).cast("long"))
                        .otherwise(F.col("accessed_at")))
            .drop("_hit").select(*cache.columns))


def put(cache: DataFrame, rows: DataFrame, keys: list[str], now: int) -> DataFrame:
    """INSERT OR REPLACE: both timestamps reset to `now`."""
    new = rows.withColumn("created_at", F.lit(now).cast("long")).withColumn("accessed_at", F.lit(now).cast("long"))
    return ST.upsert(cache, new.select(*cache.columns), keys)


def stats(parser_cache: DataFrame, agent_cache: DataFrame) -> DataFrame:
    """parser_entries, agent_entries, oldest_entry (NULL when none or not positive)."""
    both = (parser_cache.select("created_at", F.lit(1).alias("p"), F.lit(0).alias("a"))
            .unionByName(agent_cache.select("created_at", F.lit(0).alias("p"), F.lit(1).alias("a"))))
    oldest = F.min("created_at")
    return both.agg(F.coalesce(F.sum("p"), F.lit(0)).cast("long").alias("parser_entries"),
                    F.coalesce(F.sum("a"), F.lit(0)).cast("long").alias("agent_entries"),
                    F.when(oldest > 0, oldest).alias("oldest_entry"))

