"""One digest run as a Spark job: skip, filter, resolve content, enrich, assemble, commit.

Order of writes: digest lines and the parts of every state table, then the
run's manifest, which makes all of them count at once. A run that dies before
its manifest leaves nothing that is ever read and is simply repeated; a run
whose manifest exists (a replayed micro-batch) writes nothing.
"""

from __future__ import annotations

import logging
import os
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import cache as C
from quire.operators import config as CFG
from quire.operators import content as CT
from quire.operators import digest as DG
from quire.operators import enrich as EN
from quire.operators import incremental as INC
from quire.operators import rules as RL
from quire.operators import state as ST
from quire.session import RESOURCE_BYTES, bounded_broadcast, materialize

log = logging.getLogger(__name__)

HISTORY_SCHEMA = "id long, feed_url string, last_processed_at long, created_at long"
FEED_SCHEMA = "url string, title string, last_processed_at long"
REJECTED_SCHEMA = "run string, resource_pos int, item_pos long, link string, reason string"
ERRORS_SCHEMA = "run string, resource_pos int, item_pos long, stage string, message string"
PAGES_SCHEMA = "run string, resource_pos int, item_pos long, title string, link string, content string, page_id string, published timestamp"
PARSER_ACCESS = "url string, parser_type string, accessed_at long"
AGENT_ACCESS = "url string, parser_type string, agent_pipeline string, accessed_at long"
PARSER_KEYS, AGENT_KEYS = ["url", "parser_type"], ["url", "parser_type", "agent_pipeline"]
# table: schema, keys of its latest row (None: every row counts), key its parts are laid out by
TABLES = {
    "parser_cache": (C.PARSER_CACHE_SCHEMA, PARSER_KEYS, "url"),
    "agent_cache": (C.AGENT_CACHE_STORED, AGENT_KEYS, "url"),
    "parser_cache_access": (PARSER_ACCESS, PARSER_KEYS, None),
    "agent_cache_access": (AGENT_ACCESS, AGENT_KEYS, None),
    "feed": (FEED_SCHEMA, ["url"], None),
    "history": (HISTORY_SCHEMA, None, None),
}


@dataclass
class RunOptions:
    include_all: bool = False
    regenerate: bool = False
    clean: bool = False
    now: int | None = None
    out_dir: str | None = None
    title: str = "Digest"
    escape: bool = False
    policy: EN.RetryPolicy = field(default_factory=EN.RetryPolicy)
    make_registry: object = None          # () -> {name: callable}; None = no agents available
    agent_partitions: int | None = None   # bound on concurrent agent calls
    max_parts: int = 32                   # compact a state table beyond this many live parts
    reuse_failed_agents: bool = True      # serve cached outputs of chains that failed or skipped a name
    strict_agents: bool = False           # an enabled resource that names an unknown agent fails the run at its start
    run_id: str | None = None             # a run of an id that has committed is not repeated
    keep_pages: bool = False              # also store the pages of the digest as rows


@dataclass
class RunResult:
    """Frames of a run that was carried out; of a replayed one only what its manifest says."""
    run_id: str = ""
    info: dict = field(default_factory=dict)  # figures of the run: pages, rejected, errors by stage
    replayed: bool = False
    pages: DataFrame | None = None
    rejected: DataFrame | None = None
    errors: DataFrame | None = None
    marks: DataFrame | None = None
    stats: DataFrame | None = None  # cache statistics after the run (lazy)
    digest_path: str | None = None


def clean(store: ST.StateStore, run_id: str) -> None:
    """Both caches emptied (D6): empty parts stand for all earlier ones."""
    change = store.begin(run_id)
    for table in ("parser_cache", "agent_cache", "parser_cache_access", "agent_cache_access"):
        schema, _, by = TABLES[table]
        change.replace(table, store.spark.createDataFrame([], schema), by)
    change.commit()


def run_once(spark: SparkSession, items: DataFrame, resources: DataFrame, rule_sets: dict,
             store: ST.StateStore, opts: RunOptions = RunOptions(), parse=CT.parse_landed,
             fetch_errors: DataFrame | None = None) -> RunResult:
    """items(resource_pos, item_pos, title, link, description, published, guid[, media]),
    resources(resource_pos, feed_url, feed_title, parser, type, agents, enabled, filters),
    fetch_errors(resource_pos, message): sources that could not be read, with the run's other errors."""
    now = int(opts.now if opts.now is not None else time.time())
    run_id = opts.run_id or f"{now}-{uuid.uuid4().hex}"
    done = store.committed(run_id)
    if done:
        return RunResult(run_id, done["info"], True, digest_path=done["info"].get("digest"))
    if opts.clean:
        clean(store, run_id)
        return RunResult(run_id)
    resources = materialize(resources)  # a small table, read by the checks, the skip, the rules and the digest
    CFG.validate(spark, resources)
    if opts.strict_agents:
        named = [r.agent for r in CFG.agent_types(resources).collect()]  # names of the configuration
        unknown = EN.unknown_agents(named, opts.make_registry() if opts.make_registry else {})
        if unknown:
            raise ValueError("unknown agents: " + ", ".join(unknown))
    change = store.begin(run_id)
    history = store.read("history", HISTORY_SCHEMA)
    if opts.regenerate:  # D7: the newest run's rows go, in the commit of this run
        history = materialize(ST.delete_latest_generation(history))
    res = CFG.enabled(resources)
    res_cols = bounded_broadcast(res.select("resource_pos", "feed_url", "feed_title", "parser", "agents"), row_bytes=RESOURCE_BYTES)
    it = items.join(res_cols, "resource_pos").withColumn("ts", T.unix_ts("published"))

    # skip (J2, F2) and rules (F10, F11)
    passed = INC.skip_processed(it, ST.latest_marks(history), include_all=opts.include_all)
    # decisions are read by the rejection report, the key aggregation and the join back
    decided = materialize(RL.apply_resource_rules(passed, res, rule_sets))
    rejected = decided.where(~F.col("include")).select("resource_pos", "item_pos", "link", "reason")
    kept = decided.where("include").drop("include", "reason")

    # content: caches, fresh parse, agents (J3-J6, E3). Only the cache rows of this
    # run's links are looked up, and only their buckets are read.
    run_links = kept.select(T.s("link").alias("url")).distinct()
    pc = store.read_for("parser_cache", C.PARSER_CACHE_SCHEMA, PARSER_KEYS, run_links)
    ac = store.read_for("agent_cache", C.AGENT_CACHE_STORED, AGENT_KEYS, run_links)
    if not opts.reuse_failed_agents:
        ac = ac.where(F.coalesce(F.col("status"), F.lit("ok")) == "ok")
    casc = materialize(C.resolve(kept, pc, ac, parse).drop("agent_out", "parser_out", "fresh"))  # content is one of them
    # every kept item moves its feed's mark, parsed or not (A1)
    marks = (casc.groupBy("resource_pos", "feed_url", "feed_title").agg(F.max("ts").alias("last_processed_at"))
             .where(F.col("last_processed_at") > 0))
    todo = casc.where((F.col("pipeline") != "") & ~F.col("agent_hit") & F.col("content").isNotNull())
    registry = opts.make_registry or (lambda: {})
    enriched = EN.enrich(todo.select("link", "parser", "pipeline", "agents", "content").distinct(),
                         registry, opts.policy, partitions=opts.agent_partitions)
    # written once: agent calls are not repeated by the pages, the errors, the digest and the caches
    resolved = materialize(casc.join(enriched.select("link", "parser", "pipeline", "enriched", "agent_status", "agent_errors"),
                                     ["link", "parser", "pipeline"], "left").withColumn("final", F.coalesce("enriched", "content")))

    pages = (resolved.where(F.col("final").isNotNull())
             .select("resource_pos", "item_pos", "title", "link", F.col("final").alias("content"),
                     T.page_id("link").alias("page_id"), "published"))
    errors = run_errors(resolved, fetch_errors)

    digest_path = None
    if opts.out_dir:
        run_date = time.strftime("%Y_%m_%d", time.gmtime(now))
        lines = DG.digest_lines(pages, res.select("resource_pos", "feed_title"), escape=opts.escape)
        digest_path = DG.write_digest(lines, opts.out_dir, run_date, opts.title)

    # the run's report: its figures are counted while the rows are written
    run = F.lit(run_id).alias("run")
    info = observed_append(change, "rejected", rejected.select(run, "*"), [F.count(F.lit(1)).alias("rejected")])
    info |= observed_append(change, "errors", errors.select(run, "*"), [
        F.count_if(F.col("stage") == stage).alias(f"errors_{stage}") for stage in STAGES])
    if opts.keep_pages:
        change.append("pages", pages.select(run, "*"))

    # caches (D3, D4, D5): new outputs are appended as full rows; a hit appends only
    # (key, accessed_at) to the table's access log, never the payload again. The marks
    # are counted with them.
    stamped = F.lit(now).cast("long")
    page_key = (F.col("link").alias("url"), F.col("parser").alias("parser_type"))
    agent_key = (*page_key, F.col("pipeline").alias("agent_pipeline"))
    # put() leaves one row of a key, so repeated rows need no shuffle of their own
    fresh = resolved.where(F.col("content_source") == "parsed").select(*page_key, F.col("fresh_payload").alias("output_data"))
    change.append("parser_cache", C.put(pc.where(F.lit(False)), fresh, PARSER_KEYS, now), "url")
    change.append("parser_cache_access", resolved.where("parser_hit").select(*page_key).distinct().withColumn("accessed_at", stamped))
    # a chain that skipped an unknown name is not finished
    status = F.when((F.col("agent_status") == "ok") & (F.size("agent_errors") > 0), "incomplete").otherwise(F.col("agent_status"))
    agent_rows = resolved.where(F.col("enriched").isNotNull()).select(
        *agent_key, F.col("enriched").alias("output_data"), status.alias("status"))
    change.append("agent_cache", C.put(ac.where(F.lit(False)), agent_rows, AGENT_KEYS, now), "url")
    change.append("agent_cache_access", resolved.where("agent_hit").select(*agent_key).distinct().withColumn("accessed_at", stamped))

    # marks (A1, D1, D2); include-all writes none
    new = None
    if not opts.include_all and marks.take(1):
        new_feeds = ST.latest_wins(marks.select(F.col("feed_url").alias("url"), F.col("feed_title").alias("title"),
                                                "last_processed_at", "resource_pos"), ["url"], ["resource_pos"])
        change.append("feed", new_feeds.select("url", "title", "last_processed_at"))
        base = history.agg(F.max("id")).first()[0] or 0
        new = ST.history_rows(marks, now, base)
    if opts.regenerate:
        change.replace("history", history if new is None else history.unionByName(new))
    elif new is not None:
        change.append("history", new)
    info["pages"] = pages.count()
    if digest_path:
        info["digest"] = digest_path
    change.commit(info)

    # keep reads short: fold long part chains into one part (rare; costs one rewrite)
    for table, (schema, keys, by) in TABLES.items():
        store.maybe_compact(table, schema, keys, opts.max_parts, by)
    stats = C.stats(cache_view(store, "parser_cache", C.PARSER_CACHE_SCHEMA, PARSER_KEYS),
                    cache_view(store, "agent_cache", C.AGENT_CACHE_SCHEMA, AGENT_KEYS))
    return RunResult(run_id, info, pages=pages, rejected=rejected, errors=errors, marks=marks, stats=stats,
                     digest_path=digest_path)


STAGES = ("fetch", "parse", "agent")


def run_errors(resolved: DataFrame, fetch_errors: DataFrame | None = None) -> DataFrame:
    """(resource_pos, item_pos, stage, message): sources not read, items not parsed, agents that failed or are unknown."""
    said = F.col("parse_error") if "parse_error" in resolved.columns else F.lit(None).cast("string")
    out = (resolved.where(F.col("content_source") == "failed")
           .select("resource_pos", "item_pos", F.lit("parse").alias("stage"), F.coalesce(said, F.lit("parse failed")).alias("message"))
           .unionByName(resolved.select("resource_pos", "item_pos", F.lit("agent").alias("stage"),
                                        F.explode("agent_errors").alias("message"))))
    if fetch_errors is not None:
        out = out.unionByName(fetch_errors.select("resource_pos", F.lit(None).cast("long").alias("item_pos"),
                                                  F.lit("fetch").alias("stage"), "message"))
    return out


def observed_append(change: ST.Change, table: str, rows: DataFrame, counts: list) -> dict:
    """Append rows to a state table; the counts are taken on their way to the files."""
    seen = Observation(uuid.uuid4().hex)
    change.append(table, rows.observe(seen, *counts))
    return dict(seen.get)


def cache_view(store: ST.StateStore, table: str, schema: str, keys: list[str]) -> DataFrame:
    """A cache table as of now: latest row per key with its latest access time."""
    rows = store.read(table, schema, keys)
    acc = (store.read(table + "_access", ", ".join(f"{k} string" for k in keys) + ", accessed_at long")
           .groupBy(*keys).agg(F.max("accessed_at").alias("_acc")))
    return (rows.join(acc, keys, "left")
            .withColumn("accessed_at", F.greatest("accessed_at", F.coalesce("_acc", "accessed_at")))
            .drop("_acc"))


def documents_run(spark: SparkSession, sf_dir: str, store: ST.StateStore, opts: RunOptions) -> RunResult:
    """A run over the landed documents (one feed per source)."""
    from quire.sources import tables as S
    docs = S.read(spark, sf_dir, "documents")
    return run_once(spark, S.items_from_documents(docs), S.resources_from_documents(docs),
                    RL.compile_rule_sets(RL.DEFAULT_RULE_SETS), store, opts)


def pages_run(spark: SparkSession, sf_dir: str, store: ST.StateStore, opts: RunOptions) -> RunResult:
    """A run over web feeds whose items are the landed pages (content = main block)."""
    from quire.sources import tables as S
    pages = S.read(spark, sf_dir, "pages")
    return run_once(spark, S.items_from_pages(pages), S.resources_from_pages(spark), {}, store, opts,
                    parse=CT.parse_with_pages(pages))


def state_store(spark: SparkSession, name: str) -> ST.StateStore:
    from quire.session import state_dir
    return ST.StateStore(spark, os.path.join(state_dir(spark), name))
