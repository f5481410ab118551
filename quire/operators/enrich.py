"""Agent chains: pluggable content transformers with retries and deadlines.

An agent is a callable `text -> text`, or one marked with `batch_agent`, which
takes a list of texts and returns as many. It may fail with any exception.
The chains of a run of items of bounded bytes run in one `mapInArrow` pass (one
Python boundary), step by step in list order, and keep the order of the rows: an
unknown name is recorded and skipped, a failure is recorded and stops the
item's chain, keeping the last good text. In a task, up to `threads` calls run
at a time, each in a thread of its own, which is left behind when the call
outlasts the deadline; so calls against a rate-limited API are bounded by
`threads` times the partitions handed to `enrich`.
"""

from __future__ import annotations

import hashlib
import queue
import re
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from quire.functions import text as T
from quire.session import bound_batches, ship_package

# Bytes of text whose chains run together; a longer single text goes alone.
RUN_BYTES = 2 << 20

# The summary prompt (front matter removed); {{content}} is replaced.
SUMMARY_PROMPT = """You are a content summarization assistant. Your task is to create a concise, informative summary of the provided content.

Guidelines:
- Extract key points and main ideas
- Maintain factual accuracy
- Use clear, concise language
- Format output as markdown
- Aim for 3-5 paragraphs maximum
- Preserve important details like names, dates, and numbers
- Remove redundant information and filler content

Content to summarize:
{{content}}

Provide your summary below in markdown format:"""


class AgentError(Exception):
    """For agents that have nothing more telling to raise; any exception is a failed call."""


class OutOfTime(Exception):
    """The call did not return before its deadline."""


@dataclass(frozen=True)
class RetryPolicy:
    max_retries: int = 10
    initial_backoff: float = 1.0
    max_backoff: float = 30.0
    timeout: float = 300.0    # of all tries of a call and the pauses between them
    threads: int = 4          # calls at a time in a task
    batch_size: int = 16      # texts handed to a batch agent at once


def batch_agent(f: Callable[[list[str]], list[str]]) -> Callable[[list[str]], list[str]]:
    """Mark an agent that takes a list of texts."""
    f.takes_batch = True
    return f


def prompt_request(content, template: str = SUMMARY_PROMPT) -> Column:
    return F.replace(F.lit(template), F.lit("{{content}}"), T.s(content))


# Per-call helpers mirroring the Column versions in quire.functions.text.
_RETRYABLE = re.compile(T.RETRYABLE_RE)
_DUR_FRAC = re.compile(r"(?:(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)s)+")
_DUR_INT = re.compile(r"(?:[0-9]+s)+")


def is_retryable(msg: str) -> bool:
    return bool(_RETRYABLE.search(msg.lower()))


def _dur(s: str, pat: re.Pattern) -> float | None:
    if s == "0":
        return 0.0
    if not pat.fullmatch(s):
        return None
    return sum(float(p) for p in s.split("s") if p)


def retry_delay(msg: str) -> float:
    m = re.search(r"retry in ([0-9.s]*)", msg)
    if m and m.group(1):
        d = _dur(m.group(1), _DUR_FRAC)
        if d is not None:
            return d
    m = re.search(r"retryDelay:([0-9s]*)", msg)
    if m and m.group(1):
        d = _dur(m.group(1), _DUR_INT)
        if d is not None:
            return d
    return 0.0


def _bounded(agent: Callable, content, seconds: float):
    """agent(content), or OutOfTime after `seconds`; the thread of a call that hangs does not hold up the task."""
    box: queue.SimpleQueue = queue.SimpleQueue()

    def call() -> None:
        try:
            box.put((agent(content), None))
        except BaseException as e:  # noqa: BLE001 - handed to the caller, whatever it is
            box.put((None, e))

    threading.Thread(target=call, daemon=True).start()
    try:
        result, error = box.get(timeout=max(0.0, seconds))
    except queue.Empty:
        raise OutOfTime from None
    if error is not None:
        raise error
    return result


def call_with_retry(agent: Callable, content, policy: RetryPolicy, sleep=time.sleep, clock=time.monotonic
                    ) -> tuple[object | None, str | None, int]:
    """(result, error, tries). An error that does not ask for a retry ends it at
    once; at most max_retries + 1 tries, no pause after the last, and nothing
    goes on beyond the deadline."""
    deadline = clock() + policy.timeout
    last = ""
    for attempt in range(policy.max_retries + 1):
        left = deadline - clock()
        if left <= 0:
            return None, f"deadline of {policy.timeout:g} s passed, tries: {attempt}", attempt
        try:
            return _bounded(agent, content, left), None, attempt + 1
        except OutOfTime:
            return None, f"no answer within {policy.timeout:g} s, tries: {attempt + 1}", attempt + 1
        except Exception as e:  # noqa: BLE001 - any error is classified by what it says
            last = str(e) or type(e).__name__
        if not is_retryable(last):
            return None, f"failed for good: {last}", attempt + 1
        if attempt == policy.max_retries:
            break
        pause = min(retry_delay(last) or policy.initial_backoff * 2.0 ** attempt, policy.max_backoff)
        if clock() + pause >= deadline:
            return None, f"no time left to try again: {last}", attempt + 1
        sleep(pause)
    return None, f"gave up, tries: {policy.max_retries + 1}: {last}", policy.max_retries + 1


def call_all(agent: Callable, contents: list[str], policy: RetryPolicy, pool: ThreadPoolExecutor) -> list[tuple]:
    """call_with_retry() for each text, in order. A batch agent gets them by batches; those of a failed batch go alone."""
    if not getattr(agent, "takes_batch", False):
        return list(pool.map(lambda c: call_with_retry(agent, c, policy), contents))

    def one_batch(texts: list[str]) -> list[tuple]:
        out, error, tries = call_with_retry(agent, texts, policy)
        if error is None and len(out) == len(texts):
            return [(o, None, tries) for o in out]
        error = error or f"{len(out)} results for {len(texts)} texts"
        if len(texts) == 1:
            return [(None, error, tries)]
        return [r for t in texts for r in one_batch([t])]

    parts = [contents[i:i + policy.batch_size] for i in range(0, len(contents), policy.batch_size)]
    return [r for part in pool.map(one_batch, parts) for r in part]


def run_chains(chains: list, registry: dict[str, Callable], contents: list[str], policy: RetryPolicy
               ) -> list[tuple[str, str, list[str]]]:
    """(final text, status, errors) of each item, in order."""
    chains = [list(c) if c is not None else [] for c in chains]
    text, status, errors = list(contents), ["ok"] * len(chains), [[] for _ in chains]
    with ThreadPoolExecutor(policy.threads) as pool:
        for step in range(max(map(len, chains), default=0)):
            at: dict[str, list[int]] = {}
            for i, c in enumerate(chains):
                if step < len(c) and status[i] == "ok":
                    at.setdefault(c[step], []).append(i)
            for name, rows in at.items():
                if name not in registry:
                    for i in rows:
                        errors[i].append(f"no agent named '{name}'")
                    continue
                for i, (out, error, _) in zip(rows, call_all(registry[name], [text[i] for i in rows], policy, pool), strict=True):
                    if error is None:
                        text[i] = out
                    else:
                        errors[i].append(f"agent '{name}': {error}")
                        status[i] = "failed"
    return list(zip(text, status, errors, strict=True))


def run_chain(names, registry: dict[str, Callable], content: str, policy: RetryPolicy) -> tuple[str, str, list[str]]:
    """run_chains() for one item."""
    return run_chains([names], registry, [content], policy)[0]


def unknown_agents(named: list[str], registry: dict[str, Callable]) -> list[str]:
    return sorted(set(named) - set(registry))


def _runs(sizes: list[int], limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of the runs of texts of at most `limit` bytes in which a batch is worked off."""
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > limit:
            yield begin, i - begin
            begin, held = i, 0
        held += size
    if sizes:
        yield begin, len(sizes) - begin


def enrich(df: DataFrame, make_registry: Callable[[], dict[str, Callable]],
           policy: RetryPolicy = RetryPolicy(), content: str = "content", agents: str = "agents",
           partitions: int | None = None) -> DataFrame:
    """Add `enriched`, `agent_status`, `agent_errors` by running each row's chain.

    `make_registry` is called once per task, so clients are built on executors.
    The other columns pass through in Arrow; a task holds a batch of bounded
    bytes and the texts of one run of it.
    """
    added = StructType.fromDDL("enriched string, agent_status string, agent_errors array<string>")
    schema = StructType(df.schema.fields + added.fields)
    names, kinds = [f.name for f in schema.fields], [to_arrow_type(f.dataType) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        registry = make_registry()
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(content)), 0).to_pylist()
            for first, n in _runs(sizes):
                part = b.slice(first, n)
                res = run_chains(part.column(agents).to_pylist(), registry, [c or "" for c in part.column(content).to_pylist()], policy)
                made = [pa.array([r[k] for r in res], type=t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=names)

    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    src = df.repartition(partitions) if partitions else df
    return src.mapInArrow(run, schema)


# --- deterministic stand-ins used by the bundled queries and tests -------------

def stand_in_registry() -> dict[str, Callable[[str], str]]:
    """'summary' prefixes the text; it refuses text naming a license (non-retryable)
    and is rate limited twice on text naming a copyright (retryable)."""
    calls: dict[bytes, int] = {}  # by digest: no text stays in memory

    def summary(text: str) -> str:
        if "License" in text:
            raise AgentError("invalid input: licensed content")
        if "Copyright" in text:
            key = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            calls[key] = calls.get(key, 0) + 1
            if calls[key] <= 2:
                raise AgentError("Error 429: rate limit exceeded, retry in 0s")
        return "summary: " + text

    return {"summary": summary}
