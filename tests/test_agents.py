"""Retry wrapper and agent chain (mirrors the reference's retry tests)."""

import time

import pytest

from quire.operators import enrich as EN

FAST = EN.RetryPolicy(max_retries=3, initial_backoff=0.0, max_backoff=0.0, timeout=5.0)


class Flaky:
    def __init__(self, failures, msg="Error 429: rate limit"):
        self.failures, self.msg, self.calls = failures, msg, 0

    def __call__(self, text):
        self.calls += 1
        if self.calls <= self.failures:
            raise EN.AgentError(self.msg)
        return "processed: " + text


def test_success_at_once_and_after_failures():
    a = Flaky(0)
    assert EN.call_with_retry(a, "x", FAST) == ("processed: x", None, 1)
    b = Flaky(2)
    assert EN.call_with_retry(b, "x", FAST) == ("processed: x", None, 3)


def test_max_retries_and_non_retryable():
    a = Flaky(10)
    out, err, n = EN.call_with_retry(a, "x", FAST)
    assert out is None and err == "gave up, tries: 4: Error 429: rate limit" and n == 4 and a.calls == 4
    b = Flaky(10, "invalid input")
    out, err, n = EN.call_with_retry(b, "x", FAST)
    assert err == "failed for good: invalid input" and b.calls == 1


def test_backoff_schedule_and_deadline():
    sleeps = []
    policy = EN.RetryPolicy(max_retries=4, initial_backoff=1.0, max_backoff=5.0, timeout=1000.0)
    EN.call_with_retry(Flaky(10), "x", policy, sleep=sleeps.append)
    assert sleeps == [1.0, 2.0, 4.0, 5.0]  # no sleep after the last try
    sleeps = []
    EN.call_with_retry(Flaky(10, "429 retry in 12s"), "x", policy, sleep=sleeps.append)
    assert sleeps == [5.0] * 4  # suggested delay, capped
    clock = iter([0.0, 0.1, 0.6, 0.7, 1.0, 1.0]).__next__
    out, err, _ = EN.call_with_retry(Flaky(10), "x", EN.RetryPolicy(max_retries=10, initial_backoff=0.2,
                                                                     max_backoff=1.0, timeout=0.5),
                                     sleep=lambda s: None, clock=clock)
    assert out is None and ("passed" in err or "no time left" in err)


def test_chain_unknown_and_failure():
    reg = {"a": lambda t: t + "+a", "bad": Flaky(5, "invalid input"), "b": lambda t: t + "+b"}
    assert EN.run_chain(["a", "nope", "b"], reg, "x", FAST) == ("x+a+b", "ok", ["no agent named 'nope'"])
    text, status, errors = EN.run_chain(["a", "bad", "b"], reg, "x", FAST)
    assert (text, status) == ("x+a", "failed") and len(errors) == 1


def test_enrich_dataframe(spark):
    df = spark.createDataFrame([("x", ["summary"]), ("License text", ["summary", "format"])],
                               "content string, agents array<string>")
    out = sorted(tuple(r) for r in EN.enrich(df, EN.stand_in_registry, FAST)
                 .select("enriched", "agent_status").collect())
    assert out == [("License text", "failed"), ("summary: x", "ok")]


def test_hanging_agent_ends_at_the_deadline(spark):
    """The reference's limit: under 1 s with a deadline of 500 ms; other rows of the batch are served."""
    policy = EN.RetryPolicy(timeout=0.5, threads=2)

    def slow(text):
        if text == "hang":
            time.sleep(60)
        return text.upper()

    t0 = time.monotonic()
    got = EN.run_chains([["slow"]] * 3, {"slow": slow}, ["a", "hang", "b"], policy)
    assert time.monotonic() - t0 < 1.0
    assert got == [("A", "ok", []), ("hang", "failed", ["agent 'slow': no answer within 0.5 s, tries: 1"]), ("B", "ok", [])]


@pytest.mark.parametrize("error,calls", [(ConnectionError("503 service unavailable"), 4), (ValueError("bad"), 1), (RuntimeError("Rate limit exceeded"), 4),
                                         (TimeoutError(), 1)])
def test_any_exception_is_classified(error, calls):
    class Fails:
        n = 0

        def __call__(self, text):
            self.n += 1
            raise error

    agent = Fails()
    out, err, tries = EN.call_with_retry(agent, "x", FAST)
    assert out is None and err and agent.n == tries == calls


def test_batches_keep_order_and_isolate_failures():
    sizes = []

    @EN.batch_agent
    def shout(texts):
        sizes.append(len(texts))
        if "bad" in texts:
            raise RuntimeError("bad text")
        return [t.upper() for t in texts]

    texts = [f"t{i}" for i in range(10)] + ["bad"] + [f"u{i}" for i in range(5)]
    policy = EN.RetryPolicy(batch_size=4, threads=3, initial_backoff=0.0, max_backoff=0.0)
    got = EN.run_chains([["shout", "end"]] * len(texts), {"shout": shout, "end": lambda t: t + "."}, texts, policy)
    assert [g[0] for g in got] == [t if t == "bad" else t.upper() + "." for t in texts]
    assert [g[1] for g in got].count("failed") == 1 and max(sizes) == 4

    @EN.batch_agent
    def short(texts):
        return texts[:-1] or ["only"]

    assert [g[0] for g in EN.run_chains([["short"]] * 2, {"short": short}, ["a", "b"], policy)] == ["only", "only"]


def test_unknown_agents():
    assert EN.unknown_agents(["summary", "format", "format"], {"summary": str}) == ["format"]


def test_a_task_works_on_runs_of_bounded_bytes(spark):
    """Agents of a batch see the texts of one run, not all rows of a partition; a longer text goes alone."""
    @EN.batch_agent
    def held(texts):
        return [str(sum(map(len, texts)))] * len(texts)

    big, n = 300_000, 60
    df = spark.range(n, numPartitions=1).selectExpr(
        "id", f"repeat('x', IF(id = 7, {3 * EN.RUN_BYTES}, {big})) AS content", "array('held') AS agents")
    rows = EN.enrich(df, lambda: {"held": held}, EN.RetryPolicy(batch_size=10**6)).select("id", "enriched", "agent_status").collect()
    assert [r.id for r in rows] == list(range(n)) and {r.agent_status for r in rows} == {"ok"}
    assert rows[7].enriched == str(3 * EN.RUN_BYTES)
    assert max(int(r.enriched) for r in rows if r.id != 7) <= EN.RUN_BYTES
    assert list(EN._runs([])) == [] and list(EN._runs([5, 5, 9, 1], 10)) == [(0, 2), (2, 2)]


def test_the_stand_in_keeps_no_text():
    summary = EN.stand_in_registry()["summary"]
    text = "Copyright " + "x" * 1000
    assert EN.call_with_retry(summary, text, FAST) == ("summary: " + text, None, 3)
    assert EN.call_with_retry(summary, text, FAST)[2] == 1
    calls, = (c.cell_contents for c in summary.__closure__)
    assert len(calls) == 1 and text not in calls and all(len(k) < 100 for k in calls)
