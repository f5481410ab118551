"""Named rule sets (length, words, excluded patterns, paragraphs) as Columns.

A rule set yields NULL when an item passes, else the reason `name:check`.
A chain of rule sets yields the first failing reason in list order; unknown
names are skipped and an empty list passes everything.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import regex as R
from quire.functions import text as T
from quire.session import RESOURCE_BYTES, bounded_broadcast

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RuleSet:
    name: str
    min_length: int = 0
    min_words: int = 0
    exclude_patterns: tuple[str, ...] = ()
    require_paragraphs: bool = False
    compiled: tuple[tuple[str, str], ...] = field(default=(), compare=False)


# The rule sets used by the bundled queries.
DEFAULT_RULE_SETS = {
    "quality": dict(min_length=300, min_words=80,
                    exclude_patterns=["(?i)copyright|license"], require_paragraphs=True),
    "privacy": dict(min_words=5,
                    exclude_patterns=[r"[A-Za-z0-9._]+@[A-Za-z0-9.]+\.[a-z]+",
                                      r"(?=lookahead)",
                                      r'token = "[0-9a-f]+',
                                      r"\b[0-9]{1,3}(\.[0-9]{1,3}){3}\b",
                                      r"[0-9]{16}"]),
}


# The rule-set list of the flagship report: applied in this order.
FLAGSHIP_LIST = ["quality", "privacy"]


def compile_rule_sets(config: dict[str, dict]) -> dict[str, RuleSet]:
    """Driver-side compilation; invalid patterns are dropped with a warning."""
    out = {}
    for name, c in config.items():
        pats = tuple(c.get("exclude_patterns") or ())
        out[name] = RuleSet(name=name, min_length=int(c.get("min_length") or 0),
                            min_words=int(c.get("min_words") or 0), exclude_patterns=pats,
                            require_paragraphs=bool(c.get("require_paragraphs") or False),
                            compiled=tuple(R.compile_patterns(name, list(pats))))
    return out


def rule_reason(text: Column, rs: RuleSet, words: Column | None = None) -> Column:
    """Checks in order length, words, patterns, paragraphs; first failure wins."""
    checks: list[tuple[Column, str]] = []
    if rs.min_length > 0:
        checks.append((T.byte_length(text) < rs.min_length, f"{rs.name}:min_length"))
    if rs.min_words > 0:
        checks.append(((words if words is not None else T.word_count(text)) < rs.min_words, f"{rs.name}:min_words"))
    for original, java in rs.compiled:
        checks.append((text.rlike(java), f"{rs.name}:exclude_pattern[{original}]"))
    if rs.require_paragraphs:
        checks.append((~T.has_paragraphs(text), f"{rs.name}:require_paragraphs"))
    if not checks:
        return F.lit(None).cast("string")
    expr = None
    for cond, reason in checks:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def chain_reason(text: Column, names: list[str], rule_sets: dict[str, RuleSet],
                 words: Column | None = None) -> Column:
    parts = []
    for n in names or []:
        if n not in rule_sets:
            log.warning("filter not found, skipping: %s", n)
            continue
        parts.append(rule_reason(text, rule_sets[n], words))
    if not parts:
        return F.lit(None).cast("string")
    return parts[0] if len(parts) == 1 else F.coalesce(*parts)


def _with_text(items: DataFrame, rule_sets: dict[str, RuleSet], names) -> tuple[DataFrame, Column, Column | None]:
    """The filter text and (when a rule needs it) its word count, computed once
    per row as columns so that every check reads them instead of re-deriving."""
    df = items.withColumn("_ftext", T.filter_text(F.col("title"), F.col("description")))
    used = [rule_sets[n] for n in names if n in rule_sets]
    if any(r.min_words > 0 for r in used):
        df = df.withColumn("_words", T.word_count(F.col("_ftext")))
        return df, F.col("_ftext"), F.col("_words")
    return df, F.col("_ftext"), None


def apply_rules(items: DataFrame, names: list[str], rule_sets: dict[str, RuleSet]) -> DataFrame:
    """Add `reason` (NULL = kept) and `include` for one fixed rule-set list."""
    df, text, words = _with_text(items, rule_sets, names or [])
    return (df.withColumn("reason", chain_reason(text, names, rule_sets, words))
            .withColumn("include", F.col("reason").isNull()).drop("_ftext", "_words"))


def pattern_matches(texts: DataFrame, patterns: list[str], text: str = "text") -> DataFrame:
    """(columns but the text, pattern_no): the patterns that each text matches; refused patterns match nothing.

    One pass over the texts, all patterns in one projection.
    """
    valid = [(i, java) for i, p in enumerate(patterns) for _, java in R.compile_patterns("patterns", [p])]
    hits = F.filter(F.array(*[F.when(T.s(text).rlike(java), F.lit(i)) for i, java in valid]), lambda x: x.isNotNull())
    return texts.select(*[c for c in texts.columns if c != text], F.explode(hits).alias("pattern_no"))


def resource_filter_lists(resources: DataFrame, max_lists: int = 10_000) -> list[list[str]]:
    """Distinct filter lists of the configuration (a small, bounded table)."""
    rows = resources.select("filters").distinct().limit(max_lists + 1).collect()
    if len(rows) > max_lists:
        raise ValueError("too many distinct filter lists in the resource configuration")
    return [list(r["filters"] or []) for r in rows]


def apply_resource_rules(items: DataFrame, resources: DataFrame, rule_sets: dict[str, RuleSet],
                         filter_lists: list[list[str]] | None = None) -> DataFrame:
    """Each item gets the rule-set list of its resource (joined on resource_pos)."""
    if filter_lists is None:
        filter_lists = resource_filter_lists(resources)
    res = bounded_broadcast(resources.select(
        "resource_pos", F.array_join(F.coalesce("filters", F.array().cast("array<string>")), ",")
        .alias("_fkey")), row_bytes=RESOURCE_BYTES)
    all_names = sorted({n for lst in filter_lists for n in lst})
    j, text, words = _with_text(items.join(res, "resource_pos"), rule_sets, all_names)
    reason = None
    for lst in sorted({tuple(x) for x in filter_lists}):
        r = chain_reason(text, list(lst), rule_sets, words)
        cond = F.col("_fkey") == ",".join(lst)
        reason = F.when(cond, r) if reason is None else reason.when(cond, r)
    if reason is None:
        reason = F.lit(None).cast("string")
    return (j.withColumn("reason", reason).drop("_fkey", "_ftext", "_words")
            .withColumn("include", F.col("reason").isNull()))


def rejections(decided: DataFrame) -> DataFrame:
    """The filtered items: (item, reason, url), as the run logs them."""
    return decided.where(F.col("reason").isNotNull()).select("item_pos", "reason", "link")


def rejection_report(decided: DataFrame) -> DataFrame:
    """Reason counts; kept items are counted under 'kept'."""
    return (decided.groupBy(F.coalesce("reason", F.lit("kept")).alias("verdict"))
            .agg(F.count(F.lit(1)).alias("n")))
