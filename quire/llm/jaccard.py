"""N-gram Jaccard join by vertical partitioning of the n-gram order.

All distinct 5-word shingles have a global order: by how often their hash
bucket occurs over all documents, rarest first, then by hash. Documents with
equal shingle sets form a class and one of them stands for it. Two classes can
only reach the similarity when they share one of the rarest n-grams of both
(prefix), which gives the candidate pairs. The order is cut into fragments;
a class's n-grams fall into one segment per fragment, the overlaps of a
candidate pair are counted for each fragment on its own, and the partial
overlaps are summed per pair.

Prefixes travel packed: one row per run of texts and part of the hash space,
four bytes an n-gram, so that they are shuffled once and cheaply; n-grams whose
frequency bucket is very large go row by row instead, so no task ever gathers
their occurrences.

Candidates are not all pairs of a bucket: first every class is paired with one
smallest member only, the one it shares most prefix n-grams with; then, in a
few rounds, with a centre of each n-gram, the class of which most is shared,
if that is of another component as far as known. What is linked so far is one
component, and at last all pairs of different components are tried whose first shared n-gram
leaves enough behind it. No link between components is lost, and a group of
near copies costs about as much as it has members.

Defined results: null, empty and wordless texts have no shingles and are
linked with nothing; repeated rows share a class; a null doc_id counts as no
id, so its row has the component of its links, or null without any.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components

SHINGLE = 5
WORD = r"[^ \t\n\x0B\f\r]"
SIMILAR = (3, 4)      # similarity of at least 3/4
SKETCH_BITS = 21      # buckets of the n-gram frequency sketch: 2^21, whatever the input
FRAGMENTS = 4
PART = 1 << 18        # prefix n-grams in a part of the hash space, about
ROUNDS = 5            # rounds of one centre per n-gram, at most, before pairs across components
MANY = 4              # rounds also go on while pairs across components are more than so many to a posting
FEW = 100             # rounds go on while one links at least this fraction of the classes that are left
HOT = 1 << 20         # documents in a frequency bucket from which its n-grams are not gathered in a part


def shingle_sets(texts: list[str | None], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, flat, and the number of them per text."""
    w = C.Words(texts, lower=True)
    h = w.hashes()
    grams, at = w.ngrams(h, n)
    doc = w.doc()[at]
    short = np.flatnonzero((w.count > 0) & (w.count < n))  # the whole sequence as one
    whole = np.array([_whole(h[w.first[d]:w.first[d + 1]]) for d in short], np.uint64)
    grams, doc = np.concatenate([grams, whole]), np.concatenate([doc, short])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    return grams[new], np.bincount(doc[new], minlength=len(texts))


def _whole(h: np.ndarray) -> int:
    return C.roll(np.concatenate([h, np.full(1, len(h), np.uint64)]), np.zeros(1, np.int64), len(h) + 1)[0]


def bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def sketch(docs: DataFrame) -> np.ndarray:
    """Documents per n-gram bucket, over all documents: a vector of fixed length, summed in chunks."""
    chunks = 1 << max(0, SKETCH_BITS - 12)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for b in batches:
            texts = b["text"].tolist()
            for s in C.text_slices(texts):
                at, n = np.unique(bucket(shingle_sets(texts[s])[0]), return_counts=True)
                total[at] += n.astype(np.uint32)
            del b, texts
            C.trimmed()
        parts = total.reshape(chunks, -1)
        used = np.flatnonzero(parts.any(axis=1))
        yield pd.DataFrame({"chunk": used, "n": [parts[i].tobytes() for i in used]})
        del total, parts
        C.trimmed()

    def add(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in b["n"])
        return pd.DataFrame({"chunk": [key[0]], "n": [np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()]})

    part = docs.select("text").mapInPandas(count, "chunk long, n binary")
    out = np.zeros((chunks, (1 << SKETCH_BITS) // chunks), np.int32)
    with C.cleaned(docs.sparkSession):
        for r in part.groupBy("chunk").applyInPandas(add, "chunk long, n binary").toPandas().itertuples():
            out[r.chunk] = np.frombuffer(r.n, np.int32)
    return out.ravel()


def cuts(freq: np.ndarray, fragments: int = FRAGMENTS) -> np.ndarray:
    """Bucket counts at which the order is cut, so that fragments hold about equal shares of all occurrences."""
    order = np.sort(freq)
    mass = np.cumsum(order, dtype=np.int64)
    if not mass[-1]:
        return np.zeros(0, np.int64)
    return np.unique(order[np.searchsorted(mass, mass[-1] * np.arange(1, fragments) / fragments)])


def needed(n: int | np.ndarray) -> int | np.ndarray:
    """Size of the smallest set that a set of n can be similar to, as well as the overlap with it: ceil(3n/4)."""
    return -(-SIMILAR[0] * n // SIMILAR[1])


def signatures(docs: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Columns of docs (but text), plus n (set size), s1 and s2 (hash of the set). names: other names for those."""
    names = names or {"n": "n", "s1": "s1", "s2": "s2"}

    def make(cols: dict[str, list]) -> dict:
        grams, n = shingle_sets(cols["text"])
        one, two = _set_hashes(grams, n)
        return {names["n"]: n, names["s1"]: one, names["s2"]: two}

    return C.by_rows(docs, ["text"], ", ".join(f"{names[k]} long" for k in ("n", "s1", "s2")), make, drop=["text"])


def _set_hashes(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate([[0], np.cumsum(n)])
    one = _sums(C.mix(grams + np.uint64(0x1234567)), first)
    two = _sums(C.mix(grams ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93), first)
    return one.view(np.int64), two.view(np.int64)


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text, and the columns of `wanted`) of the documents that stand for the wanted classes.

    wanted: (first_id, n, s1, ...). A document of that id whose set is another
    one comes along; what reads the rows compares n and s1.
    """
    return docs.select(F.col("doc_id").alias("_id"), "text").join(
        C.checked_broadcast(wanted, 64), F.col("_id").eqNullSafe(F.col("first_id"))).drop("_id", "first_id")


def postings(docs: DataFrame, classes: DataFrame, order: Broadcast, part: int = PART, hot: int = HOT,
             stage: Callable[[DataFrame, str], DataFrame] = C.staged) -> DataFrame:
    """(h, cid, n, pos, low, n_low, pos_low): prefix n-grams that several classes share, with the smallest class of each.

    pos: a lower bound of the n-gram's place in the class's order. order:
    the n-gram frequencies and the cuts between fragments. stage: writes the
    result, as of C.staged().
    """
    total = C.only_row(classes.agg(F.sum(F.col("n") - F.ceil(F.col("n") * SIMILAR[0] / SIMILAR[1]) + 1)))[0] or 0
    parts = max(1, int(total) // part)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for s in C.text_slices(texts):
                rows = b.iloc[s]
                grams, n = shingle_sets(texts[s])
                ok = (n == rows["n"].to_numpy()) & (_set_hashes(grams, n)[0] == rows["s1"].to_numpy())
                first = np.concatenate([[0], np.cumsum(n)])
                often = order.value[0][bucket(grams)]
                ranks = np.lexsort((grams, often, np.repeat(np.arange(len(n)), n)))
                keep = np.where(ok, n - needed(n) + 1, 0)
                at = C.spans(first[:-1], keep)
                own = np.repeat(np.arange(len(n)), keep)
                pos = at - first[own]
                h, often = grams[ranks[at]], often[ranks[at]]
                where = np.where(often >= hot, -1, ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64))
                cid = rows["cid"].to_numpy(np.int64)
                out = []
                by = np.argsort(where, kind="stable")
                cut = np.flatnonzero(np.diff(where[by], prepend=-2))
                for i, j in zip(cut, [*cut[1:], len(by)], strict=True):
                    e = by[i:j]  # texts in order, so each text's entries are one run
                    run = np.flatnonzero(np.diff(own[e], prepend=-1))
                    who = own[e][run]
                    out.append((where[e[0]], cid[who].tobytes(), n[who].astype("<i8").tobytes(),
                                np.diff(run, append=j - i).astype("<i4").tobytes(),
                                h[e].astype("<u4").tobytes() if where[e[0]] >= 0 else h[e].tobytes(),
                                (pos[e] * 256 // keep[own[e]]).astype(np.uint8).tobytes()))
                yield pd.DataFrame(out, columns=["part", "cids", "ns", "runs", "hs", "ps"])
                del out, rows
            del b, texts
            C.trimmed()

    rows = texts_of(docs, classes.select("cid", "first_id", "n", "s1")).mapInPandas(
        packed, "part long, cids binary, ns binary, runs binary, hs binary, ps binary")

    def opened(b: pd.DataFrame, kind: str) -> tuple[np.ndarray, ...]:
        join = lambda c, t: np.frombuffer(b"".join(b[c]), t)
        runs, n = join("runs", "<i4"), join("ns", "<i8")
        return (join("hs", kind), np.repeat(join("cids", "<i8"), runs), np.repeat(n, runs),
                (join("ps", np.uint8).astype(np.int64) * np.repeat(n - needed(n) + 1, runs)) >> 8)

    def meet(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        C.trimmed()
        h, cid, n, pos = opened(b, "<u4")
        del b
        order = np.lexsort((pos, cid, h))
        h, cid, n, pos = h[order], cid[order], n[order], pos[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (cid[1:] != cid[:-1])  # repeated rows say the same
        h, cid, n, pos = h[new], cid[new], n[new], pos[new]
        start = np.flatnonzero(np.diff(h, prepend=-1 if not len(h) else int(h[0]) + 1))
        size = np.diff(start, append=len(h))
        low, many = np.repeat(start, size), np.repeat(size, size) > 1
        low = low[many]
        return pd.DataFrame({"h": h[many].astype(np.int64) + (int(key[0]) << 32), "cid": cid[many], "n": n[many], "pos": pos[many],
                             "low": cid[low], "n_low": n[low], "pos_low": pos[low]})

    ddl = "h long, cid long, n long, pos long, low long, n_low long, pos_low long"

    def apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h, cid, n, pos = opened(b, "<i8")
            yield pd.DataFrame({"h": h, "cid": cid, "n": n, "pos": pos})

    with C.Scratch(docs.sparkSession) as held:
        rows = held(rows, "prefixes")
        cold = rows.where("part >= 0").groupBy("part").applyInPandas(meet, ddl)
        if not C.counted(rows.where("part < 0").limit(1)):
            return stage(cold, "postings")
        frequent = held(rows.where("part < 0").mapInPandas(apart, "h long, cid long, n long, pos long"), "frequent")
        least = frequent.groupBy("h").agg(F.min(F.struct("cid", "n", "pos")).alias("l"), F.max("cid").alias("high")).where("l.cid <> high")
        least = least.select("h", F.col("l.cid").alias("low"), F.col("l.n").alias("n_low"), F.col("l.pos").alias("pos_low"))
        return stage(cold.unionByName(frequent.join(least, "h").dropDuplicates(["h", "cid"])), "postings")


def _sizes(n: str, m: str):
    return SIMILAR[1] * F.least(n, m) >= SIMILAR[0] * F.greatest(n, m)


def _possible(*c: str):
    """Both sizes are near enough, and from the shared n-gram on enough is left of both. c: n, pos of one and the other."""
    n, pos, m, at = map(F.col, c)
    left = F.least(n - pos, m - at)
    return _sizes(n, m) & (left * (SIMILAR[0] + SIMILAR[1]) >= (n + m) * SIMILAR[0])


def segments(docs: DataFrame, wanted: DataFrame, order: Broadcast) -> DataFrame:
    """(columns of wanted but first_id and s1, segments): the n-grams of wanted classes, an array for each fragment of the order."""

    def make(cols: dict[str, list]) -> dict:
        freq, at = order.value
        grams, n = shingle_sets(cols["text"])
        ok = (n == np.array(cols["n"])) & (_set_hashes(grams, n)[0] == np.array(cols["s1"]))
        first = np.concatenate([[0], np.cumsum(n)])
        part = np.searchsorted(at, freq[bucket(grams)], side="left")
        out = []
        for i in range(len(n)):
            g, p = grams[first[i]:first[i + 1]].view(np.int64), part[first[i]:first[i + 1]]
            out.append([g[p == f] for f in range(FRAGMENTS)] if ok[i] else None)
        return {"segments": out}

    made = C.by_rows(texts_of(docs, wanted), ["text", "n", "s1"], "segments array<array<long>>", make, drop=["text", "s1"])
    return made.where("segments IS NOT NULL")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, order: Broadcast, one_each: bool = False,
             stage: Callable[[DataFrame, str], DataFrame] = C.staged) -> DataFrame:
    """The pairs (a, b) whose summed partial overlaps reach the similarity.

    The n-grams of b travel to those of a, cut into the fragments; they are
    made from the texts once per class on the way, so no table of n-grams is
    written. One row per pair: its overlap is counted fragment by fragment.
    one_each: every b has one a, so its n-grams are shuffled once only.
    stage: writes the result, as of C.staged().
    """
    sets = classes.select("cid", "first_id", "n", "s1")
    with C.Scratch(docs.sparkSession) as held:
        centres = held(sets.join(pairs.select(F.col("a").alias("cid")).distinct(), "cid"), "centres")
        left = segments(docs, centres, order).select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("segments").alias("ga"))
        named = (F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("segments").alias("gb"))
        if one_each:  # a comes along on the way from the text
            members = held(sets.join(pairs.select("a", F.col("b").alias("cid")), "cid"), "members")
            right = segments(docs, members, order).select("a", *named)
        else:
            members = held(sets.join(pairs.select(F.col("b").alias("cid")).distinct(), "cid"), "members")
            right = pairs.select("a", "b").join(segments(docs, members, order).select(*named), "b")
        partial = [F.size(F.array_intersect(F.col("ga")[f], F.col("gb")[f])) for f in range(FRAGMENTS)]
        over = right.join(left, "a").select("a", "b", "na", "nb", sum(partial[1:], partial[0]).alias("o"))
        return stage(over.where(F.col("o") * SIMILAR[1] >= (F.col("na") + F.col("nb") - F.col("o")) * SIMILAR[0]).select(
            "a", "b").distinct(), "links")  # repeated rows say the same


def _best(counted: DataFrame) -> DataFrame:
    """(a, b): for each class b its centre a with which it shares most prefix n-grams, and their roots if known.

    counted: (cid, low, count), and root of cid, root_low of low.
    """
    roots = [c for c in ("root", "root_low") if c in counted.columns]
    best = counted.groupBy("cid").agg(F.max(F.struct("count", (-F.col("low")).alias("col2"), *roots)).alias("m"))
    return best.select((-F.col("m.col2")).alias("a"), F.col("cid").alias("b"), *[F.col(f"m.{c}") for c in roots])


def _near_roots(links: DataFrame) -> DataFrame:
    """(node, root): the smallest of each linked node's neighbours and their neighbours, itself included.

    Of one component, but not always the same for all of it: what stays apart
    is tried again, which costs less than exact components in every round.
    """
    both = links.union(links.select("b", "a"))
    near = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
    return both.join(near, "b").groupBy(F.col("a").alias("node")).agg(F.min("m").alias("root"))


def _mixed(posts: DataFrame, roots: DataFrame) -> DataFrame:
    """posts with the roots of their roots: the postings of those n-grams that still belong to more than one."""
    new = roots.select(F.col("node").alias("root"), F.col("root").alias("new"))
    own = posts.join(new, "root", "left").withColumn("root", F.coalesce("new", "root")).drop("new")
    mixed = own.groupBy("h").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("h")
    return own.join(mixed, "h")


def _stars(rest: DataFrame, seed: int) -> DataFrame:
    """(cid, root, low, root_low, count): each class with the centres, of other components, of its n-grams.

    Centres of an n-gram: the class of which most of the prefix is shared with
    others (in a group of near copies the one with the fewest changes), and
    the class that `seed` puts first.
    """
    cols = ("cid", "n", "pos", "root")
    by = {"c0": F.struct((-F.col("share")).alias("o"), F.xxhash64("cid", F.lit(seed)).alias("t"), *cols),
          "c1": F.struct(F.lit(0.0).alias("o"), F.xxhash64("cid", F.lit(-seed)).alias("t"), *cols)}
    centre = rest.groupBy("h").agg(*[F.min(v).alias(k) for k, v in by.items()]).select(
        "h", F.explode(F.array_distinct(F.array(*[F.struct(*[f"{k}.{c}" for c in cols]) for k in by]))).alias("c"))
    centre = centre.select("h", *[F.col(f"c.{c}").alias(f"{c}_low") for c in cols])
    met = rest.join(centre, "h").where((F.col("root") != F.col("root_low")) & _possible("n", "pos", "n_low", "pos_low"))
    return met.groupBy("cid", "root", F.col("cid_low").alias("low"), "root_low").count()


def link_classes(classes: DataFrame, docs: DataFrame, order: Broadcast, rounds: int = ROUNDS,
                 stage: Callable[[DataFrame, str], DataFrame] = C.staged, **options) -> DataFrame:
    """(a, b) links that connect all similar classes. classes: (cid, n, s1, s2, first_id).

    rounds: how often classes are paired with one centre each before all pairs
    that are left between components are tried; no effect on what is connected.
    stage: writes the result, as of C.staged().
    """
    spark = docs.sparkSession
    with C.Scratch(spark) as held:  # tables of all rounds; those of one round go with it
        with C.Scratch(spark) as first:
            posts = postings(docs, classes, order, stage=first, **options)
            stars = posts.where(F.col("cid") != F.col("low")).where(_possible("n", "pos", "n_low", "pos_low")).groupBy("cid", "low").count()
            tried = held(_best(stars), "stars")
            links = verified(tried, classes, docs, order, True, held)
            prefix = F.col("n") - F.ceil(F.col("n") * SIMILAR[0] / SIMILAR[1]) + 1
            share = posts.groupBy("cid", "n").count().select("cid", (F.col("count") / prefix).alias("share"))
            last = C.Scratch(spark)
            rest = last(_mixed(posts.select("h", "cid", "n", "pos", F.col("cid").alias("root")).join(share, "cid"),
                               components(links, stage=first)), "mixed")
        found = C.counted(links)
        for k in range(1, rounds + 1):
            size = rest.groupBy("h", "root").count().groupBy("h").agg(F.sum("count").alias("m"), F.sum(F.col("count") * F.col("count")).alias("own"))
            held_by, across = C.only_row(size.agg(
                F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.sum((F.col("m") * F.col("m") - F.col("own")) / 2), F.lit(0))))
            if not found or (found * FEW < C.counted(rest.select("cid").distinct()) and across <= MANY * held_by):
                break
            pairs = held(_best(_stars(rest, k).join(
                tried.select(F.col("b").alias("cid"), F.col("a").alias("low")), ["cid", "low"], "left_anti")), "stars")
            more = verified(pairs, classes, docs, order, True, held)
            found = C.counted(more)
            tried, links = tried.union(pairs.select("a", "b")), links.union(more)
            if found:
                now = C.Scratch(spark)
                with last, C.Scratch(spark) as here:
                    met = here(more.join(pairs, ["a", "b"]).select(F.col("root_low").alias("a"), F.col("root").alias("b")).distinct(), "met")
                    rest = now(_mixed(rest, here(_near_roots(met), "roots")), "mixed")
                last = now
        with last:
            x, y = (rest.select("h", *[F.col(c).alias(f"{c}_{k}") for c in ("cid", "n", "pos", "root")]) for k in "xy")
            # what a similar pair shares first has enough left behind it in both
            cross = x.join(y, "h").where((F.col("root_x") != F.col("root_y")) & (F.col("cid_x") < F.col("cid_y")) & _possible(
                "n_x", "pos_x", "n_y", "pos_y")).select(F.col("cid_x").alias("a"), F.col("cid_y").alias("b")).distinct()
            done = tried.union(tried.select("b", "a"))
            more = held(cross.join(done, ["a", "b"], "left_anti"), "cross")
        if C.counted(more.limit(1)):
            links = links.union(verified(more, classes, docs, order, stage=held))
        return stage(links, "links")


def grouped(docs: DataFrame, rows: DataFrame, names: dict[str, str],
            stage: Callable[[DataFrame, str], DataFrame] = C.staged, **options) -> DataFrame:
    """(cid, n, s1, s2, first_id, root): the classes of equal shingle sets and the component of each.

    docs: (doc_id, text); rows: their signatures, under `names`; stage: writes
    what the result is read from, as of C.staged().
    """
    freq = sketch(docs)
    order = docs.sparkSession.sparkContext.broadcast((freq, cuts(freq)))  # of fixed size, one for all steps
    sets = rows.select("doc_id", *[F.col(v).alias(k) for k, v in names.items()])
    classes = stage(sets.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("first_id")).withColumn(
        "cid", F.monotonically_increasing_id()), "classes")
    with C.Scratch(docs.sparkSession) as held:
        roots = components(link_classes(classes, docs, order, stage=held, **options), stage=stage)
    order.destroy()
    return classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))


NAMES = {"n": "_jj_n", "s1": "_jj_s1", "s2": "_jj_s2"}


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """Columns of docs but text, plus n_shingles and component_id (smallest linked doc_id).

    docs: (doc_id, text, ...); options: as of postings().
    """
    C.prepare(docs.sparkSession)
    docs = docs.drop(*[c for c in ("n_shingles", "component_id") if c in docs.columns])
    rows = C.staged(signatures(docs, NAMES), "signatures")
    named = grouped(docs.select("doc_id", "text"), rows, NAMES, **options)
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    table = named.join(least, "root").select(*[F.col(k).alias(v) for k, v in NAMES.items()], "component_id")
    size = F.col(NAMES["n"])
    return rows.join(table, list(NAMES.values()), "left").select(
        *[c for c in docs.columns if c != "text"], size.alias("n_shingles"),
        F.when(size > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def representatives(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay when of each component one row does: that of the smallest doc_id.

    Rows without shingles are linked with nothing and all stay; of repeated
    rows one stays. All columns stay as they are.
    """
    C.prepare(docs.sparkSession)
    pure = docs.select("doc_id", "text")
    with C.Scratch(docs.sparkSession) as held:
        found = held(signatures(pure.withColumn("_jj_t", F.xxhash64("text")), NAMES), "signatures")
        named = grouped(pure, found, NAMES, held, **options)
        best = named.groupBy("root").agg(F.min(F.struct(
            F.col("first_id").isNull().alias("no_id"), "first_id", "cid", "n", "s1", "s2")).alias("b")).select(
                "root", F.col("b.first_id").alias("_jj_id"), *[F.col(f"b.{k}").alias(f"{v}_best") for k, v in NAMES.items()])
        same = F.col("doc_id").eqNullSafe(F.col("_jj_id"))
        for v in NAMES.values():
            same = same & (F.col(v) == F.col(f"{v}_best"))
        stands = C.staged(found.join(best, same), "stands")  # rows that could stay; of a group with several texts of one id, one text does
    one = stands.groupBy("root", "_jj_id").agg(F.min("_jj_t").alias("_jj_text")).drop("root")
    several = C.counted(stands.groupBy("root").count().where("count > 1").limit(1))
    chosen = docs.join(C.checked_broadcast(one.withColumn("_jj_best", F.lit(True)), 64), F.col("doc_id").eqNullSafe(F.col("_jj_id"))
                       & (F.xxhash64("text") == F.col("_jj_text")), "left")
    held = chosen.where(F.col("_jj_best") | ~F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    if several:  # repeated rows: one of them stays
        held = held.where("_jj_best").dropDuplicates(["doc_id", "text"]).unionByName(held.where("_jj_best IS NULL"))
    return held.select(*docs.columns)
