"""Operator 9, near-duplicates: one-permutation MinHash with optimal
densification, banded buckets and star-shaped candidate links.

1. Each text's set of distinct 5-word shingles is hashed once; the hash range
   is split into BINS bins, a bin's value is its least hash, and an empty bin
   takes the value of the first non-empty bin in its own fixed random order
   (densification).  Equal sets form a class; what follows is on classes, so
   copies cost nothing.
2. ROWS bins make a band; classes that agree on a band share a bucket.  At a
   similarity of 0.75 a pair misses all bands with probability
   (1 - 0.75^4)^32 = 5e-6.
3. A bucket links its members to one centre, the member that shares the most
   buckets, not to each other.  Links are confirmed on the full sets.
4. Buckets whose members are then in several components are looked at
   again: a task compares the members outside the bucket's largest component
   with all others by their sketches (no pairs are emitted for that; large
   buckets are dealt in blocks).  Pairs of short texts that are alike enough
   are confirmed there and then on their full sets, which come along; pairs
   with a long text are named once and confirmed as in step 3.  So no link is
   lost that the star's shape hides.
5. Components of the confirmed links.

Edge cases: a text without words (or null) has an empty set, is linked with
nothing and is its own component; fewer than five words are one shingle;
repeated rows are one class; null doc_ids are never the least of a component
that has an id; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, land, packed, read, send_with_tasks, unpacked
from .components import components

send_with_tasks(__name__)

SHINGLE, PERCENT = 5, 75
BINS, ROWS = 128, 4
#: a pair is compared on full sets unless its sketches agree on fewer bins; at
#: a similarity of 0.75 that is four standard deviations below the mean.  Where
#: bins share shingles they are not independent, so sets of up to SHORT
#: shingles are compared whatever their sketches say
LEAST_BINS = 76
#: sets up to this size travel with the sketches; members of a block
SHORT, BLOCK = 512, 2048

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], dtype=np.uint64)
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
_ORDER = np.array([np.random.default_rng(7919 + i).permutation(BINS) for i in range(BINS)])


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()   # A-Z only; the six ASCII spaces
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(n, size)
    x = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        x += h[j:n - k + 1 + j] * _ODD[j % len(_ODD)]
        x ^= x >> np.uint64(29)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.unique(x ^ (x >> np.uint64(31)))


def sketch(s: np.ndarray) -> np.ndarray:
    """16 bits of each bin's least hash, as int64 words of four bins (a band)."""
    first = np.searchsorted(s, _EDGES)
    full = first < np.append(first[1:], len(s))
    low = np.zeros(BINS, np.uint16)
    low[full] = (s[first[full]] & np.uint64(0xFFFF)).astype(np.uint16)
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _ORDER[empty]
        low[empty] = low[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return low.view(np.int64)


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for key, mark, text in zip(pdf["doc_id"], pdf["mark"], pdf["t"]):
            s = shingles(text)
            rows.append((key, mark, len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None,
                         sketch(s) if len(s) else None))
        yield pd.DataFrame(rows, columns=["doc_id", "mark", "n", "c", "sig"])


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for c, text in zip(pdf["c"], pdf["t"]):
            rows.append((c, shingles(text).view(np.int64)))
        yield pd.DataFrame(rows, columns=["c", "s"])


def _agreeing() -> Column:
    """How many bins of the sketches sig_a and sig_b agree."""
    lanes = " + ".join(f"cast((shiftrightunsigned(x, {s}) & 65535L) = 0 as int)" for s in (0, 16, 32, 48))
    return F.expr(f"aggregate(zip_with(sig_a, sig_b, (p, q) -> p ^ q), 0, (n, x) -> n + {lanes})")


def _pairs(df: DataFrame) -> DataFrame:
    """Distinct unordered pairs of df(a, b)."""
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sizes and sketches allow the similarity."""
    side = lambda x: classes.select(F.col("c").alias(x), F.col("n").alias(f"n_{x}"),
                                    F.col("sig").alias(f"sig_{x}"))
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(100 * small >= PERCENT * large)
            .filter((large <= SHORT) | (_agreeing() >= LEAST_BINS)).select("a", "b"))


def _sets_of(ends: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(c, s): the full sets of the classes ends(c), written."""
    owner = classes.join(ends, "c").select("c", "doc_id", "mark")
    found = texts.join(owner.withColumnRenamed("doc_id", "_id"),
                       F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("own_mark") == F.col("mark")))
    return land(found.dropDuplicates(["c"]).select("c", "t").mapInPandas(_sets, "c binary, s array<long>"),
                "near-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    side = lambda x: sets.select(F.col("c").alias(x), F.col("s").alias(f"s_{x}"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(100 * both >= PERCENT * (F.size("s_a") + F.size("s_b") - both)).select("a", "b"))


def _compare(g: pd.DataFrame) -> list[tuple]:
    """(a, b, sure) of one block: members outside the bucket's largest component
    with members of other components.  Short texts: confirmed links, one per
    component; others: pairs that are plausible, in the first band they share."""
    role = g["role"].to_numpy()
    mine, theirs = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
    found: list[tuple] = []
    if not len(mine) or not len(theirs):
        return found
    c, n, s, band = g["c"].to_numpy(), g["n"].to_numpy(), g["s"].to_numpy(), g["band"].iloc[0]
    words = np.stack(g["sig"].to_list())
    sig, root = words.view(np.uint16), pd.factorize(g["root"])[0]
    other, m, r = sig[theirs], n[theirs], root[theirs]
    for i in mine:
        at = np.flatnonzero((r != root[i]) & (100 * np.minimum(m, n[i]) >= PERCENT * np.maximum(m, n[i])))
        agree = (other[at] == sig[i]).sum(axis=1)
        fits = (agree >= LEAST_BINS) | (np.maximum(m[at], n[i]) <= SHORT)
        at = theirs[at[fits][np.argsort(-agree[fits], kind="stable")]]
        at = at[(words[at] == words[i]).argmax(axis=1) == band] if len(at) else at
        linked = set()
        for j in at:
            if root[j] in linked:
                continue
            if s[i] is None or s[j] is None:
                found.append((c[i], c[j], False))
                continue
            both = len(np.intersect1d(s[i], s[j], assume_unique=True))
            if 100 * both >= PERCENT * (n[i] + n[j] - both):
                found.append((c[i], c[j], True))
                linked.add(root[j])
    return found


def _crossing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``_compare`` for all blocks of a partition that is sorted by block."""
    left: list[pd.DataFrame] = []                  # the rows of a block that may go on
    for pdf in batches:
        left.append(pdf)
        if not len(pdf) or left[0]["g"].iloc[0] == pdf["g"].iloc[-1]:
            continue
        whole = pd.concat(left, ignore_index=True)
        g = whole["g"].to_numpy()
        cuts = np.append(0, np.flatnonzero(g[1:] != g[:-1]) + 1)
        found = [x for a, b in zip(cuts[:-1], cuts[1:]) for x in _compare(whole.iloc[a:b])]
        left = [whole.iloc[cuts[-1]:]]
        yield pd.DataFrame(found, columns=["a", "b", "sure"])
    if left:
        yield pd.DataFrame(_compare(pd.concat(left, ignore_index=True)), columns=["a", "b", "sure"])


def _torn(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components: band, key, c, k
    (members of the bucket), root, main (the bucket's largest component)."""
    bucket = ["band", "key"]
    m = members.join(components(links).withColumnRenamed("node", "c"), "c", "left")
    m = m.select(*bucket, "c", "k", F.coalesce("root", "c").alias("root"))
    torn = m.groupBy(*bucket, "root").agg(F.count("*").alias("q")).groupBy(*bucket).agg(
        F.count("*").alias("roots"), F.max_by("root", F.struct("q", "root")).alias("main")).filter("roots > 1")
    return m.join(torn.select(*bucket, "main"), bucket)


def _crossings(torn: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, sure): confirmed links and plausible pairs across components."""
    m = torn.join(classes.select("c", "n", "sig"), "c").join(sets, "c", "left")
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    m = m.withColumns({"blocks": blocks, "own": F.pmod(F.hash("c"), blocks)})
    to = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to")
    cols = ["band", "key", "c", "root", "n", "sig", "s"]
    out = m.filter("root <> main").select(*cols, F.col("own").alias("i"), to).select(
        *cols, "i", F.col("to").alias("j"), F.lit(0).alias("role"))
    other = m.select(*cols, F.col("own").alias("j"), to).select(
        *cols, F.col("to").alias("i"), "j", F.lit(1).alias("role"))
    blocked = out.unionByName(other).select(
        F.xxhash64("band", "key", "i", "j").alias("g"), "band", "role", "c", "root", "n", "sig", "s")
    found = blocked.repartition("g").sortWithinPartitions("g").mapInPandas(
        _crossing, "a binary, b binary, sure boolean")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sure").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, mark (hash of the text), n_shingles, component_id and root (the
    class that names the component, null without words) of every row."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), t.alias("t"),
                        F.xxhash64(t).alias("own_mark"))
    rows = land(texts.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("own_mark").alias("mark"), "t")
                .mapInPandas(_sketches, "doc_id string, mark long, n long, c binary, sig array<long>")
                .withColumn("doc_id", F.col("doc_id").cast("long")), "near-rows")
    classes = land(rows.filter("c is not null").groupBy("c").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"),
        F.min_by("mark", F.coalesce("doc_id", F.lit(2**63 - 1))).alias("mark"),
        F.first("n").alias("n"), F.first("sig").alias("sig")), "near-classes")
    banded = classes.select("c", F.posexplode("sig").alias("band", "key"))
    bucket = ["band", "key"]
    shared = banded.groupBy(*bucket).agg(F.count("*").alias("k")).filter("k > 1")
    members = land(banded.join(shared, bucket), "near-members")
    shares = members.groupBy("c").agg(F.sum("k").alias("shares"))
    ranked = members.join(shares, "c")
    centre = ranked.groupBy(*bucket).agg(F.max_by("c", F.struct("shares", "c")).alias("a"))
    star = _pairs(members.join(centre, bucket).select("a", F.col("c").alias("b")))
    star = land(_plausible(star, classes), "near-star")
    sets = _sets_of(_ends(star), classes, texts)
    links = land(_confirmed(star, sets), "near-links")
    torn = land(_torn(members, links), "near-torn")
    short = classes.filter(F.col("n") <= SHORT).select("c")
    lacking = lambda ends: ends.join(sets.select("c"), "c", "left_anti")  # noqa: E731  (of the sets so far)
    sets = sets.unionByName(_sets_of(lacking(torn.select("c").distinct().join(short, "c", "left_semi")), classes, texts))
    found = land(_crossings(torn, classes, sets.join(short, "c", "left_semi")), "near-found")
    links = links.unionByName(found.filter("sure").select("a", "b"))
    pairs = land(found.filter(~F.col("sure")).select("a", "b").join(star, ["a", "b"], "left_anti"), "near-pairs")
    if not pairs.isEmpty():
        sets = sets.unionByName(_sets_of(lacking(_ends(pairs)), classes, texts))
        links = links.unionByName(_confirmed(pairs, sets))
    links = land(links, "near-links")
    roots = components(links)
    groups = roots.join(classes.select(F.col("c").alias("node"), "doc_id"), "node")
    least = groups.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = groups.join(least, "root").select(F.col("node").alias("c"), "root", "component_id")
    # classes of one row without links are their own component and need no entry
    single = classes.filter("copies > 1").select("c", F.col("c").alias("root"), F.col("doc_id").alias("component_id")).join(
        linked.select("c"), "c", "left_anti")
    return (rows.join(linked.unionByName(single), "c", "left")
            .select("doc_id", "mark", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("root", "c").alias("root")))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents with one row of each component: the least id (null only
    if there is no other), then the least hash of the text, then the least row.
    Documents without words are linked with nothing and all stay."""
    found = near_duplicates(docs, text, key).filter("root is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark"))
    keep = found.groupBy("root").agg(first.alias("first")).select(
        F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_mark")).distinct()
    t = F.coalesce(F.col(f"_row.`{text}`"), F.lit(""))
    rows = packed(docs).withColumns({"_k": F.col(f"_row.`{key}`").cast("long"), "_m": F.xxhash64(t)})
    blank = F.btrim(t, F.lit(SPACES)) == ""
    kept = (rows.filter(~blank)
            .join(keep, F.col("_k").eqNullSafe(F.col("_id")) & (F.col("_m") == F.col("_mark")), "left_semi")
            .groupBy("_k", "_m").agg(F.min("_row").alias("_row")).select("_row"))
    return unpacked(kept.unionByName(rows.filter(blank).select("_row")))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
