"""Operator 8, line dedup: an exact set-similarity join of all lines.

A line is the set of its words (A-Z lower-cased).  Lines with equal sets form
a class, so copies cost one row each.  A line goes when an earlier line, by
(doc_id, line), has an equal set or one of Jaccard similarity THRESHOLD or
more.  Every line with a word takes part, however short.

1. Words are ordered by rarity: their counts over all documents in a table of
   2^24 hash buckets of one byte, which is of fixed size, so it is broadcast.
   The order only has to be the same everywhere for the join to be exact.
2. Two sets that are similar enough share a word among the first
   n - ceil(t n) + 1 of each in that order (prefix filter); only these words
   are indexed, and of these not the ones that occur once in all texts.  Sets
   too small for any other set to be similar (up to 5 words at 0.85) need no
   index: their classes alone decide.
   Length and positional filters, and 64-bit signatures (the parity of the
   words by hash), drop pairs before they leave the word's list; none of them
   drops a similar pair.
3. First each list links its members to its earliest line only.  A line that
   has a confirmed earlier match needs no other.  Lines without one are then
   compared with all earlier members of their lists, so nothing is missed.  A
   table of 2^24 bits tells which may have one, so that only their posts are
   shuffled to be looked up.
4. Pairs are verified on their full sets.  These are read from the texts anew:
   a table of 2^27 bits, of fixed size, so it is broadcast, tells which lines are
   wanted (and a few others, which no pair names), so no text is shuffled.

Edge cases: null and empty texts have no lines; a line without words stays;
rows with the same doc_id and text count as one document, whose lines stay or
go in all copies; rows of one doc_id with other texts are ordered by a hash
of the text; null doc_ids come first; an empty table gives no row.  Classes
are named by the sum, to 64 bits, of their words' hashes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from ..session import remove
from .common import discard, land, landed, packed, read, scratch, send_with_tasks, unpacked

send_with_tasks(__name__)

THRESHOLD, LEAST_WORDS = 0.85, 1
_BITS, _PART = 24, 1 << 15      # buckets of the word counts, and how many travel in a row
_WORDS, _CHUNK = 200_000, 2_000_000      # different words, and bytes of text, that a task handles at once
_ONE, _SIXTY_THREE = np.uint64(1), np.uint64(63)
_PLACES = 1 << 27               # places in the table of wanted lines


def _hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def _buckets(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - _BITS)).astype(np.int64)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, counts = np.zeros(1 << _BITS, np.uint32), Counter()

    def add():
        np.add.at(total, _buckets(_hashes(counts)), np.fromiter(counts.values(), np.uint32, len(counts)))
        counts.clear()
    for pdf in batches:
        for text in pdf["t"]:
            counts.update(_bytes(text).split())
            if len(counts) > _WORDS:
                add()
    add()
    used = np.flatnonzero(total)
    part, cuts = np.unique(used // _PART, return_index=True)
    ends = np.append(cuts[1:], len(used))
    yield pd.DataFrame({
        "part": part, "at": [(used[a:b] % _PART).astype(np.uint16).tobytes() for a, b in zip(cuts, ends)],
        "n": [total[used[a:b]].tobytes() for a, b in zip(cuts, ends)]})


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """The sums of one part, a byte each: exact up to 128, then in steps."""
    n = np.zeros(_PART, np.int64)
    for at, c in zip(pdf["at"], pdf["n"]):
        n[np.frombuffer(at, np.uint16)] += np.frombuffer(c, np.uint32)
    steps = 128 + 6 * np.log2(np.maximum(n, 128) / 128)
    return pd.DataFrame({"part": pdf["part"].iloc[:1],
                         "code": [np.minimum(np.where(n < 128, n, steps), 255).astype(np.uint8).tobytes()]})


def _rarity(texts: DataFrame) -> np.ndarray:
    """Every bucket's coded count; the driver gets 16 MB, whatever the input."""
    parts = texts.select("t").mapInPandas(_count, "part long, at binary, n binary").groupBy("part").applyInPandas(
        _merge, "part long, code binary").collect()
    code = np.zeros((1 << _BITS) // _PART * _PART, np.uint8).reshape(-1, _PART)
    for row in parts:
        code[row.part] = np.frombuffer(row.code, np.uint8)
    return code.reshape(-1)


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """Ids, marks and texts, texts of about size bytes at a time."""
    keys, marks, texts, n = [], [], [], 0
    for batch in batches:
        for key, mark, text in zip(*(x.to_pylist() for x in batch.columns)):
            keys.append(key)
            marks.append(mark)
            texts.append(_bytes(text))
            n += len(texts[-1])
            if n >= size:
                yield keys, marks, texts
                keys, marks, texts, n = [], [], [], 0
    if texts:
        yield keys, marks, texts


def _indexer(rarity, threshold: float, least: int):
    """(doc_id, mark, line, c, n, prefix, at, sig) of every line; the words of the
    prefix, their positions and the set's signature once per class and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, seen = rarity.value, set()
        for keys, marks, texts in _chunks(batches, _CHUNK):
            lines = [x.split() for t in texts for x in t.split(b"\n")]
            per_text = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
            size = np.fromiter(map(len, lines), np.int64, len(lines))
            if not size.any():
                continue
            # words as numbers, in the order of their rarity
            number = defaultdict()
            number.default_factory = number.__len__
            word = np.fromiter(map(number.__getitem__, chain.from_iterable(lines)), np.int64, int(size.sum()))
            h = _hashes(number)
            code = codes[_buckets(h)]
            order = np.lexsort((h, code))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            h, code, bits = h[order], code[order], len(order).bit_length()
            # (line, word) once each; all that follows is by line
            both = np.sort((np.repeat(np.arange(len(lines)), size) << bits) | rank[word])
            both = both[np.append(True, both[1:] != both[:-1])]
            line, word = both >> bits, both & ((1 << bits) - 1)
            starts = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
            n = np.diff(np.append(starts, len(line)))
            line, own = line[starts], h[word]
            c = np.add.reduceat(own, starts).view(np.int64)                 # as _class
            sig = np.bitwise_xor.reduceat(_ONE << (own & _SIXTY_THREE), starts).view(np.int64)
            fresh = np.fromiter((x not in seen and not seen.add(x) for x in c.tolist()), bool, len(c))
            if len(seen) > 1_000_000:          # only saves repeated rows
                seen.clear()
            posted = fresh & (n >= least) & (n >= threshold * (n + 1) - 1e-9)      # else only equal sets are similar
            at = np.arange(len(word)) - np.repeat(starts, n)
            first = np.where(posted, n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1, 0)
            taken = (at < np.repeat(first, n)) & (code[word] > 1)
            ends = np.append(0, np.cumsum(np.add.reduceat(taken.astype(np.int64), starts)))
            doc = np.repeat(np.arange(len(texts)), per_text)[line]
            line -= (np.cumsum(per_text) - per_text)[doc]
            out = pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()).take(pa.array(doc)), pa.array(marks, pa.int64()).take(pa.array(doc)),
                pa.array(line.astype(np.int32)), pa.array(c), pa.array(n.astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(own[taken].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at[taken].astype(np.int32))),
                pa.array(sig, mask=~posted)], ["doc_id", "mark", "line", "c", "n", "prefix", "at", "sig"])
            yield out.filter(pa.array(n >= least))
    return run


def _class(h: np.ndarray) -> int:
    """The name of a set of word hashes: their sum, to 64 bits."""
    return int(np.add.reduce(h).view(np.int64))


def _place(doc_id, mark, line, mod):
    """A line's place in the table of wanted lines (numbers or columns)."""
    return mod(mod(doc_id, _PLACES) * 31 + mod(mark, _PLACES) + line * 40503, _PLACES)


def _sets(bits):
    """The word sets of the lines whose places are wanted, and of the few that
    share a place with one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            c, s = [], []
            for key, mark, text in zip(*(x.to_pylist() for x in batch.columns)):
                text = text.encode("utf-8", "surrogatepass")
                at = _place(key or 0, mark, np.arange(text.count(b"\n") + 1), lambda a, b: a % b)
                wanted = np.flatnonzero(table[at >> 3] >> (at & 7).astype(np.uint8) & 1).tolist()
                lines = text.split(b"\n") if wanted else []
                for i in wanted:
                    h = np.unique(_hashes(lines[i].lower().split()))
                    if len(h):
                        c.append(_class(h))
                        s.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(s, pa.list_(pa.int64()))], ["c", "s"])
    return run


def _wanted(owners: DataFrame) -> np.ndarray:
    """A bit for each place of the owners' first lines: 16 MB, whatever their number."""
    first = [F.coalesce(F.col("first.doc_id"), F.lit(0)), F.col("first.mark"), F.col("first.line").cast("long")]
    place = _place(*first, lambda a, b: F.pmod(a, F.lit(b)))
    parts = owners.select(place.alias("p")).groupBy(F.expr("p div 32768").alias("part")).agg(
        F.bitmap_construct_agg(F.col("p") % 32768).alias("bits")).collect()
    table = np.zeros((_PLACES // 32768, 4096), np.uint8)
    for row in parts:
        table[row.part] = np.frombuffer(row.bits, np.uint8)
    return table.reshape(-1)


def _possible(threshold: float, n_a: Column, p_a: Column, s_a: Column, n_b: Column, p_b: Column, s_b: Column) -> Column:
    """Length and positional filters: the overlap that the similarity needs can
    still be reached when the words at p_a and p_b are the first in common.
    And the signatures: each word that only one set has turns one bit at most,
    so they differ in no more bits than the sets may differ in words."""
    need = F.ceil(F.lit(threshold / (1 + threshold)) * (n_a + n_b) - 1e-9)
    rest = F.least(n_a - p_a, n_b - p_b)
    apart = F.bit_count(s_a.bitwiseXOR(s_b)) <= F.lit((1 - threshold) / (1 + threshold)) * (n_a + n_b) + 1e-9
    return (F.least(n_a, n_b) >= threshold * F.greatest(n_a, n_b) - 1e-9) & (rest >= need) & apart


def _without(posts: DataFrame, classes: DataFrame) -> DataFrame:
    """posts but those of the classes.  A table of 2^24 bits, sent to all tasks in
    at most 2^18 rows, tells which posts may be of one; only these are shuffled."""
    place = F.col("c").bitwiseAND(F.lit((1 << 24) - 1))
    bits = F.broadcast(classes.groupBy(F.shiftright(place, 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(c & 63 as int)))").alias("bits")))
    maybe = posts.withColumn("at", F.shiftright(place, 6)).join(bits, "at", "left").withColumn(
        "maybe", F.expr("coalesce(shiftright(bits, cast(c & 63 as int)) & 1, 0) = 1"))
    return maybe.filter(~F.col("maybe")).select(*posts.columns).unionByName(
        maybe.filter("maybe").select(*posts.columns).join(classes, "c", "left_anti").select(*posts.columns))


def _verified(pairs: DataFrame, owners: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """pairs(a, b) that are similar, as (c, earlier): the later class and the earlier."""
    ends = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    owners = landed(owners.join(ends, "c").select("c", "first"), "line-ends")
    bits = pairs.sparkSession.sparkContext.broadcast(_wanted(owners))
    read_ = landed(texts.select("doc_id", "mark", "t").mapInArrow(_sets(bits), "c long, s array<long>"), "line-sets")
    sets = read_
    sets = sets.join(owners, "c")
    side = lambda x: sets.select(F.col("c").alias(x), F.col("s").alias(f"s_{x}"),
                                 F.col("first").alias(f"f_{x}"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    ok = (pairs.join(side("a"), "a").join(side("b"), "b")
          .filter(both >= threshold * (F.size("s_a") + F.size("s_b") - both) - 1e-9))
    later = F.col("f_a") > F.col("f_b")
    out = landed(ok.select(F.when(later, F.col("a")).otherwise(F.col("b")).alias("c"),
                           F.when(later, F.col("f_b")).otherwise(F.col("f_a")).alias("earlier")), "line-found")
    discard(read_, owners)
    return out


def line_matches(docs: DataFrame, threshold: float = THRESHOLD, least: int = LEAST_WORDS,
                 text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per line that goes: doc_id, mark, line, and the earlier line's
    doc_id and number (match_doc, match_line)."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(t).alias("mark"), t.alias("t"))
    rarity = docs.sparkSession.sparkContext.broadcast(_rarity(texts))
    spark, wide = docs.sparkSession, scratch(docs.sparkSession, "lines-wide")
    texts.select("doc_id", "mark", "t").mapInArrow(
        _indexer(rarity, threshold, least),
        "doc_id long, mark long, line int, c long, n int, prefix array<long>, at array<int>, sig long").write.parquet(wide)
    indexed = spark.read.parquet(wide)
    lines = land(indexed.select("doc_id", "mark", "line", "c"), "lines")
    first = F.struct("doc_id", "mark", "line")
    owners = land(lines.groupBy("c").agg(F.min(first).alias("first"), F.count("*").alias("copies")), "line-owners")
    # the index: words that two classes have in their prefixes, with the list's earliest line
    posts = indexed.filter("sig is not null").select(
        "c", "n", "doc_id", "sig", F.explode(F.arrays_zip("at", "prefix")).alias("x")).select(
        "c", "n", "doc_id", "sig", F.col("x.at").alias("pos"), F.col("x.prefix").alias("word"))
    of_word = W.partitionBy("word")
    head = F.min(F.struct("doc_id", "c", "n", "pos", "sig")).over(of_word)
    posts = posts.withColumns({"head": head, "one": F.min("c").over(of_word) == F.max("c").over(of_word),
                               "many": F.count("*").over(of_word) > 2})
    near = _possible(threshold, *[F.col(x) for x in ("n", "pos", "sig", "head.n", "head.pos", "head.sig")])
    index = landed(posts.filter(~F.col("one")).select(
        "word", "c", "n", "pos", "sig", "many", F.col("head.c").alias("hc"), near.alias("near")).distinct(), "line-index")
    remove(spark, wide)
    posts = index
    unordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    star = land(unordered(posts.filter((F.col("c") != F.col("hc")) & F.col("near")).select(
        F.col("c").alias("a"), F.col("hc").alias("b"))), "line-star")
    found = _verified(star, owners, texts, threshold)
    # lines without a match so far, against all earlier members of their lists
    # (but the earliest, which is done; a list of two has no others)
    posts = posts.filter(F.col("many") & (F.col("c") != F.col("hc")))
    open_ = _without(posts, found.select("c").distinct()).select(
        "word", F.col("c").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("p_b"), F.col("sig").alias("s_b"))
    others = posts.select(
        "word", F.col("c").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("p_a"), F.col("sig").alias("s_a"))
    rest = unordered(open_.join(others, "word").filter((F.col("a") != F.col("b")) & _possible(
        threshold, *[F.col(x) for x in ("n_a", "p_a", "s_a", "n_b", "p_b", "s_b")])).select("a", "b"))
    rest = rest.join(star, ["a", "b"], "left_anti")
    rest = land(rest, "line-rest")
    discard(index)
    if not rest.isEmpty():
        found = found.unionByName(_verified(rest, owners, texts, threshold))
    matched = found.groupBy("c").agg(F.min("earlier").alias("earlier"))
    # a class with a match goes as a whole; of the others, all lines but the first
    known = owners.join(matched, "c", "left").filter("copies > 1 or earlier is not null")
    return (lines.select("doc_id", "mark", "line", "c").join(known, "c")
            .filter(F.col("earlier").isNotNull() | (first != F.col("first")))
            .withColumn("by", F.coalesce(F.least("earlier", "first"), "first"))
            .select("doc_id", "mark", "line", F.col("by.doc_id").alias("match_doc"),
                    F.col("by.line").alias("match_line")).distinct())


def _per_document(docs: DataFrame, threshold: float, least: int, text: str, key: str) -> DataFrame:
    return line_matches(docs, threshold, least, text, key).groupBy("doc_id", "mark").agg(
        F.sort_array(F.collect_list(F.struct("line", "match_doc", "match_line"))).alias("gone"))


def without_repeated_lines(docs: DataFrame, threshold: float = THRESHOLD, least: int = LEAST_WORDS,
                           text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents, their text without the lines that go.  A document of
    which no word is left goes; one that had none to begin with stays."""
    gone = _per_document(docs, threshold, least, text, key).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("gone.line").alias("_gone"))
    rows = packed(docs).withColumn("_t", F.col(f"_row.`{text}`"))
    rows = rows.join(gone, F.col(f"_row.`{key}`").cast("long").eqNullSafe(F.col("_id"))
                     & (F.xxhash64(F.coalesce("_t", F.lit(""))) == F.col("_mark")), "left")
    left = F.when(F.col("_gone").isNull(), F.col("_t")).otherwise(F.array_join(
        F.filter(F.split("_t", "\n", -1), lambda x, i: ~F.array_contains("_gone", i)), "\n"))
    rows = rows.withColumn("_t", left).filter(
        F.col("_gone").isNull() | (F.btrim("_t", F.lit(" \t\n\x0b\x0c\r")) != ""))
    return unpacked(rows.withColumn("_row", F.col("_row").withField(f"`{text}`", F.col("_t"))))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    gone = _per_document(docs, THRESHOLD, LEAST_WORDS, "text", "doc_id").select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "gone")
    t = F.coalesce("text", F.lit(""))
    lines = F.size(F.split(t, "\n", -1))
    return (docs.select("doc_id", F.xxhash64(t).alias("mark"), lines.alias("n_lines"))
            .join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
            .select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"),
                    F.coalesce(F.transform("gone", lambda x: x["line"]), F.array().cast("array<int>"))
                    .alias("removed")))
