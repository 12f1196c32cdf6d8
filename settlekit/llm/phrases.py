"""Operator 11, phrase mining by direct-address tiling.

Texts are cut into pieces and words; all counts are per language.

1. A task turns what it reads into blocks: word numbers in order of frequency
   within the block, its words and their counts.  The words' corpus counts are
   a group-by; words found LEAST times or more get corpus ids in order of
   frequency, and each block gets the ids of its own words back.
2. A block counts its pairs of neighbouring ids.  A pair (i, j) belongs to the
   tile (i / SIDE, j / SIDE).  Ids are ranked by frequency, so a few tiles hold
   most pairs: a tile with enough of them is counted by a bincount over its
   SIDE x SIDE places, the rest together by sorting their coordinates.  The
   blocks' counts are summed by a group-by.
3. Pairs found LEAST times or more are ranked by frequency anew and take the
   place of words: a triple is a pair and the word after it, a phrase of four
   a triple and a word.  A phrase is counted only where both phrases within it
   that are one word shorter are frequent, which loses none.

The sums, ids and phrases are joined and ranked by Spark; no task holds more
than a block and the answers to it.

Edge cases: null and empty texts have no words; a null lang is ``und``; rows
count each, whatever their ids; a word is never longer than its text, texts of
any length are read whole (one longer than a block is a block); ties in score
and frequency are ordered by the phrase's UTF-8 bytes; further columns are not
read; an empty table, or one without frequent pairs, gives no row.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from ..operators.reconcile import number
from .common import discard, landed, read, send_with_tasks

send_with_tasks(__name__)

LEAST, LONGEST, BEST, COVERED_PCT = 30, 4, 2000, 80
#: words in a block; side of a tile, and the pairs from which a tile is counted densely
BLOCK, SIDE, DENSE = 2_000_000, 1024, 1 << 15
#: codes (16 bytes each) that are sent to all tasks; more than these are joined by a shuffle
SMALL = 3_000_000
_BREAK = b"\n"
_CUTS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\t", _BREAK * 10 + b" ")


def _words(text: str) -> Iterator[bytes]:
    """The words of a text, with a break between pieces."""
    raw = text.encode("utf-8", "surrogatepass").lower().translate(_CUTS)
    return filter(None, (raw + _BREAK).replace(_BREAK, b" \n ").split(b" "))


def _planes(x: np.ndarray) -> bytes:
    """Numbers below 2^32 as compressed byte planes."""
    return zlib.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _from_planes(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


#: a block's state (copies null): words and phrases, a number per place; and the
#: rows of what it asks for: a word with its number in the block, or a code
_ROWS = [("block", pa.int64()), ("lang", pa.string()), ("words", pa.binary()), ("grams", pa.binary()), ("pos", pa.int32()),
         ("word", pa.string()), ("code", pa.int64()), ("copies", pa.int32())]
_SCHEMA = "block long, lang string, words binary, grams binary, pos int, word string, code long, copies int"


def _table(block: int, copies: np.ndarray, words: np.ndarray | None, grams: np.ndarray, **asked) -> pa.Table:
    """The state row of a block and the rows of what it asks for."""
    n = len(copies)
    own = {"block": block, "words": None if words is None else _planes(words), "grams": _planes(grams)}
    asked |= {"block": pa.array(np.full(n, block), pa.int64()), "copies": pa.array(copies, pa.int32())}
    return pa.concat_tables([pa.table({c: pa.array([own.get(c)], t) for c, t in _ROWS}),
                             pa.table({c: asked.get(c, pa.nulls(n, t)) for c, t in _ROWS})])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of words: ``grams`` has at each place the number of its word from
    1 on, in order of frequency in the block; 0 is a break."""
    known, texts, size, done = {}, {}, 0, 0

    def flush():
        for k, (lang, parts) in enumerate(texts.items()):
            ids = np.concatenate(parts)
            copies = np.bincount(ids, minlength=len(known[lang]))
            order = 1 + np.argsort(-copies[1:], kind="stable")
            if not len(order):
                continue
            rank = np.zeros(len(copies), np.int64)
            rank[order] = np.arange(1, len(copies))
            words = pa.array(list(known[lang]), pa.binary()).take(pa.array(order)).cast(pa.string())
            yield from _table(TaskContext.get().partitionId() << 40 | done + k, copies[order], None, rank[ids], word=words,
                              lang=pa.repeat(pa.scalar(lang, pa.string()), len(words)),
                              pos=pa.array(np.arange(1, len(copies)), pa.int32())).to_batches(10_000)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if lang not in known:
                known[lang] = defaultdict(count().__next__, {})
                known[lang][_BREAK]
                texts[lang] = []
            part = np.fromiter(map(known[lang].__getitem__, _words(text)), np.int32)
            texts[lang].append(part)
            size += len(part)
            if size >= BLOCK:
                yield from flush()
                done += len(texts)
                known, texts, size = {}, {}, 0
    yield from flush()


def tile_counts(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, copies) of the pairs of ids: ``first << 32 | second``, in order."""
    tile = (first // SIDE) << 32 | second // SIDE
    tiles, which, size = np.unique(tile, return_inverse=True, return_counts=True)
    codes, copies = [], []
    dense = size >= DENSE
    order = np.argsort(which, kind="stable") if dense.any() else None
    ends = np.cumsum(size)
    for t in np.flatnonzero(dense):
        at = order[ends[t] - size[t]:ends[t]]
        n = np.bincount((first[at] % SIDE) * SIDE + second[at] % SIDE, minlength=SIDE * SIDE)
        place = np.flatnonzero(n)
        codes.append(((tiles[t] >> 32) * SIDE + place // SIDE) << 32 | (tiles[t] & 0xFFFFFFFF) * SIDE + place % SIDE)
        copies.append(n[place])
    rest = ~dense[which]
    c, n = np.unique(first[rest] << 32 | second[rest], return_counts=True)
    codes, copies = np.concatenate([*codes, c]), np.concatenate([*copies, n])
    order = np.argsort(codes)
    return codes[order], copies[order]


def _masked(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    out[at] = x[at]
    return out


def _counted(block: int, here: np.ndarray, words: np.ndarray, width: int) -> pa.Table:
    """A block with the ids ``here`` of its frequent phrases of ``width`` words:
    counts the phrases that are one word longer.  Of its state only the places
    where these begin, and their last words, are kept."""
    n = max(len(words) - width, 0)
    at = np.flatnonzero((here[:n] > 0) & (np.append(here[1:], 0)[:n] > 0) & (words[width:] > 0))
    codes, copies = tile_counts(here[at], words[at + width])
    return _table(block, copies, _masked(words, at + width), _masked(here, at), code=pa.array(codes, pa.int64()))


def _pairs(block: pa.Table, told: pa.Table) -> pa.Table:
    """A block of word numbers, told the ids of its frequent words."""
    row = block.to_pylist()[0]
    numbers = _from_planes(row["grams"])
    ids = np.zeros(int(numbers.max(initial=0)) + 1, np.int64)
    ids[told["pos"].to_numpy()] = told["id"].to_numpy()
    return _counted(row["block"], ids[numbers], ids[numbers], 1)


def _renumbered(row: dict, width: int, known: np.ndarray, ids: np.ndarray) -> pa.Table:
    """A block's phrases of ``width`` words, named by code, take the ids of the
    known codes (which are in order)."""
    grams, words = _from_planes(row["grams"]), _from_planes(row["words"])
    here, at = np.zeros(len(grams), np.int64), np.flatnonzero(grams)
    codes = grams[at] << 32 | words[at + width - 1]
    if len(known):
        which = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        here[at] = np.where(known[which] == codes, ids[which], 0)
    return _counted(row["block"], here, words, width)


def _longer(width: int):
    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        known, ids = told["code"].to_numpy(), told["id"].to_numpy()
        order = np.argsort(known)
        return _renumbered(block.to_pylist()[0], width, known[order], ids[order])
    return run


def _longer_by(width: int, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from _renumbered(batch.slice(k, 1).to_pylist()[0], width, *sent.value).to_batches(10_000)
    return run


def _ranked(sums: DataFrame, by: list[str]) -> DataFrame:
    """Frequent rows of (by, n) with ``id``: 1.. in order of frequency, over all
    languages (an id tells its language)."""
    rows = sums.filter(F.col("n") >= LEAST).withColumn("_less", -F.col("n"))
    return number(rows, [], ["_less", *by], "id").drop("_less")


def _step(blocks: DataFrame, frequent: DataFrame, key: list[str], width: int) -> DataFrame:
    """The blocks with the ids of their frequent words or phrases; they count
    what is one word longer.  Up to SMALL codes are sent to all tasks; of more,
    each block gets those that it has."""
    state = blocks.filter("copies is null").select("block", "words", "grams")
    if width > 1 and frequent.count() <= SMALL:
        codes = frequent.select("code", "id").toArrow().sort_by("code")
        sent = blocks.sparkSession.sparkContext.broadcast((codes["code"].to_numpy(), codes["id"].to_numpy()))
        return state.mapInArrow(_longer_by(width, sent), _SCHEMA)
    own = "pos" if width == 1 else "code"
    asked = blocks.filter("copies is not null").select(F.col("block").alias("asker"), *{own: 0, **dict.fromkeys(key)})
    told = asked.join(frequent.select(*key, "id"), key).select("asker", own, "id")
    return state.groupBy("block").cogroup(told.groupBy("asker")).applyInArrow(
        _pairs if width == 1 else _longer(width), _SCHEMA)


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, width, f) of every phrase of 1 to LONGEST words found
    LEAST times or more, and (lang, n) of the languages' words."""
    src = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"),
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    blocks = landed(src.mapInArrow(_blocks, _SCHEMA), "phrase-blocks")

    def sums(*key: str) -> DataFrame:
        return blocks.filter("copies is not null").groupBy(*key).agg(F.sum("copies").alias("n"))
    found = landed(sums("lang", "word"), "phrase-words")
    totals = landed(found.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    words = landed(_ranked(found, ["lang", "word"]), "phrase-ids")
    discard(found)
    parts = [words.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("width"), F.col("n").alias("f"))]
    shorter = words.select("lang", F.col("id").alias("front"), F.col("word").alias("begin"))
    last = words.select(F.col("id").alias("back"), F.col("word").alias("end"))
    frequent, key = words, ["lang", "word"]
    for width in range(2, LONGEST + 1):
        longer = landed(_step(blocks, frequent, key, width - 1), "phrase-blocks")
        discard(blocks)
        blocks, key = longer, ["code"]
        frequent = landed(_ranked(sums("code"), ["code"]), "phrase-ids")
        named = landed(
            frequent.withColumns({"front": F.shiftright("code", 32), "back": F.col("code").bitwiseAND(0xFFFFFFFF)})
            .join(shorter, "front").join(last, "back")
            .select("lang", "id", "n", F.concat_ws(" ", "begin", "end").alias("phrase")), "phrase-names")
        parts.append(named.select("lang", "phrase", F.lit(width).alias("width"), F.col("n").alias("f")))
        shorter = named.select("lang", F.col("id").alias("front"), F.col("phrase").alias("begin"))
    discard(blocks)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, totals


def _exact(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def collocations(docs: DataFrame, best: int = BEST, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = phrase_counts(docs, text, lang)
    counts = landed(counts, "phrase-counts")
    found = counts.filter("width > 1").select("lang", "phrase", "width", F.col("f").alias("a"))
    w = F.split("phrase", " ", -1)
    part = lambda a, n: F.concat_ws(" ", F.slice("w", a, n))
    cuts = found.withColumn("w", w).select("lang", "phrase", "a", "w", "width", F.explode(
        F.sequence(F.lit(1), F.col("width") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("width") - F.col("k")).alias("right"))
    side = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    cuts = cuts.withColumns({"a_": _exact(F.col("a")), "lr": _exact(F.col("l")) + _exact(F.col("r"))}).withColumn(
        "score", F.expr("(2000000BD * a_) div lr").cast("long"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # phrases within a longer one that covers most of their occurrences
    inner = [(s, n) for n in range(2, LONGEST) for s in range(1, LONGEST)]
    within = found.filter("width > 2").withColumn("w", w).select("lang", "a", "width", F.explode(F.array(
        *[F.when((F.lit(n) < F.col("width")) & (F.lit(s + n - 1) <= F.col("width")), part(F.lit(s), F.lit(n)))
          for s, n in inner])).alias("phrase")).filter("phrase is not null")
    most = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(most, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (_exact(F.col("longer")) * 100 < _exact(F.col("a")) * COVERED_PCT))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (kept.withColumn("rank", rank).filter(F.col("rank") <= best).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))
