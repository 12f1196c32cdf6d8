"""Operator 10, best-fit packing with a segment tree over remaining capacities.

Texts are tokenised in Arrow batches (Spark partitions the work) and cut
into pieces of at most ``capacity`` tokens.  Best-fit decreasing looks only
at lengths, so its input is the histogram of lengths (at most ``capacity``
rows, whatever the number of documents): lengths are taken from the longest
down, a segment tree over remaining capacities finds the tightest open
sequences in logarithmic time, and all sequences with equal remaining room
are filled at once.  The result is the one that best-fit decreasing gives
document by document.  Pieces of a length are numbered in parallel, and the
plan maps (length, number) to a sequence and an offset.

Edge cases: a null or empty text, or one without tokens, is a piece of the
end token alone; repeated rows are packed each; null doc_ids are kept; texts
of any length are cut, none is shortened; an empty table gives no row.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from .common import land, read, send_with_tasks

send_with_tasks(__name__)

CAPACITY, END_ID = 4096, 1
#: pieces of one length are numbered in SPLIT parts
SPLIT = 512
#: words, and parts of words, after which the older ones that a worker knows age away; the longest kept
CACHE, LONGEST = 400_000, 64
#: white space to str.split, but not to the tokenizer
SEPARATORS = "\x1c\x1d\x1e\x1f"


class Remembered(dict):
    """What ``make`` gives for a key, remembered: the entries asked for since
    ``limit`` others came stay, older ones age away; keys above LONGEST letters
    are made each time."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key: str):
        if len(key) > LONGEST:
            return self.make(key)
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class WordTokenizer:
    """ids of a tokenizer whose words end at white space.

    A text's ids are the ids of its white-space separated chunks, one after
    the other, so each distinct chunk goes through the tokenizer once per
    worker; texts that contain the string of an added token go through whole.
    ``checks`` makes sure that the file is of this kind.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.pieces = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\sA-Za-z0-9]+", re.ASCII).findall
        self.space = regex.compile(r"\s+").split
        self.alphabet = _byte_letters()
        self.chunk, self.piece = Remembered(self._ids, CACHE), Remembered(self._piece_ids, CACHE)
        self.control = {b: x for b, x in self.alphabet.items() if b < 128 and chr(b) != x}
        controls = "".join(f"a{chr(b)}b {chr(b)} " for b in (*range(32), 127, 0x85, 0xA0))
        for probe in ("It's a test, n°42!", "Él l'a dit: «ça va»…", "<a|b> 3.14 ###", "漢字 ß İ", controls):
            got = b"".join(self._ids(c) for c in self._chunks(probe))
            want = np.array(self.full.encode(probe, add_special_tokens=False).ids, "<u4").tobytes()
            if got != want:
                raise ValueError(f"{path}: not a tokenizer that this class can cache by word")

    def _chunks(self, text: str) -> list[str]:
        """The text cut at the tokenizer's white space."""
        if any(s in text for s in SEPARATORS):
            return [c for c in self.space(text) if c]
        return text.split()

    def _piece_ids(self, piece: str) -> bytes:
        if piece.isascii():
            raw = piece.translate(self.control)
        else:
            raw = piece.encode().decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.model.tokenize(raw)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, chunk: str) -> bytes:
        text = chunk.lower() if chunk.isascii() else self.full.normalizer.normalize_str(chunk)
        if text.isalpha():                       # letters only: one piece
            return self.piece[text]
        pieces = self.ascii(text) if text.isascii() else self.pieces(text)
        return b"".join(map(self.piece.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.chunk.__getitem__, self._chunks(text)))


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in same else next(rest)) for b in range(256)}


def _tokenizer(path: str) -> WordTokenizer:
    """One tokenizer, with the words it knows, for all tasks of a worker process."""
    kept = sys.modules.setdefault("_settlekit_worker", types.ModuleType("_settlekit_worker")).__dict__
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]


def _cutter(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = _tokenizer(path)
        for pdf in batches:
            rows = []
            for key, text in zip(pdf["doc_id"], pdf["t"]):
                ids = tok.encode(text) + end
                for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[a:a + 4 * capacity]
                    rows.append((key, k, k * capacity, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype(
                {"doc_id": pdf["doc_id"].dtype})
    return cut


class SegmentTree:
    """Which remaining capacities have open sequences; finds the least >= r."""

    def __init__(self, top: int):
        self.n = 1 << top.bit_length()
        self.any = [False] * (2 * self.n)

    def set(self, r: int, on: bool) -> None:
        i = r + self.n
        self.any[i] = on
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, r: int) -> int | None:
        i = r + self.n
        if self.any[i]:
            return r
        while i > 1:                        # up to the first subtree to the right with an open one
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.n:           # and down to its leftmost
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.n
            i //= 2
        return None


def best_fit(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing of {length: count}.

    Rows (length, first, sequence, each, offset): the pieces of that length
    numbered from ``first`` on (up to the next row's ``first``) go to the
    sequences from ``sequence`` on, ``each`` to a sequence, from ``offset`` on.
    """
    tree, rooms, rows, fresh = SegmentTree(capacity), {}, [], 0   # rooms: room -> [[first sequence, how many]]

    def open_(room: int, first: int, n: int) -> None:
        if n and room:
            rooms.setdefault(room, []).append([first, n])
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        left, number = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = capacity, fresh, -(-left // (capacity // length))
                fresh += n
            else:
                first, n = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            each = room // length                     # after the first, it is the tightest for the next
            full = min(n, left // each)
            if full:
                rows.append((length, number, first, each, capacity - room))
                number, left = number + full * each, left - full * each
                open_(room - each * length, first, full)
                first, n = first + full, n - full
            if n and left:                            # fewer than each are left
                rows.append((length, number, first, each, capacity - room))
                open_(room - left * length, first, 1)
                first, n, number, left = first + 1, n - 1, number + left, 0
            open_(room, first, n)
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    src = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    # ids travel as text through pandas where nulls would turn them into floats
    src = src.withColumn("doc_id", F.col("doc_id").cast("string"))
    pieces = src.mapInPandas(
        _cutter(tokenizer, capacity, end_id),
        "doc_id string, piece int, start long, length long, ids_crc32 long")
    pieces = land(pieces.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn(
        "part", F.pmod(F.monotonically_increasing_id(), F.lit(SPLIT)).cast("int")), "pack-pieces")
    parts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    parts = land(parts, "pack-parts")                               # <= capacity x SPLIT rows
    histogram = dict(parts.groupBy("length").agg(F.sum("n")).collect())   # <= capacity rows
    plan = best_fit(histogram, capacity)
    # rows are in order of (-length, first): the row of a piece is the last that starts at or before it
    keys = (capacity - plan[:, 0]) << 44 | plan[:, 1]

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        a, j = length.to_numpy(np.int64), number.to_numpy(np.int64)
        row = plan[np.searchsorted(keys, (capacity - a) << 44 | j, side="right") - 1]
        k, m = np.divmod(j - row[:, 1], row[:, 3])
        return pd.DataFrame({"sequence_id": row[:, 2] + k, "offset": row[:, 4] + m * a})

    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)   # <= SPLIT rows
    parts = parts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    nth = F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32"))
    return (pieces.withColumn("nth", nth).join(parts, ["length", "part"])
            .withColumn("at", place("length", F.col("nth") - 1 + F.col("skip")))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
