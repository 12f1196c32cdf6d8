"""Operator 13, alignment of two tokenizers on the same texts.

Every text is encoded by a byte-level model (A, with a space before the text)
and a piece model (B, which adds that space); tokens cover bytes.  All
documents of a block are merged in lockstep: a NumPy state holds one A and
one B pointer per lane, each step emits the pairs of tokens that the lanes
are at (the links), the places where both tokens end (the cuts), and moves
the pointer of the token that ends first, or both; lanes that are done leave
the state.  A document is one lane, a long one a lane for every ``LANE`` of
its A tokens: a link belongs to the lane in which the overlap of its tokens
begins, so lanes share nothing and lose nothing.

A block is what a task has read when it holds ``BLOCK`` A tokens.  It writes
one row per document and one with its distinct id pairs and how often each
document links them.  Corpus counts are a group-by over the blocks' pairs;
each block then gets the counts of its own pairs back and adds them up by
document.  No task sees more than a block, and what is broadcast has one row
per id of B.

Edge cases: texts that are null or empty, or whose A or B bytes joined are
not space+text (U+2581 in the text, for one), have no tokens: zeros and ''.
Special tokens in a text are plain text.  Repeated rows and null ids are rows
of their own; documents of any length are aligned whole (one longer than a
block is a block); an empty table gives no row.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, kept_by_worker, landed, read, send_with_tasks

send_with_tasks(__name__)

BLOCK, LANE = 600_000, 256
SPACE = "▁"
#: characters whose classes are the same in all Unicode versions; a text with
#: others is encoded by the file's own library
_STABLE = "\x00-ɏ‐-‧€"


class ByteLevel:
    """Ids by a byte-level merge file, and the bytes of its entries."""

    def __init__(self, path: str):
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"] for t in spec["added_tokens"]}
        back = {c: b for b, c in _byte_letters().items()}
        raw = {p: bytes(back[c] for c in p) for p in spec["model"]["vocab"] if p not in added}
        ranks = {raw[p]: i for p, i in spec["model"]["vocab"].items() if p in raw}
        self.size = max(spec["model"]["vocab"].values()) + 1
        self.surface = [b""] * self.size
        for r, i in ranks.items():
            self.surface[i] = r
        import public_tokenizers
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={}).encode_ordinary
        self.other = regex.compile(f"[^{_STABLE}]").search
        every = [chr(c) for c in range(0x250)]
        probe = "".join(f"a{c}b {c} 1{c}{c}" for c in every) + "It's  well-known…\n\n  <|endoftext|> 12,5 € "
        if self.fast(probe) != self.full.encode(probe, add_special_tokens=False).ids:
            self.other = bool                       # not the usual split: always by its own library

    def ids(self, text: str) -> list[int]:
        if self.other(text):
            return self.full.encode(text, add_special_tokens=False).ids
        return self.fast(text)


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in same else next(rest)) for b in range(256)}


class Pieces:
    """Ids by a piece model, and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.surface = [bytes([int(self.model.id_to_piece(i)[1:-1], 16)]) if self.model.is_byte(i)
                        else self.model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(self.size)]

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Aligner:
    def __init__(self, a: str, b: str):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.length_a = np.array([len(x) for x in self.a.surface], np.int64)
        self.length_b = np.array([len(x) for x in self.b.surface], np.int64)
        # what a token writes into the groups column, within a group and as its last
        self.written = [f"{i}{c}" for i in range(self.a.size) for c in ",|"]
        self.written += [f"{i}{c}" for i in range(self.b.size) for c in ",;"]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int32)
        if not text:
            return none, none
        spaced = " " + text
        a, b, want = self.a.ids(spaced), self.b.ids(text), spaced.encode()
        if b"".join(map(self.a.surface.__getitem__, a)) != want or \
                b"".join(map(self.b.surface.__getitem__, b)) != want:
            return none, none
        return np.array(a, np.int32), np.array(b, np.int32)


def lockstep(end_a: np.ndarray, end_b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A index, B index, cut) of every link of all documents.  ``end_a`` and
    ``end_b`` are the tokens' ends in the bytes of all documents one after the
    other; documents begin at the A tokens ``starts``."""
    if not len(end_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    # lanes: the documents' first A tokens and every LANE-th after them
    nth = np.arange(len(end_a)) - np.repeat(starts, np.diff(np.append(starts, len(end_a))))
    pa_ = np.flatnonzero(nth % LANE == 0)
    begin = np.where(pa_ > 0, end_a[pa_ - 1], 0)
    pb_ = np.searchsorted(end_b, begin, side="right")
    stop = np.append(begin[1:], end_a[-1])
    out_a, out_b, out_cut = [], [], []
    while len(pa_):
        ea, eb = end_a[pa_], end_b[pb_]
        out_a.append(pa_)
        out_b.append(pb_)
        out_cut.append(ea == eb)
        on = np.minimum(ea, eb) < stop             # where the next overlap begins
        pa_, pb_ = pa_ + (ea <= eb), pb_ + (eb <= ea)
        if not on.all():
            pa_, pb_, stop = pa_[on], pb_[on], stop[on]
    return np.concatenate(out_a), np.concatenate(out_b), np.concatenate(out_cut)


def _packed(x: np.ndarray) -> bytes:
    """Small numbers as compressed byte planes."""
    return zlib.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


_KEYS = "block long, nth int"
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_FIELDS = [("block", pa.int64()), ("nth", pa.int32()), *[(c, pa.int64()) for c in _COUNTS], ("groups", pa.string()),
           ("codes", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())), ("held", pa.binary())]
_SCHEMA = f"{_KEYS}, {', '.join(f'{c} long' for c in _COUNTS)}, groups string, " \
          "codes array<long>, copies array<long>, held binary"


def _block(al: Aligner, docs: list) -> tuple[list[tuple], tuple]:
    """The rows of a block's documents, and its row of pairs."""
    n_a, n_b = (np.array([len(d[k]) for d in docs], np.int64) for k in (0, 1))
    a, b = (np.concatenate([d[k] for d in docs]).astype(np.int64) for k in (0, 1))
    from_a, from_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    link_a, link_b, cut = lockstep(np.cumsum(al.length_a[a]), np.cumsum(al.length_b[b]), from_a[n_a > 0])
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[link_a[cut]] = True
    last_b[link_b[cut]] = True
    # the groups in writing order: a group's A tokens, then its B tokens
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    in_a, in_b = np.bincount(group_a), np.bincount(group_b)
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = 2 * a + last_a
    order[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = 2 * (al.a.size + b) + last_b
    doc_a = np.repeat(np.arange(len(docs)), n_a)
    n_groups = np.bincount(doc_a, last_a, len(docs)).astype(np.int64)
    n_links = np.bincount(doc_a[link_a], minlength=len(docs))
    rows = []
    for k, (at, n) in enumerate(zip((from_a + from_b).tolist(), (n_a + n_b).tolist())):
        text = "".join(map(al.written.__getitem__, order[at:at + n].tolist()))[:-1]
        rows.append((k, int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]), text))
    codes, which, copies = np.unique(a[link_a] * al.b.size + b[link_b], return_inverse=True, return_counts=True)
    held, times = np.unique(doc_a[link_a] * max(len(codes), 1) + which, return_counts=True)
    doc, held = np.divmod(held, max(len(codes), 1))
    # sorted pair numbers by document: the first, then differences; most are held once
    steps = np.where(np.diff(doc, prepend=-1) > 0, held, np.diff(held, prepend=0))
    parts = [_packed(np.bincount(doc, minlength=len(docs))), _packed(steps), _packed(times)]
    blob = struct.pack("<3I", *map(len, parts)) + b"".join(parts)
    return rows, (codes, copies, blob)


def _held(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair number, times) of a block's row."""
    at, parts = 12, []
    for n in struct.unpack_from("<3I", blob):
        parts.append(_unpacked(blob[at:at + n]).astype(np.int64))
        at += n
    per_doc, steps, times = parts
    doc, total = np.repeat(np.arange(len(per_doc)), per_doc), np.cumsum(steps)
    first = (np.cumsum(per_doc) - per_doc)[doc]
    return doc, total - (total - steps)[first], times


def align(docs: DataFrame, a: str, b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document (doc_id, block, nth, n_a, n_b, n_groups, n_links,
    groups) and one per block (nth null; codes, copies, held).  ``groups``
    lists the A and B ids between cuts: ``a1,a2|b1;a3|b2,b3``."""
    src = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = kept_by_worker(("align", a, b), lambda: Aligner(a, b))
        keys, todo, size, done, kind_ = [], [], 0, 0, None

        def flush():
            block = TaskContext.get().partitionId() << 32 | done
            rows, (codes, copies, blob) = _block(al, todo)
            for i in range(0, len(rows), 4096):
                part = rows[i:i + 4096]
                cols = list(zip(*part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i:i + 4096], kind_), pa.array([block] * len(part), pa.int64()),
                     pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:5]],
                     pa.array(cols[5], pa.string()), *[pa.nulls(len(part), t) for _, t in _FIELDS[-3:]]],
                    ["doc_id", *[n for n, _ in _FIELDS]])
            if len(codes):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, kind_), pa.array([block], pa.int64()), pa.nulls(1, pa.int32()),
                     *[pa.nulls(1, t) for _, t in _FIELDS[2:7]], pa.array([codes], pa.list_(pa.int64())),
                     pa.array([copies], pa.list_(pa.int64())), pa.array([blob], pa.binary())],
                    ["doc_id", *[n for n, _ in _FIELDS]])
        for batch in batches:
            kind_ = batch.column(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = al.tokens(t)
                if todo and size + len(tokens[0]) > BLOCK:
                    yield from flush()
                    keys, todo, size, done = [], [], 0, done + 1
                keys.append(k)
                todo.append(tokens)
                size += len(tokens[0])
        if todo:
            yield from flush()
    return src.mapInArrow(run, f"doc_id {kind}, {_SCHEMA}")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(code, a_id, b_id, n, best): how many links of the corpus hold a pair,
    and whether no pair of its B id has more."""
    pairs = aligned.filter("nth is null").select(F.explode(F.arrays_zip("codes", "copies")).alias("p"))
    counts = pairs.groupBy(F.col("p.codes").alias("code")).agg(F.sum("p.copies").alias("n")).select(
        "code", F.expr(f"code div {size_b}").cast("int").alias("a_id"),
        (F.col("code") % size_b).cast("int").alias("b_id"), "n")
    counts = landed(counts, "pair-sums")
    most = counts.groupBy("b_id").agg(F.max("n").alias("most"))             # a row per id of B
    out = landed(counts.join(F.broadcast(most), "b_id").select(
        "code", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")
    discard(counts)
    return out


def _sums(blocks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """A block's documents: links whose pair is its B id's most frequent, and the counts of all links."""
    n, best = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    n[counts["pos"].to_numpy()] = counts["n"].to_numpy()
    best[counts["pos"].to_numpy()] = counts["best"].to_numpy()
    doc, which, times = _held(blocks["held"].iloc[0])
    nth = np.flatnonzero(np.bincount(doc) > 0)
    first = np.searchsorted(doc, nth)
    return pd.DataFrame({"block": blocks["block"].iloc[0], "nth": nth.astype(np.int32),
                         "n_best": np.add.reduceat(times * best[which], first),
                         "count_sum": np.add.reduceat(times * n[which], first)})


def corpus_scores(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, nth, n_best, count_sum) of the documents with links."""
    blocks = aligned.filter("nth is null")
    asked = blocks.select(F.col("block").alias("asker"), F.posexplode("codes").alias("pos", "code"))
    told = asked.join(counts.select("code", "n", F.col("best").cast("int").alias("best")), "code").drop("code")
    return blocks.select("block", "held").groupBy("block").cogroup(told.groupBy("asker")).applyInPandas(
        _sums, f"{_KEYS}, n_best long, count_sum long")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path
    rows = align(read(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = landed(rows.withColumn("groups_sha256", groups).drop("groups"), "aligned")
    counts = pair_counts(rows, Pieces(path("piece_bpe_32k.model")).size)
    scores = landed(corpus_scores(rows, counts), "alignment-scores")
    docs = rows.filter("nth is not null")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = landed(docs.join(scores, ["block", "nth"], "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), *_COUNTS, zero("n_best"), zero("count_sum"), "groups_sha256"),
        "alignment")
    discard(rows, counts, scores)
    return out
