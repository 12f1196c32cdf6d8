"""Operator 12, SentencePiece encoding and decoding of a merge-type model.

A sequence of pieces is the model's encoding of a text exactly when each two
neighbours, merged anew from their characters, give the same two pieces.
``PieceTokenizer`` therefore takes the longest pieces by an Aho-Corasick
automaton, checks every piece against the one before it (the outcome of a
re-merge is kept per pair), goes on to the next shorter piece where they do
not fit, and steps back where no piece fits; positions from which the rest
cannot be reached are marked in a field of failed positions, so each is left
once.  Characters outside the vocabulary become byte pieces.

A merge never crosses from a character to a following space (checked when the
model is read), so a text is encoded chunk by chunk, a chunk being its leading
spaces and the characters up to the next one, and each distinct chunk once per
worker while it is remembered.  Decoding looks at the ids alone.

Spark reads the texts in Arrow batches; nothing is shuffled or kept, memory
is bounded by a batch and the chunks remembered.

Edge cases: a null text counts as empty; an empty text has the begin and end
ids only and decodes to the empty text; repeated rows, null ids and further
columns are left as they are; texts of any length are encoded whole; U+2581
in a text is a space to the model; an empty table gives no row.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept_by_worker, read, send_with_tasks

send_with_tasks(__name__)

SPACE = "▁"
#: chunks remembered before the older ones are forgotten, pairs remembered, longest chunk remembered
CACHE, PAIRS, LONGEST = 150_000, 250_000, 64
_PROBES = ("", " ", "Hello  world, it's 3.14!\n\tÉté   漢字 ▁x", "a" * 40 + " " * 70 + "\U0001F600\x00 <s> <0x41>\r\n")


class PieceTokenizer:
    def __init__(self, path: str):
        import ahocorasick
        import regex
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        special = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        self.piece = [sp.id_to_piece(i) for i in ids]
        self.id = {self.piece[i]: i for i in ids if i not in special}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        if any(sp.is_unused(i) for i in ids) or any(SPACE in p.lstrip(SPACE) for p in self.id) \
                or len(set(self.byte)) < 256 or {c for p in self.id for c in p} - self.id.keys():
            raise ValueError(f"{path}: not a merge-type model with byte pieces that this class can take by chunk")
        self.shorter = [-1] * len(self.piece)      # the longest other piece that starts this one
        for p, i in self.id.items():
            self.shorter[i] = next((self.id[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id), -1)
        self.size = list(map(len, self.piece))
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.chunk: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        known = "".join(regex.escape(p) for p in self.id if len(p) == 1)
        self.runs = regex.compile(f"[{known}]+|[^{known}]+").findall
        self.known = frozenset(p for p in self.id if len(p) == 1)
        self.most = max(map(len, self.id))
        self.spaced = regex.compile(r" +[^ ]*").findall
        self.surface = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else
                        self.piece[i].replace(SPACE, " ").encode() for i in ids]
        for b, i in enumerate(self.byte):
            self.surface[i] = bytes([b])
        self.is_byte = frozenset(self.byte)
        self.control = frozenset(i for i in ids if sp.is_control(i))
        for probe in _PROBES:
            want = sp.encode(probe, add_bos=True, add_eos=True)
            if np.frombuffer(self.encode(probe), "<u4").tolist() != want or self.decode(want) != sp.decode(want):
                raise ValueError(f"{path}: not a model whose texts this class encodes")

    # encoding
    def merged(self, text: str) -> list[int]:
        """The pieces of a short text of known characters by merging: the best
        pair first, of equal ones the leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return [self.id[p] for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, a: int, b: int) -> bool:
        ok = self.fits.get((a, b))
        if ok is None:
            if len(self.fits) > PAIRS:
                self.fits.clear()
            ok = self.fits[a, b] = self.merged(self.piece[a] + self.piece[b]) == [a, b]
        return ok

    def _run(self, text: str) -> list[int]:
        """The pieces of a text of known characters."""
        fits, size = self.fits, self.size
        longest = [i for _, i in self.automaton.iter_long(text)]
        if all(map(fits.get, zip(longest, longest[1:]))):            # pairs seen before
            return longest
        k = next((k for k in range(1, len(longest)) if not self.compatible(longest[k - 1], longest[k])), None)
        if k is None:
            return longest
        taken, following, failed = longest[:k], longest[k], bytearray(len(text) + 1)
        at = sum(map(size.__getitem__, taken))
        while at < len(text):
            piece, last = following, taken[-1] if taken else None
            while piece >= 0:
                to = at + size[piece]
                if not failed[to]:
                    ok = last is None or fits.get((last, piece))
                    if ok or ok is None and self.compatible(last, piece):
                        break
                piece = self.shorter[piece]
            if piece >= 0:
                taken.append(piece)
                at = to
                if at < len(text):
                    following = next(self.automaton.iter_long(text[at:at + self.most]))[1]
            else:                                   # nothing fits here: a shorter one before
                while True:
                    failed[at] = 1
                    last = taken.pop()
                    at -= size[last]
                    following = self.shorter[last]
                    if following >= 0:
                        break
        return taken

    def _ids(self, chunk: str) -> bytes:
        if self.known.issuperset(chunk):
            out = self._run(chunk)
        else:
            out = []
            for run in self.runs(chunk):
                out += self._run(run) if run[0] in self.known else [self.byte[b] for b in run.encode()]
        return struct.pack(f"<{len(out)}I", *out)

    def encode(self, text: str, begin: bool = True, end: bool = True) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        ids = []
        if text:
            if SPACE in text:
                text = text.replace(SPACE, " ")
            chunks = text.split(" ")
            if "" in chunks:
                chunks = [c[1:] for c in self.spaced(" " + text)]
            if len(self.chunk) > CACHE:
                self.chunk, self.older = {}, self.chunk
            known, long = self.chunk, []
            for c in set(chunks).difference(known):
                have = self.older.get(c)
                known[c] = have if have is not None else self._ids(SPACE + c.replace(" ", SPACE))
                if len(c) > LONGEST:
                    long.append(c)
            ids = list(map(known.__getitem__, chunks))
            for c in long:
                del known[c]
        if begin:
            ids.insert(0, self.begin.to_bytes(4, "little"))
        if end:
            ids.append(self.end.to_bytes(4, "little"))
        return b"".join(ids)

    # decoding
    def decode(self, ids) -> str:
        ids = list(ids)
        first = next((k for k, i in enumerate(ids) if self.surface[i]), None)
        if first is None:
            return ""
        if not self.control.isdisjoint(ids[first:-1]):
            return self._decode_broken(ids, first)
        raw = b"".join(map(self.surface.__getitem__, ids))
        if self.piece[ids[first]].startswith(SPACE):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_broken(ids, first)

    def _decode_broken(self, ids: list[int], first: int) -> str:
        """As ``decode``, run of byte pieces by run; every byte that is part of no
        character is U+FFFD."""
        out, run = [], bytearray()

        def flush():
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at:at + n]).decode())
                        break
                    except UnicodeDecodeError:
                        n = 0
                else:
                    out.append("�")
                at += max(n, 1)
            run.clear()
        for k, i in enumerate(ids):
            if i in self.is_byte:
                run += self.surface[i]
                continue
            flush()
            s = self.surface[i].decode()
            out.append(s[1:] if k == first and self.piece[i].startswith(SPACE) else s)
        flush()
        return "".join(out)


def tokenizer(path: str) -> PieceTokenizer:
    return kept_by_worker(("pieces", path), lambda: PieceTokenizer(path))


def encode(docs: DataFrame, model: str, begin: bool = True, end: bool = True,
           text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the ids of every text as little-endian unsigned 32-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(model)
        for b in batches:
            ids = [tok.encode(t or "", begin, end) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])
    src = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded): the text that each row's ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(model)
        for b in batches:
            texts = [tok.decode(np.frombuffer(i, "<u4").tolist()) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])
    encoded = encoded.select("doc_id", "ids")
    return encoded.mapInArrow(
        run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = decode(encode(read(spark, sf_dir, "documents"), model), model)
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
