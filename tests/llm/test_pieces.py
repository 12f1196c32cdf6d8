"""Operator 12 against the sentencepiece library."""

import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
import sentencepiece
from settlekit.llm import catalog, pieces

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from odd_table import odd_table  # noqa: E402

SF001 = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def odd(spark):
    return odd_table(spark)


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return pieces.PieceTokenizer(MODEL)


def _ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_texts_of_any_letters(lib, own):
    rng = random.Random(7)
    alphabet = " ▁aeinrst\n\té漢字\U0001F600<>s0x41\x00​한" + " " * 6
    for n in range(20000):
        text = "".join(rng.choices(alphabet if n % 2 else "etaoinshrdlu", k=rng.randint(0, 50)))
        if n % 5 == 0:
            text = " " * rng.randint(0, 90) + text[:8] + " " * rng.randint(0, 40)
        ids = lib.encode(text, add_bos=True, add_eos=True)
        assert _ids(own.encode(text)) == ids, text
        assert own.decode(ids) == lib.decode(ids), text


def test_backtracking_is_needed_and_right(lib, own):
    """Words where the longest pieces are not the encoding."""
    rng, back = random.Random(3), 0
    for _ in range(5000):
        word = "".join(rng.choices("etaoinshrdlucmfwyp", k=12))
        longest = [i for _, i in own.automaton.iter_long(word)]
        want = own.merged(word)
        back += longest != want
        assert own._run(word) == want
        assert _ids(own.encode(word, False, False)) == lib.encode(word)
    assert back > 100


def test_any_ids_decode(lib, own):
    rng = random.Random(5)
    for _ in range(20000):
        ids = [rng.choice([0, 1, 2, 13, 259, rng.randint(3, 258), rng.randint(0, 31999)])
               for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == lib.decode(ids), ids


def test_older_chunks_are_kept_one_round(own, lib, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 50)
    text = " ".join(f"w{i} again" for i in range(200))
    for _ in range(3):
        assert _ids(own.encode(text)) == lib.encode(text, add_bos=True, add_eos=True)
    assert "x" * 100 not in own.chunk and own.encode("x" * 100) and "x" * 100 not in own.chunk


def _want(lib, rows):
    out = Counter()
    for key, text in rows:
        ids = lib.encode(text or "", add_bos=True, add_eos=True)
        out[key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(lib.decode(ids).encode()).hexdigest()] += 1
    return out


def test_query_on_given_odd_and_empty_tables(spark, lib, odd, tmp_path):
    query = catalog.QUERIES["op12_sentencepiece"]
    for n, df in enumerate((spark.read.parquet(f"{SF001}/documents.parquet"), odd, odd.limit(0))):
        df.write.parquet(f"{tmp_path}/{n}/documents.parquet")
        out = query(spark, f"{tmp_path}/{n}")
        assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert Counter(tuple(r) for r in out.collect()) == _want(lib, rows)


def test_round_trip_of_the_operators(odd):
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    out = pieces.decode(pieces.encode(odd, MODEL, begin=False), MODEL).filter(F.col("doc_id").isNotNull())
    for r in out.collect():
        assert r.decoded == (texts[r.doc_id] or "").replace("▁", " ")
