"""Operator 8: words are hashed once a task, and posts leave the index without a shuffle of the others."""

import numpy as np
import pandas as pd
import pyarrow as pa

from settlekit.llm import linededup


def _counting(monkeypatch):
    seen = []
    hashes = linededup._hashes
    monkeypatch.setattr(linededup, "_hashes", lambda words: (seen.extend(words), hashes(words))[1])
    return seen


def test_repeated_words_are_hashed_once(monkeypatch):
    seen = _counting(monkeypatch)
    texts = ["the river And the\nroad and THE house"] * 500
    parts = pd.concat(linededup._count(iter([pd.DataFrame({"t": texts})])))
    assert len(seen) == 5 and sum(np.frombuffer(n, np.uint32).sum() for n in parts["n"]) == 8 * 500
    seen.clear()
    codes = type("B", (), {"value": np.full(1 << linededup._BITS, 9, np.uint8)})
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(500)), "mark": [7] * 500, "t": texts})
    rows = pa.Table.from_batches(linededup._indexer(codes, 0.85, 1)(iter([batch]))).to_pylist()
    assert len(seen) == 5 and len(rows) == 1000 and len({r["c"] for r in rows}) == 2
    assert rows[0]["c"] == linededup._class(linededup._hashes([b"the", b"river", b"and"]))


def test_chunks_of_any_size_give_the_same_lines(monkeypatch):
    codes = type("B", (), {"value": np.arange(1 << linededup._BITS).astype(np.uint8) | 2})
    texts = ["", " \n\n", "a b c d e f g\n\nx\x1cy a a", "one line only here with seven words", "\n" * 5 + "b a"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array([None, 1, 2, 3, 4] * 3, pa.int64()), pa.array(range(15), pa.int64()),
                                        pa.array(texts)], ["doc_id", "mark", "t"])
    results = []
    for size in (1, 40, 10 ** 6):
        monkeypatch.setattr(linededup, "_CHUNK", size)
        results.append(pa.Table.from_batches(linededup._indexer(codes, 0.85, 1)(iter([batch]))).to_pylist())
    assert results[0] == results[1] == results[2]
    assert [(r["mark"], r["line"], r["n"]) for r in results[0][:4]] == [(2, 0, 7), (2, 2, 2), (3, 0, 7), (4, 5, 2)]
    assert all(len(r["prefix"]) == len(r["at"]) for r in results[0])


def test_only_the_named_classes_leave(spark):
    same_place = [5, 5 + (1 << 24), -(1 << 24) + 5, 6, 69, 5 - (1 << 63)]
    posts = spark.createDataFrame([(w, c) for w in (1, 2) for c in same_place], "word long, c long")
    left = linededup._without(posts, spark.createDataFrame([(5,), (69,)], "c long"))
    assert left.columns == ["word", "c"]
    assert sorted(map(tuple, left.collect())) == sorted((w, c) for w in (1, 2) for c in same_place if c not in (5, 69))
    assert linededup._without(posts, spark.createDataFrame([], "c long")).count() == 12
