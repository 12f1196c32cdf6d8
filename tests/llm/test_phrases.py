"""Operator 11 against a plain version (its SQL is compared with the others')."""

import os
import re
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from settlekit.llm import phrases

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from odd_table import odd_table  # noqa: E402

SF001 = "/root/testdata/sf0.001"


def plain(rows, least, best):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", (text or "").encode().lower()):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    rows = {}
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        rows[lang, w] = (a, f[lang, w[:k]], f[lang, w[k:]], score)
    out = {}
    for (lang, w), row in rows.items():
        longer = [a for (g, v), (a, *_) in rows.items() if g == lang and len(v) > len(w)
                  and any(v[i:i + len(w)] == w for i in range(len(v)))]
        if not any(100 * a >= 80 * row[0] for a in longer):
            out.setdefault(lang, []).append((-row[3], -row[0], b" ".join(w), row))
    return {(lang, i, w.decode(), a, l, r, n[lang], s) for lang, rows in out.items()
            for i, (_, _, w, (a, l, r, s)) in enumerate(sorted(rows)[:best], 1)}


@pytest.mark.parametrize("block, side, dense, small", [
    (2_000_000, 1024, 1 << 15, 10 ** 6), (400, 4, 3, 10 ** 6), (400, 4, 3, 0), (3000, 16, 40, 60)])
def test_given_texts(spark, monkeypatch, block, side, dense, small):
    for name, value in (("LEAST", 4), ("BLOCK", block), ("SIDE", side), ("DENSE", dense), ("SMALL", small)):
        monkeypatch.setattr(phrases, name, value)
    df = spark.read.parquet(f"{SF001}/documents.parquet").repartition(3)
    out = phrases.collocations(df, best=300)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in out.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    got = [tuple(r) for r in out.collect()]
    want = plain([(r.lang, r.text) for r in df.collect()], 4, 300)
    assert len(got) == len(want) > 300 and set(got) == want


def test_odd_and_empty(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST", 2)
    odd = odd_table(spark)
    got = phrases.collocations(odd).collect()
    assert {tuple(r) for r in got} == plain([(r.lang, r.text) for r in odd.collect()], 2, 2000)
    assert phrases.collocations(odd.limit(0)).count() == 0
    assert phrases.collocations(odd.filter(F.col("text").isNull())).count() == 0


def test_ties_are_in_byte_order(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST", 2)
    df = spark.createDataFrame([(f"{a} {b}",) for a, b in ("zz", "éé", "aé", "\U0001F600q", "ﬀq") for _ in range(2)],
                               "text string").withColumn("lang", F.lit(None).cast("string"))
    got = [r.phrase for r in phrases.collocations(df).orderBy("rank").collect()]
    want = sorted(r[2] for r in plain([(None, r.text) for r in df.collect()], 2, 9))
    assert sorted(got) == want and {tuple(r) for r in phrases.collocations(df).collect()} == plain(
        [(None, r.text) for r in df.collect()], 2, 9)


def test_tiles_count_as_sorting_does(monkeypatch):
    rng = np.random.default_rng(1)
    for side, dense in ((1, 1), (8, 20), (8, 10 ** 9), (1024, 100)):
        monkeypatch.setattr(phrases, "SIDE", side)
        monkeypatch.setattr(phrases, "DENSE", dense)
        a, b = (rng.zipf(1.3, 5000).clip(1, 2 ** 31) for _ in range(2))
        codes, copies = phrases.tile_counts(a, b)
        want, n = np.unique(a << 32 | b, return_counts=True)
        assert (codes == want).all() and (copies == n).all()
    none = np.zeros(0, np.int64)
    assert [len(x) for x in phrases.tile_counts(none, none)] == [0, 0]


def test_large_counts_stay_exact(spark):
    """The score's product passes 64 bits."""
    a, lr = 9_000_000_000_000_000, 9_000_000_000_000_001
    row = spark.range(1).select(F.lit(a).cast("decimal(19,0)").alias("a_"), F.lit(2 * lr).cast("decimal(19,0)").alias("lr"))
    assert row.select(F.expr("(2000000BD * a_) div lr")).first()[0] == 2000000 * a // (2 * lr)
