"""Operator 6: credentials by their context, words that a cut context would hit."""

import hashlib

from pyspark.sql import functions as F

from settlekit.llm import pii

SF001 = "/root/testdata/sf0.001"


def _secret(n):
    return hashlib.sha1(str(n).encode()).hexdigest()


def _spans(spark, rows):
    out = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in out}, {r.doc_id: r.found for r in out}


def test_credentials_are_found(spark):
    rows = [(0, f'x token = "{_secret(0)}" y'), (1, f"API_KEY={_secret(1)}###"), (2, f"the password is {_secret(2)[:18]}."),
            (3, f"commit {_secret(3)} of the tree"), (4, "token = twenty-three-words"), (5, "mytoken=1"), (6, None),
            (7, f'Token: "Abc/{_secret(7)}=="'), (8, f"tokens {_secret(8)}")]
    spans, found = _spans(spark, rows)
    assert spans[0] == [("secret", 11, 51)] and spans[1] == [("secret", 8, 48)] and spans[2] == [("secret", 16, 34)]
    assert spans[7] == [("secret", 8, 54)]
    assert not spans[3] and not spans[4] and not spans[5] and not spans[6] and not spans[8]
    assert [found[k] for k in range(5)] == [True, True, True, False, False]


def test_labels_spread_to_unseen_kinds_of_text(spark):
    """A label that mostly stands before known secrets makes the others secrets."""
    rows = [(n, f'session_id: {_secret(n)} and token = "{_secret(n)}" here') for n in range(8)]
    rows += [(20, f"words session_id: {_secret(99)} words"), (21, f"checksum: {_secret(98)} words")]
    spans, _ = _spans(spark, rows)
    assert spans[20] == [("secret", 18, 58)] and not spans[21]
    assert all(len(spans[n]) == 2 for n in range(8))


def test_long_words_are_not_cut(spark):
    long = "w" * 150
    rows = [(n, f"{long}{n % 2} call +1 (2{n:02d}) 555-01{n:02d} now") for n in range(12)]
    df = pii._with_mentions(pii.base_spans(spark.createDataFrame(rows, "doc_id long, text string")))
    left = {r[0] for r in df.select(F.explode("mentions.left")).collect()}
    assert left == {f"{long}{k} call " for k in (0, 1)}
    far = [(1, "a" * 400 + " call +1 (234) 555-0199 " + "b" * 400)]
    df = pii._with_mentions(pii.base_spans(spark.createDataFrame(far, "doc_id long, text string")))
    assert [(m.left, m.right) for m in df.first().mentions] == [(" call ", " ")]


def test_given_texts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = pii.personal_data(docs)
    tokens = docs.filter("text rlike 'token = \"[0-9a-f]{40}\"'").select("doc_id")
    assert out.join(tokens, "doc_id").filter(~F.col("found")).count() == 0
    base = F.transform("base", lambda s: s["kind"])
    assert out.filter(F.array_contains(base, "secret")).count() == 0
