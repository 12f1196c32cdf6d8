"""Operator 2 against a plain version of its models, and what they read."""

import math
import re
from collections import Counter, defaultdict

from settlekit.llm import urls

ORDINARY = [f"{a}.{b}.{d}" for a in ("www", "docs", "news", "m") for b in ("library", "weather", "garden", "school", "travel")
            for d in ("example.org", "example.net")]


def _pages(spark, more=()):
    rows = [f"http://{h}/{lang}/{n}" for h in ORDINARY for lang in ("en", "fr", "es") for n in ("about.html", "guide/12", "7")]
    return spark.createDataFrame([*enumerate(rows), *((-1 - n, u) for n, u in enumerate(more))], "page_id long, url string")


def _plain_ratio(examples):
    """Log ratio of a symbol after three others, by plain counts."""
    n, ctx = defaultdict(Counter), defaultdict(Counter)
    for text, accepted, weight in examples:
        text = "^^^" + text
        for i in range(3, len(text)):
            for k in range(4):
                n[accepted][text[i - k:i + 1]] += weight
                ctx[accepted][text[i - k:i]] += weight

    def p(accepted, context, symbol):
        out = 1 / 32
        for k in range(4):
            c = context[3 - k:]
            # contexts hold the characters before, whose own place has k of them
            if (seen := ctx[accepted][c]) >= (1 if k == 0 else urls.LEAST_SEEN):
                out = (n[accepted][c + symbol] + urls.STRENGTH * out) / (seen + urls.STRENGTH)
        return out
    return lambda context, symbol: math.log(p(True, context, symbol) / p(False, context, symbol))


def test_model_and_score_by_plain_counts(spark):
    examples = [("www.tea", True, 1), ("tee.shop", True, 2), ("/en/0.html", True, 1), ("/en/0.html", False, 1),
                ("casino", False, 4), ("best-casino", False, 1)]
    model = urls.train(spark.createDataFrame(examples, "text string, accepted boolean, weight long"))
    assert model.count() == 32 ** 4                     # contexts that were not seen fall back too
    rows = [("tea", "/en/0", 9), ("casinos", "/casino", 20), ("", "", 0), ("zzz", "/q_", 6), ("t.a", "", 3)]
    got = {r.name: r.score for r in urls.score(
        spark.createDataFrame(rows, "name string, tail string, chars int"), model).collect()}
    ratio = _plain_ratio(examples)
    for name, tail, chars in rows:
        want = sum(ratio(("^^^" + t)[i:i + 3], c) for t in (name, tail) for i, c in enumerate(t)) / max(chars, 1)
        assert abs(got[name] - want) < 1e-5, name
    assert got["zzz"] != 0


def test_path_and_whole_host_are_read(spark):
    pages = _pages(spark, ["http://shop.example.com/casino/viagra-jackpot", "http://shop.example.com/about", None,
                           "no scheme", "http://www.library.com/guide", "http://www.library.casino/guide",
                           "http://www.garden.example.com/en/7"])
    out = {r.page_id: r for r in urls.judge(pages).collect() if r.page_id < 0}
    assert out[-1].score < out[-2].score
    assert out[-1].verdict == "block"
    assert [(out[n].score, out[n].verdict) for n in (-3, -4)] == [(None, "block")] * 2
    assert out[-6].score < out[-5].score                # the last label is read where no rule names it
    assert out[-7].score > 0 and out[-7].verdict == "allow"


def test_rule_parts_are_masked(spark):
    rows = urls.labelled_urls(_labelled_rows(spark)).collect()
    assert {(r.name, r.tail, r.chars, r.accepted) for r in rows} == {
        ("a", "/00.html", 24, True), ("b.example", "/0", 18, True), ("b.example", "/es/0", 18, True),
        ("c", "/de/0", 10, False)}


def _labelled_rows(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(u,) for u in (
        "http://a.example.net/en/12.html", "http://a.example.net/fr/1", "http://b.example.org/fr/7",
        "http://b.example.org/es/7", "http://c.net/de/7", "http://d.example.com/es/1", None)], "url string")
    host, path = urls.host_and_path(F.col("url"))
    df = df.withColumns({"host": host, "path": path})
    rule, says = urls.rule_of(F.col("host"), F.col("path"))
    return df.withColumns({"rule": rule, "says": says}).withColumns({
        "name": urls._folded(urls.unruled(F.col("host"))), "tail": urls._folded(urls.unstarted(F.col("path"), F.col("rule"))),
        "chars": F.length("host") + F.length("path")})
