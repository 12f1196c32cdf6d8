"""Pairs of short texts are links by their full sets, whatever their sketches say."""

import numpy as np
import pandas as pd

from settlekit.llm import neardup


def _pair(rng):
    """Two sets of 3 and 4 at 0.75 that share a band, but too few bins."""
    while True:
        b = np.unique(rng.integers(0, 2**64, 4, dtype=np.uint64))
        a = np.delete(b, rng.integers(4))
        x, y = neardup.sketch(a), neardup.sketch(b)
        if (x == y).any() and (x.view(np.uint16) == y.view(np.uint16)).sum() < neardup.LEAST_BINS:
            return a, b, x, y


def test_short_pairs_below_the_sketch_bound_are_links(spark):
    a, b, x, y = _pair(np.random.default_rng(5))
    band = int((x == y).argmax())
    g = pd.DataFrame({"g": 1, "band": band, "role": [0, 1], "c": [b"a", b"b"], "root": [b"a", b"b"], "n": [3, 4],
                      "sig": [x, y], "s": [a.view(np.int64), b.view(np.int64)]})
    assert neardup._compare(g) == [(b"a", b"b", True)]
    classes = spark.createDataFrame([(bytearray(b"a"), 3, x.tolist()), (bytearray(b"b"), 4, y.tolist())],
                                    "c binary, n long, sig array<long>")
    star = spark.createDataFrame([(bytearray(b"a"), bytearray(b"b"))], "a binary, b binary")
    assert neardup._plausible(star, classes).count() == 1
