"""Rows that share a doc_id are taken each by itself."""

from collections import Counter

from settlekit.llm import mixing


def test_rows_of_one_id_keep_their_own_turns(spark):
    rows = [(None if n % 3 == 0 else 7 if n % 3 == 1 else n, f"a{n} b c", "abc"[n % 3 if n % 2 else 2])
            for n in range(180)]
    rows += [(None, "same text here", "a")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    turns = Counter()
    for r in mixing.mix(df).collect():
        turns[r.doc_id, r.source_size] += r.turns
    got = mixing.mixed(df).collect()
    size = Counter(s for _, _, s in rows)
    assert Counter((r.doc_id, 3 * size[r.source]) for r in got) == +turns
    assert len(got) * 3 <= 3 * len(rows)
    target = {r.source_size: r.target for r in mixing.mix(df).collect()}
    taken = Counter(r.source for r in got)
    assert len(target) == len(size)
    assert all(abs(3 * taken[s] - target[3 * size[s]]) <= 6 for s in size)
