"""One row of each near-duplicate component, whatever the ids."""

from collections import Counter

from pyspark.sql import functions as F

from settlekit.llm import neardup

WORDS = [f"w{n}" for n in range(60)]


def text(*changed):
    return " ".join(f"x{n}" if n in changed else w for n, w in enumerate(WORDS))


def test_null_and_shared_ids(spark):
    rows = [(None, text(), "a"), (None, text(1), "b"), (5, text(2), "c"), (5, text(2), "d"), (5, text(3), "e"),
            (None, "alone " * 3 + "p q r s t", "f"), (5, "other words of the same id here", "g"), (5, "", "h"), (5, "", "h"),
            (None, None, "i"), (7, "q w e r t y u", "j"), (7, "q w e r t y u", "j")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [tuple(r) for r in neardup.one_of_each(df).collect()]
    near = [r for r in out if r[1] and r[1].startswith(("w0", "x0"))]
    assert len(near) == 1 and near[0][0] == 5           # an id goes before none
    assert Counter(r for r in out if r not in near) == Counter(
        [rows[5], rows[6], rows[7], rows[8], rows[9], rows[10]])
    assert neardup.near_duplicates(df).filter("root is null").count() == 3


def test_only_null_ids(spark):
    df = spark.createDataFrame([(None, text(), 1), (None, text(4), 2), (None, text(4), 1)], "doc_id long, text string, n int")
    assert neardup.one_of_each(df).count() == 1
    again = neardup.one_of_each(df.repartition(3)).first()
    assert again == neardup.one_of_each(df.orderBy(F.desc("n"))).first()
