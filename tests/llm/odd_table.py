"""The odd table of the newer operators' tests."""

from pyspark.sql import functions as F

ODD = [
    (1, "The river and a house, by the old road.", "en"), (2, None, "en"), (3, "", None), (4, " \n\t ", "xx"),
    (5, "word", "de"), (1, "The river and a house, by the old road.", "en"), (None, "no id  here", None),
    (8, "der die und ist " * 20000, "de"), (9, "x" * 60000, "fr"),
    (10, "Él l'a dit: «ça va»…\n漢字 ß İ \U0001F600 <s></s> <0x41> <|endoftext|> 3.14", "fr"),
    (11, "lower▁one eighth​", "en"), (12, " " * 50 + "a" + " " * 31, "en"), (13, "a\x00b\x1c\x85　c\r\n", None),
    (None, "other text", "en"), (14, " leading and trailing ", "en"),
]


def odd_table(spark):
    """Nulls, empty, very long, repeated and strange texts; further columns
    that operators also use as names."""
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    for name in ("ids", "decoded", "t", "block", "n", "n_a", "links", "groups", "word", "phrase", "a", "l", "r"):
        df = df.withColumn(name, F.lit("x"))
    return df
