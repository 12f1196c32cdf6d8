"""Operator 3, quality rules: a threshold table compiled into one projection.

``measure`` computes every ratio with built-in expressions only (no user
function, no shuffle: all statistics are of one text), ``RULES`` is the
threshold table, ``verdict`` compiles it into one boolean expression.

Edge cases: a null, empty or blank text has no words and is rejected by the
base rule; a null or unknown language uses the stop words of all languages;
repeated rows are judged alike, one by one; other columns are carried
untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, packed, read, unpacked, without, words_of

#: fixed values: frequent function words by language
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his i in is it not of on or "
          "she that the their they this to was we were which with you".split(),
    "de": "als auch auf aus bei das dem den der des die ein eine er es für ich im in ist mit nach "
          "nicht sich sie sind so und von war wie wir zu".split(),
    "fr": "à au aux avec ce dans de des du elle en est et il je la le les mais ne nous on ou par "
          "pas pour qui que sa se son sur un une vous".split(),
    "es": "a al como con de del el en es la las lo los más mi no o para pero por que se si sin su "
          "un una y ya yo".split(),
}
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """Keep a text when low <= metric <= high (a missing bound is open)."""
    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: the threshold table
RULES = (
    Rule("mean word length", "mean_word", 1.5, 20.0),
    Rule("symbols per word", "symbol_ratio", None, 0.35),
    Rule("upper-case letters per word character", "upper_ratio", None, 0.35),
    Rule("exclamation marks per word", "bang_ratio", None, 0.5),
    Rule("stop words per word", "stop_ratio", 0.02, None),
    Rule("repeated lines per line", "dup_line_ratio", None, 0.5),
    Rule("lines that end in an ellipsis", "ellipsis_ratio", None, 0.5),
    Rule("lines that start with a bullet", "bullet_ratio", None, 0.9),
)


def stop_set(words: list[str]) -> list[str]:
    return sorted(set(words) | {w[:1].upper() + w[1:] for w in words})


def _count_in(words: Column, members: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(members)))


def measure(docs: DataFrame, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``_row`` (the document) and its counts and ratios.

    The columns are built in steps so that an array used several times (the
    words, the lines, the window hashes) is computed once per text.
    """
    df = packed(docs).withColumn("_t", F.coalesce(F.col(f"_row.`{text}`"), F.lit("")))
    df = df.withColumn("_words", words_of(F.col("_t")))
    df = df.withColumn(
        "_lines", F.filter(F.split("_t", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    n = F.size("_words")
    df = df.withColumn("n_words", n.cast("long")).withColumn(
        "_win", F.when(n < 5, F.array().cast("array<bigint>")).otherwise(
            F.expr("transform(sequence(1, size(_words) - 4), i -> xxhash64(slice(_words, i, 5)))")))
    # only a text that has some window twice pays for the sort by position
    df = df.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("_twice", F.sort_array(F.expr(
        "transform(filter(transform(_sorted, (s, j) -> named_struct('i', s.i, 'd',"
        " coalesce(s.h = get(_sorted, j - 1).h, false) or coalesce(s.h = get(_sorted, j + 1).h,"
        " false))), x -> x.d), x -> x.i)")))
    covered = F.expr(
        "aggregate(_twice, named_struct('e', 0, 't', 0L), (a, p) -> named_struct('e', p + 5, 't',"
        " a.t + 5L - greatest(a.e - p, 0)), a -> a.t)")
    chars = F.length(without(F.col("_t"), SPACES)).cast("long")
    drop = lambda chars_: F.length("_t") - F.length(without(F.col("_t"), chars_))
    lang_col = F.col(f"_row.`{lang}`") if lang and lang in docs.columns else F.lit(None)
    stop = _count_in(F.col("_words"), stop_set(sum(STOP_WORDS.values(), [])))
    for code, words in STOP_WORDS.items():
        stop = F.when(lang_col == code, _count_in(F.col("_words"), stop_set(words))).otherwise(stop)
    df = df.select(
        "_row", "n_words", chars.alias("word_chars"), drop(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").alias("_n_lines"), stop.alias("_n_stop"), drop(UPPER).alias("_n_upper"),
        drop("!").alias("_n_bang"),
        F.size(F.filter("_lines", lambda x: x.endswith("...") | x.endswith("…"))).alias("_n_ellipsis"),
        F.size(F.filter("_lines", lambda x: F.ltrim(x).startswith("- ") | F.ltrim(x).startswith("* ")
                        | F.ltrim(x).startswith("• "))).alias("_n_bullet"))
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return df.withColumns({
        "mean_word": per("word_chars", "n_words"), "symbol_ratio": per("n_symbols", "n_words"),
        "upper_ratio": per("_n_upper", "word_chars"), "bang_ratio": per("_n_bang", "n_words"),
        "stop_ratio": per("_n_stop", "n_words"), "dup_line_ratio": per("n_dup_lines", "_n_lines"),
        "ellipsis_ratio": per("_n_ellipsis", "_n_lines"),
        "bullet_ratio": per("_n_bullet", "_n_lines")})


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True when every rule of the table holds."""
    out = F.lit(True)
    for r in rules:
        if r.low is not None:
            out = out & (F.col(r.metric) >= r.low)
        if r.high is not None:
            out = out & (F.col(r.metric) <= r.high)
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
          lang: str | None = "lang") -> DataFrame:
    """``measure`` with ``base_failed``, the name of the first broken rule and ``kept``."""
    broken = F.coalesce(*[F.when(~verdict((r,)), r.name) for r in rules], F.lit(None))
    return measure(docs, text, lang).withColumn("base_failed", base_failed()).withColumns({
        "broken_rule": F.when(F.col("base_failed"), "base").otherwise(broken),
        "kept": ~F.col("base_failed") & verdict(rules)})


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their own columns."""
    # the id keeps the optimiser from moving the filter below the projection,
    # where it would compute every metric once more for each use in a rule
    judged = judge(docs, rules).select("_row", "kept", F.monotonically_increasing_id().alias("_id"))
    return unpacked(judged.filter("kept and _id >= 0"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents")).select(
        "_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "broken_rule")
