"""Operator 2, URL filter: character language-model ratio.

Two smoothed variable-order Markov models of characters, one of accepted and
one of rejected URLs, score each URL (host and path) by the log-likelihood
difference per character.  Where a domain rule holds, the rule decides.

Examples.  Hosts of which the rules allow a page are accepted, and so are all
their pages that no rule blocks; hosts of which the rules block all pages are
rejected with these pages.  What the rules themselves read would be a leak, so
a host is read without the longest rule domain that fits it (here and when it
is scored), and the path of an example without the start its rule names; these
characters count as ones with a ratio of 0.  A
list of seed names, which together weigh as much as the accepted names, is
added to the rejected ones.  Seeds have no paths: they are given those of the
accepted examples, so that a path does not speak for acceptance only because
it is one.  A name and a path count once, however many pages have them.

A fifth of the labelled hosts is held out, each as a whole; the threshold is
the score below which a share FALSE_REJECTS of the held-out accepted URLs lies
(calibration).

Characters fold to 32 symbols (letters, digit, ``.``, ``/``, ``-``, other,
start), so there are 32^4 contexts with their next symbol: the model table
has 2^20 rows, whatever the input, and is broadcast.  An order is used where its
context was seen LEAST_SEEN times by that model, and is smoothed with the next
lower order; where the context is known and the symbol is new, the lower
orders have the say, and below all of them a uniform choice (back-off).
Training, scoring and calibration are DataFrame operations.  Log ratios are
whole millionths, so the sums are exact in any order.

Edge cases: a null url or one without ``://`` has an empty host and path, so
no rule holds; an url without a host has no score (null) and is blocked; a host
that is a rule's domain is scored by its path alone, and 0 without one;
repeated rows are judged alike; with no held-out accepted host all urls with a
host are allowed; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from .common import land, read

#: fixed values: the domain rules (pattern, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: fixed values: names of rejected hosts
SEEDS = tuple(f"{p}{w}" for p in ("", "www.", "m.", "best-", "free-", "cheap-", "online-") for w in (
    "casino", "bets", "betting", "pills", "poker", "lottery", "jackpot", "slots", "win", "viagra", "replica",
    "loans", "porn", "xxx"))

SYMBOLS = "^abcdefghijklmnopqrstuvwxyz0./-_"      # start, letters, any digit, . / -, any other
ORDER, SIZE = 4, 32
STRENGTH, LEAST_SEEN, HELD_OUT, FALSE_REJECTS = 2.0, 3, 5, 0.005


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (null: none)."""
    pattern = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):     # longer rules override
        domain, _, start = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        pattern, verdict = F.when(fits, text).otherwise(pattern), F.when(fits, says).otherwise(verdict)
    return pattern, verdict


def unruled(host: Column, rules=RULES) -> Column:
    """The host without the longest rule domain that fits it."""
    out = host
    for domain in sorted({r[0].partition("/")[0] for r in rules}, key=len):
        out = F.when(host == domain, "").when(host.endswith("." + domain), F.expr(
            f"left(host, length(host) - {len(domain) + 1})")).otherwise(out)
    return out


def unstarted(path: Column, rule: Column, rules=RULES) -> Column:
    """The path without the start that its rule names, but for the first slash."""
    out = path
    for text, _ in rules:
        start = text.partition("/")[2]
        out = F.when(rule == text, F.expr(f"concat('/', substring(path, {len(start) + 2}))")).otherwise(out)
    return out


def _folded(text: Column) -> Column:
    lower = F.translate(F.lower(F.coalesce(text, F.lit(""))), "123456789", "000000000")
    return F.regexp_replace(lower, r"[^a-z0./\-]", "_")


def _with_grams(df: DataFrame, *parts: str) -> DataFrame:
    """df with ``grams``: the code (four symbols, base 32) of every character
    of the folded parts with the three before it; each part has a start of its own."""
    df = df.withColumn("__c", F.concat(*[x for p in parts for x in (F.lit("^^^"), F.col(f"`{p}`"))])).withColumn(
        "__c", F.expr(f"transform(split(__c, ''), c -> locate(c, '{SYMBOLS}') - 1)"))
    return df.withColumn("grams", F.expr(
        "filter(transform(sequence(4, greatest(size(__c), 4)), i -> ((get(__c, i - 4) * 32 + get(__c, i - 3)) * 32"
        " + get(__c, i - 2)) * 32 + get(__c, i - 1)), g -> g % 32 > 0)")).drop("__c")


def train(examples: DataFrame) -> DataFrame:
    """examples(text, accepted, weight) -> (gram, llr): the log ratio of every
    four-symbol gram, in millionths."""
    count = lambda yes: F.sum(F.when(F.col("accepted") == yes, F.col("weight")).otherwise(0)).alias(
        "a" if yes else "r")
    # explode_outer: for explode Spark infers a filter that repeats the grams' expression per character
    g4 = _with_grams(examples, "text").select("accepted", "weight", F.explode_outer("grams").alias("g"))
    g4 = land(g4.where("g is not null").groupBy("g").agg(count(True), count(False)), "url-grams")
    # every gram's probability by orders 1 to 4: n(context, symbol) and n(context) per model;
    # each of these tables has at most 2^20 rows
    df = examples.sparkSession.range(SIZE ** ORDER).select(F.col("id").cast("int").alias("g")).withColumns(
        {"pa": F.lit(1.0 / SIZE), "pr": F.lit(1.0 / SIZE)})
    for k in range(1, ORDER + 1):
        seen = g4.groupBy((F.col("g") % SIZE ** k).alias("gk")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        ctx = g4.groupBy((F.col("g") % SIZE ** k / SIZE).cast("int").alias("ck")).agg(
            F.sum("a").alias("ca"), F.sum("r").alias("cr"))
        df = df.withColumns({"gk": F.col("g") % SIZE ** k, "ck": (F.col("g") % SIZE ** k / SIZE).cast("int")})
        df = df.join(F.broadcast(ctx), "ck", "left").join(F.broadcast(seen), "gk", "left").na.fill(
            0, ["a", "r", "ca", "cr"])
        df = df.withColumns({f"p{m}": F.when(
            F.col(f"c{m}") >= (1 if k == 1 else LEAST_SEEN),
            (F.col(m) + STRENGTH * F.col(f"p{m}")) / (F.col(f"c{m}") + STRENGTH)).otherwise(F.col(f"p{m}"))
            for m in ("a", "r")}).drop("gk", "ck", "a", "r", "ca", "cr")
    return df.select(F.col("g").alias("gram"), F.round((F.log("pa") - F.log("pr")) * 1e6).cast("long").alias("llr"))


def score(rows: DataFrame, model: DataFrame) -> DataFrame:
    """rows(name, tail, chars, ...) with ``score``: mean log ratio per character."""
    keep = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    one = _with_grams(rows.select(keep, "name", "tail", F.monotonically_increasing_id().alias("_id")),
                      "name", "tail").select("_row", "_id", F.explode_outer("grams").alias("gram"))
    hit = one.join(F.broadcast(model), "gram", "left")        # 2^20 rows of 12 bytes, whatever the input
    return hit.groupBy("_id").agg(F.first("_row").alias("_row"), F.sum(F.coalesce("llr", F.lit(0))).alias("_sum")).select(
        "_row.*", (F.col("_sum") / F.lit(1e6) / F.greatest("_row.chars", F.lit(1))).alias("score"))


def labelled_urls(rows: DataFrame) -> DataFrame:
    """Distinct (name, tail, chars, accepted, held) of the hosts whose class the rules
    settle: accepted if they allow some page, rejected if they block all."""
    hosts = rows.groupBy("name").agg(F.max(F.col("says").eqNullSafe("allow")).alias("accepted"),
                                     F.min(F.col("says").eqNullSafe("block")).alias("rejected"))
    hosts = hosts.where("name <> '' and (accepted or rejected)").select("name", "accepted")
    # an accepted host's pages that a rule blocks are examples of nothing
    texts = rows.where("name <> ''").select("name", "tail", "chars", "says").distinct()
    return texts.join(hosts, "name").where("not accepted or not says <=> 'block'").select(
        "name", "tail", "chars", "accepted", (F.pmod(F.xxhash64("name"), F.lit(HELD_OUT)) == 0).alias("held")).distinct()


def examples_of(labelled: DataFrame, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """(text, accepted, weight) of the hosts that are not held out, and of the seeds."""
    mine = labelled.where("not held")
    names = mine.select(F.col("name").alias("text"), "accepted").distinct()
    paths = mine.select(F.col("tail").alias("text"), "accepted").distinct()
    one = F.lit(1).cast("long").alias("weight")
    out = names.unionByName(paths).select("text", "accepted", one)
    if seeds:
        n = names.where("accepted").count()
        out = out.unionByName(paths.where("accepted").select("text", F.lit(False).alias("accepted"), one))
        out = out.unionByName(labelled.sparkSession.createDataFrame(
            [(s, False, max(1, n // len(seeds))) for s in seeds], "text string, accepted boolean, weight long"))
    return out


def judge(pages: DataFrame, rules=RULES, seeds: tuple[str, ...] = SEEDS, url: str = "url",
          key: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url")).withColumns(
        {"host": host, "path": path})
    pattern, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": pattern, "says": says}).withColumns(
        {"name": _folded(unruled(F.col("host"), rules)),
         "tail": _folded(unstarted(F.col("path"), F.col("rule"), rules)),
         "chars": F.length("host") + F.length("path")}).drop("url")
    labelled = land(labelled_urls(rows), "url-labels")
    model = land(train(examples_of(labelled, seeds)), "url-model")
    bins = score(labelled.where("held and accepted"), model).groupBy(
        F.floor(F.col("score") * 100).alias("bin")).count().collect()      # scores in hundredths
    cut = threshold([(x["bin"], x["count"]) for x in bins])
    free = score(rows.where("rule is null and host <> ''"), model).withColumn(
        "says", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    ruled = rows.where("rule is not null or host = ''").withColumns(
        {"says": F.coalesce("says", F.lit("block")), "score": F.lit(None).cast("double")})
    return free.unionByName(ruled).select("page_id", "host", "path", "rule", F.col("says").alias("verdict"), "score")


def threshold(bins: list[tuple[int, int]], share: float = FALSE_REJECTS) -> float:
    """The highest edge (in hundredths) below which at most ``share`` of the
    accepted scores lie; without any, the lowest of all."""
    below, total = 0, sum(n for _, n in bins)
    for edge, n in sorted(bins):
        below += n
        if below > share * total:
            return edge / 100
    return float("-inf")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages").select("page_id", "url"))
