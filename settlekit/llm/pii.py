"""Operator 6, personal data by bootstrapped contextual extraction.

1. Base entities (e-mail, IP address, card, phone number) are found by
   patterns and checks; they are the seeds.
2. Every mention (a base entity, or another token that looks like an
   identifier: seven digits or more, or an ``@``; a run of digit groups
   joined by single spaces, dots, hyphens or brackets, of 7 to 19 digits
   together; or a long mix of letters and digits) has lexical patterns: its
   two words to the left, the words next to it on both sides, and the word with
   a label's punctuation before it (``token = "``).  Words of more than CONTEXT
   letters are no part of a pattern.  A long mix of letters and digits right
   after a word for a credential is a seed of the kind ``secret``.
3. Patterns and mentions form a graph that is scored in ROUNDS rounds: a
   pattern's score for a kind is the share of its mentions that are known to
   be of that kind (with one mention added against it); an identifier's
   score is what its patterns' scores leave of doubt (noisy or).  Patterns
   need LEAST_SEEDS different known identifiers and a score of CONFIDENT.
4. Identifiers of that score are found wherever they are mentioned.

All steps are built-in expressions, groupings and joins.  Patterns use
possessive loops and anchored starts, so a text's cost is linear in its
length.

Edge cases: a null or empty text has no spans; repeated rows have equal
spans; rows are told apart by doc_id and text; offsets count code points,
end exclusive; spans that the method adds never overlap base spans; an empty
table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import land, read

KINDS = ("email", "ip", "card", "phone")
#: what the method finds besides: credentials, by their context only
SECRET = "secret"
ROUNDS, LEAST_SEEDS, CONFIDENT, CONTEXT = 3, 5, 0.8, 100

_LOCAL = "[A-Za-z0-9._%+-]"
#: a start inside a run cannot match where the run's own start did not
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: a white-space separated token with a digit or an @
_TOKEN = r"(?<![^ \t-\r])[^ \t-\r0-9@]*+[0-9@][^ \t-\r]*+"
#: several digit groups with at most one space, dot or hyphen (or `` - ``) and
#: brackets between two; no letter touches a group
_GROUP = r"[0-9]++(?![A-Za-z0-9@])"
_RUN = (rf"(?<![^ \t-\r])[^ \t-\r0-9A-Za-z@]*+{_GROUP}(?:\)?(?: - |[ .-])?\(?{_GROUP})++"
        r"[^ \t-\r0-9A-Za-z@]*+(?![^ \t-\r])")
#: what stands before a run's first group, but for a bracket that closes right after it
_LEAD = r"^(?:(?!\([0-9]+\))[^0-9+])*"
#: a run of letters, digits and the signs of encodings, with a digit in it
_MIX = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}"
#: words for a credential, and what may stand between them and it
_LABEL = (r"(?:^|[^a-z])(?:token|secret|passw(?:or)?d|passphrase|credentials?|bearer|(?:api|access|auth|private|secret)[ _-]?key)"
          r"[\"']?\s*(?:[:=]|=>|\bis\b)?\s*[\"']?$")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled; the cross sum ends in 0."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int")))),
        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return x.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")
    digits = F.regexp_replace(x, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _found(text: Column, pattern: str) -> Column:
    """All matches as structs (start, end, x).  Splitting at the matches gives
    the texts between them, whose lengths give the positions."""
    between, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(F.slice(between, 1, F.greatest(F.size(hits), F.lit(1))), hits,
                       lambda a, b: F.struct(F.length(a).alias("a"), b.alias("b")))
    empty = F.array().cast("array<struct<start:int,end:int,x:string>>")
    walked = F.aggregate(
        F.filter(steps, lambda s: s["b"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, s: F.struct(
            (acc["at"] + s["a"] + F.length(s["b"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + s["a"]).alias("start"), (acc["at"] + s["a"] + F.length(s["b"])).alias("end"),
                s["b"].alias("x")))).alias("out")),
        lambda acc: acc["out"])
    return F.when(F.size(hits) > 0, walked).otherwise(empty)


def base_spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, mark (hash of the text), t, n_<kind>, spans (start, k, end, kind) in order."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(t).alias("mark"), t.alias("t"))
    none = F.array().cast("array<struct<start:int,end:int,x:string>>")
    may = {"email": F.col("t").contains("@"), "phone": F.col("t").contains("+"),
           "ip": F.col("t").rlike(r"[0-9]\.[0-9]"), "card": F.col("t").rlike("[0-9]")}
    for kind in KINDS:
        df = df.withColumn(f"_{kind}", F.when(may[kind], _found(F.col("t"), PATTERNS[kind])).otherwise(none))
        df = df.withColumn(f"_{kind}", F.filter(f"_{kind}", lambda m: _valid(kind, m["x"])))
    for k, kind in enumerate(KINDS):
        df = df.withColumn(f"n_{kind}", F.size(f"_{kind}").cast("long")).withColumn(
            f"_{kind}", F.transform(f"_{kind}", lambda m: F.struct(
                m["start"].alias("start"), F.lit(k).alias("k"), m["end"].alias("end"), F.lit(kind).alias("kind"))))
    spans = F.array_sort(F.concat(*[F.col(f"_{kind}") for kind in KINDS]))
    return df.select("doc_id", "mark", "t", *[f"n_{x}" for x in KINDS], spans.alias("spans"))


def _with_mentions(df: DataFrame) -> DataFrame:
    """Adds mentions: (start, end, kind or null, x, left, right)."""
    df = df.withColumn("_tokens", F.when(F.col("t").rlike("[0-9@]"), _found(F.col("t"), _TOKEN)))
    # outer punctuation is not part of an identifier
    lead = lambda m: F.length(F.regexp_extract(m["x"], "^[^A-Za-z0-9+]*", 0))
    tail = lambda m: F.length(F.regexp_extract(m["x"], "[^A-Za-z0-9]*$", 0))
    like = lambda x: (F.length(F.regexp_replace(x, "[^0-9]", "")) >= 7) | x.rlike("^[^@]+@[^@]+$")
    df = df.withColumn("_tokens", F.filter("_tokens", lambda m: like(m["x"])))
    df = df.withColumn("_tokens", F.transform("_tokens", lambda m: F.struct(
        (m["start"] + lead(m)).alias("start"), (m["end"] - tail(m)).alias("end"), F.lit(None).cast("string").alias("kind"))))
    df = df.withColumn("_tokens", F.filter("_tokens", lambda m: (m["start"] < m["end"]) & ~F.exists(
        "spans", lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"]))))
    # runs of groups, in the text without the base entities; a run wins over the tokens in it
    lone = F.aggregate("spans", F.col("t"), lambda t, s: F.overlay(
        t, F.repeat(F.lit("\n"), s["end"] - s["start"]), s["start"] + 1, s["end"] - s["start"]))
    df = df.withColumn("_runs", F.when(F.col("t").rlike(r"[0-9]\)?(?: - |[ .-])?\(?[0-9]"), _found(lone, _RUN)))
    runlead = lambda m: F.length(F.regexp_extract(m["x"], _LEAD, 0))
    df = df.withColumn("_runs", F.transform(F.filter("_runs", lambda m: F.length(F.regexp_replace(
        m["x"], "[^0-9]", "")).between(7, 19)), lambda m: F.struct(
            (m["start"] + runlead(m)).alias("start"), (m["end"] - tail(m)).alias("end"),
            F.lit(None).cast("string").alias("kind"))))
    df = df.withColumn("_runs", F.coalesce("_runs", F.array().cast("array<struct<start:int,end:int,kind:string>>")))
    df = df.withColumn("_tokens", F.concat("_runs", F.filter(
        F.coalesce("_tokens", F.array().cast("array<struct<start:int,end:int,kind:string>>")), lambda m: ~F.exists(
            "_runs", lambda r: (r["start"] < m["end"]) & (m["start"] < r["end"]))))).drop("_runs")
    # long mixes win over the tokens and runs that they touch
    df = df.withColumn("_mixes", F.when(F.col("t").rlike(_MIX), _found(lone, _MIX)))
    df = df.withColumn("_mixes", F.coalesce(F.transform(F.filter("_mixes", lambda m: _mixed(m["x"])), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.lit(None).cast("string").alias("kind"))),
        F.array().cast("array<struct<start:int,end:int,kind:string>>")))
    df = df.withColumn("_tokens", F.concat("_mixes", F.filter("_tokens", lambda m: ~F.exists(
        "_mixes", lambda r: (r["start"] < m["end"]) & (m["start"] < r["end"]))))).drop("_mixes")
    known = F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"]))
    reach = 2 * CONTEXT + 50
    # a word that the cut of a context has hit is none
    cut_left = lambda m, x: F.when(m["start"] > reach, F.regexp_replace(x, r"^[^\s\p{Punct}]+", "")).otherwise(x)
    cut_right = lambda x: F.when(F.length(x) == reach, F.regexp_replace(x, r"[^\s\p{Punct}]+$", "")).otherwise(x)
    around = lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind"),
        F.lower(F.substring(F.col("t"), m["start"] + 1, m["end"] - m["start"])).alias("x"),
        F.lower(cut_left(m, F.substring(F.col("t"), F.greatest(m["start"] - reach + 1, F.lit(1)),
                                        F.least(m["start"], F.lit(reach))))).alias("left"),
        F.lower(cut_right(F.substring(F.col("t"), m["end"] + 1, F.lit(reach)))).alias("right"))
    secret = lambda m: m["kind"].isNull() & _mixed(m["x"]) & m["left"].rlike(_LABEL)
    mentions = F.transform(F.transform(F.concat(known, "_tokens"), around), lambda m: m.withField(
        "kind", F.when(secret(m), F.lit(SECRET)).otherwise(m["kind"])))
    return df.withColumn("mentions", mentions).drop("_tokens")


def _mixed(x: Column) -> Column:
    """At least 16 letters, digits and signs of encodings, four letters and four digits among them."""
    return x.rlike(r"^[A-Za-z0-9+/_-]{16,}+=*$") & (F.length(F.regexp_replace(x, "[^0-9]", "")) >= 4) & (
        F.length(F.regexp_replace(x, "[^A-Za-z]", "")) >= 4)


def discover(mentions: DataFrame, rounds: int = ROUNDS, seeds: int = LEAST_SEEDS,
             confident: float = CONFIDENT) -> DataFrame:
    """mentions(doc_id, mark, start, end, kind, x, left, right) -> the mentions
    without a kind that the graph gives one: (doc_id, mark, start, end, kind)."""
    word = rf"(?<![^\s\p{{Punct}}])[^\s\p{{Punct}}]{{1,{CONTEXT}}}(?![^\s\p{{Punct}}])"
    before = F.regexp_extract_all("left", F.lit(word), F.lit(0))
    after = F.regexp_extract("right", rf"^[\s\p{{Punct}}]*([^\s\p{{Punct}}]{{1,{CONTEXT}}})(?![^\s\p{{Punct}}])", 1)
    label = F.regexp_extract("left", rf"(?<![^\s\p{{Punct}}])[^\s\p{{Punct}}]{{1,{CONTEXT}}}[\s\p{{Punct}}]*[:=#][\s\p{{Punct}}]*$", 0)
    df = mentions.withColumn("w", before).withColumn("nxt", after)
    two = F.when(F.size("w") >= 2, F.concat(F.lit("L:"), F.get("w", F.size("w") - 2), F.lit(" "),
                                            F.get("w", F.size("w") - 1)))
    both = F.when((F.size("w") >= 1) & (F.col("nxt") != ""), F.concat(
        F.lit("B:"), F.get("w", F.size("w") - 1), F.lit(" _ "), F.col("nxt")))
    named = F.when(label != "", F.concat(F.lit("O:"), F.regexp_replace(label, r"\s+", " ")))
    # the graph's edges, each with how often it occurs
    edges = land(df.select("x", "kind", F.explode(F.filter(F.array(two, both, named), lambda p: p.isNotNull())).alias("p"))
                 .groupBy("p", "x", "kind").agg(F.count("*").alias("n")), "pii-edges")
    size = edges.groupBy("p").agg(F.sum("n").alias("all"))
    # identifiers that are seeds in one place and not in another: seeds everywhere
    loose = edges.filter("kind is null").select("x").distinct()
    sure = land(edges.filter("kind is not null").join(loose, "x").groupBy("x").agg(F.max("kind").alias("kind")).withColumn(
        "score", F.lit(1.0)), "pii-seeds")
    scores = sure                                  # of mentions that are not seeds: x, kind, score
    for _ in range(rounds):
        votes = edges.filter("kind is not null").select("p", "x", "kind", F.col("n").cast("double").alias("v"))
        votes = votes.unionByName(edges.filter("kind is null").drop("kind").join(scores, "x").select(
            "p", "x", "kind", (F.col("n") * F.col("score")).alias("v")))
        good = (votes.groupBy("p", "kind").agg(F.sum("v").alias("v"), F.count_distinct("x").alias("xs"))
                .filter(F.col("xs") >= seeds).join(size, "p")
                .withColumn("s", F.col("v") / (F.col("all") + 1)).filter(F.col("s") >= confident))
        scores = edges.filter("kind is null").select("x", "p").distinct().join(good.select("p", "kind", "s"), "p")
        scores = scores.groupBy("x", "kind").agg(
            (1 - F.exp(F.sum(F.log(1.0000001 - F.col("s"))))).alias("score"))
        # one kind per identifier: that of the highest score
        scores = land(scores.join(sure, "x", "left_anti").unionByName(sure).groupBy("x").agg(F.max(F.struct("score", "kind")).alias("b")).select(
            "x", "b.kind", "b.score"), "pii-scores")
    return (mentions.filter("kind is null").drop("kind").join(scores.filter(F.col("score") >= confident), "x")
            .select("doc_id", "mark", "start", "end", "kind"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_<kind>, base (the base spans) and spans
    (all, secrets among them): arrays of (start, k, end, kind); found: if any."""
    base = land(_with_mentions(base_spans(docs, text, key)).drop("t"), "pii-base")
    mentions = base.select("doc_id", "mark", F.explode("mentions").alias("m")).select("doc_id", "mark", "m.*").distinct()
    order = F.array(*[F.lit(k) for k in (*KINDS, SECRET)])
    seeds = mentions.filter(F.col("kind") == SECRET).select("doc_id", "mark", "start", "end", "kind")
    more = discover(mentions).unionByName(seeds).groupBy("doc_id", "mark").agg(F.collect_set(F.struct(
        "start", (F.array_position(order, F.col("kind")) - 1).cast("int").alias("k"), "end", "kind")).alias("more"))
    more = more.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    return base.join(more, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left").select(
        "doc_id", *[f"n_{x}" for x in KINDS], F.col("spans").alias("base"),
        F.when(F.col("more").isNull(), F.col("spans")).otherwise(
            F.array_sort(F.concat("spans", "more"))).alias("spans")).withColumn("found", F.size("spans") > 0)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents")).select(
        "doc_id", *[f"n_{x}" for x in KINDS], F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"), "found")
