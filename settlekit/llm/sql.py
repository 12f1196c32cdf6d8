"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from . import mixing, neardup, phrases
from .quality import RULES, STOP_WORDS, SYMBOLS, UPPER, stop_set

SQL: dict[str, str] = {}

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"


def _in(words: list[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _quality() -> str:
    stop = "CASE " + " ".join(
        f"WHEN lang = '{code}' THEN len(list_filter(w, lambda x: x IN {_in(stop_set(words))}))"
        for code, words in STOP_WORDS.items())
    stop += f" ELSE len(list_filter(w, lambda x: x IN {_in(stop_set(sum(STOP_WORDS.values(), [])))})) END"
    metric = {"mean_word": "word_chars / greatest(n_words, 1)",
              "symbol_ratio": "n_symbols / greatest(n_words, 1)",
              "upper_ratio": "n_upper / greatest(word_chars, 1)",
              "bang_ratio": "n_bang / greatest(n_words, 1)",
              "stop_ratio": "n_stop / greatest(n_words, 1)",
              "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
              "ellipsis_ratio": "n_ellipsis / greatest(n_lines, 1)",
              "bullet_ratio": "n_bullet / greatest(n_lines, 1)"}
    whens, checks = [], []
    for r in RULES:
        ok = " AND ".join([f"{metric[r.metric]} >= {r.low}"] * (r.low is not None)
                          + [f"{metric[r.metric]} <= {r.high}"] * (r.high is not None))
        checks.append(f"({ok})")
        whens.append(f"WHEN NOT ({ok}) THEN '{r.name}'")
    drop = lambda chars: f"length(t) - length(translate(t, '{chars}', ''))"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t, {WORDS.format('text')} AS w
           FROM documents),
     win AS (SELECT rid, i, array_to_string(w[i:i+4], ' ') AS g
             FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
     twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
     rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid),
     m AS (SELECT d.rid, doc_id, lang, w, t, len(w)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             ({drop(SYMBOLS)})::BIGINT AS n_symbols, {drop(UPPER)} AS n_upper, {drop('!')} AS n_bang,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words
           FROM d LEFT JOIN rep USING (rid)),
     c AS (SELECT *, len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, {stop} AS n_stop,
             len(list_filter(l, lambda x: x LIKE '%...' OR x LIKE '%…')) AS n_ellipsis,
             len(list_filter(l, lambda x: regexp_matches(x, '^ *(- |\* |• )'))) AS n_bullet,
             (len(w) < 10 OR 100 * n_repeat_words > 20 * len(w)) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND {' AND '.join(checks)}) AS kept,
       CASE WHEN base_failed THEN 'base' {' '.join(whens)} END AS broken_rule
FROM c"""


def _mixing() -> str:
    weight = "CASE rank % {} {} END".format(
        len(mixing.WEIGHTS), " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS)))
    most = mixing.PASSES
    return rf"""
WITH RECURSIVE
 d AS (SELECT doc_id, source, len({WORDS.format('text')})::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '/mix') AS mix FROM documents),
 s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
 s AS (SELECT *, {weight} AS weight FROM (
         SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s0)),
 -- the water level rises each round until no open source is above its stop
 lv(n, level) AS (
   SELECT 0, (SELECT sum(source_size) FROM s)::BIGINT / (SELECT sum(weight) FROM s)::BIGINT
   UNION ALL
   SELECT n + 1, (SELECT (sum(source_size) - coalesce(sum({most} * source_size) FILTER (
                          weight * level >= {most} * source_size), 0))::BIGINT
                  / nullif(sum(weight) FILTER (weight * level < {most} * source_size), 0)::BIGINT FROM s)
   FROM lv WHERE n < (SELECT count(*) FROM s)),
 top AS (SELECT max(level) AS level FROM lv),
 q AS (SELECT source, source_size, rank, CASE WHEN weight * level >= {most} * source_size
         THEN ({most} * source_size)::DOUBLE ELSE weight * level END AS target FROM s, top),
 t AS (SELECT doc_id, size, source_size, target, rank, mix,
         sum(size) OVER (PARTITION BY rank ORDER BY mix, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS cum
       FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
 i AS (SELECT *, (turn * source_size + cum) / target AS f FROM t, (SELECT unnest(range({most})) AS turn) WHERE size > 0),
 r AS (SELECT *, sum(size) OVER (ORDER BY f, rank, mix, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS run FROM i),
 k AS (SELECT doc_id, size, mix, cum, rank, count(*) AS turns FROM r WHERE run <= (SELECT sum(size) FROM d)
       GROUP BY ALL)
SELECT t.doc_id, t.size, t.source_size::BIGINT AS source_size, t.target,
       (coalesce(k.turns, 0) * t.size)::BIGINT AS taken, t.cum / t.target AS finish, coalesce(k.turns, 0)::INT AS turns
FROM t LEFT JOIN k ON k.rank = t.rank AND k.cum = t.cum AND k.mix = t.mix AND k.size = t.size
  AND k.doc_id IS NOT DISTINCT FROM t.doc_id"""


SQL["op3_quality_rules"] = _quality()
SQL["op4_mixing"] = _mixing()


def _collocations() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     t AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
     totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM t GROUP BY lang),
     g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
           FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                 FROM t, (SELECT unnest(range(1, {phrases.LONGEST + 1})) AS k) WHERE len(w) >= k)
           GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
     c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
     cuts AS (SELECT lang, k, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y
              FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
     scored AS (SELECT cuts.lang, cuts.phrase, a, gl.f AS l, gr.f AS r, j,
                  ((2000000::HUGEINT * a) // (gl.f + gr.f))::BIGINT AS score
                FROM cuts JOIN g gl ON gl.lang = cuts.lang AND gl.phrase = x
                          JOIN g gr ON gr.lang = cuts.lang AND gr.phrase = y),
     lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
     inside AS (SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer
                FROM c, (SELECT unnest(range(2, {phrases.LONGEST})) AS m), (SELECT unnest(range(1, {phrases.LONGEST})) AS s)
                WHERE m < k AND s + m - 1 <= k GROUP BY 1, 2),
     kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase)
              WHERE longer IS NULL OR 100::HUGEINT * longer < {phrases.COVERED_PCT}::HUGEINT * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
JOIN totals USING (lang) WHERE rank <= {phrases.BEST}"""


SQL["op11_collocations"] = _collocations()


def _near() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    k = neardup.SHINGLE
    return rf"""
WITH RECURSIVE
 d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS.format(f"translate(text, '{upper}', '{lower}')")} AS w FROM documents),
 sh AS (SELECT DISTINCT rid, s FROM (
          SELECT rid, array_to_string(w[i:i + {k - 1}], ' ') AS s
          FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - {k - 2}, 2))) AS i FROM d WHERE len(w) > 0))),
 n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
 -- documents of one set are one class, so that copies give no pairs
 named AS (SELECT rid, n, min(rid) OVER (PARTITION BY n, h) AS c
           FROM (SELECT rid, count(*) AS n, list(s ORDER BY s) AS h FROM sh GROUP BY rid)),
 pairs AS (SELECT a.rid AS a, b.rid AS b, count(*) AS shared
           FROM (sh JOIN named USING (rid)) a JOIN (sh JOIN named USING (rid)) b ON a.s = b.s AND a.rid < b.rid
           WHERE a.rid = a.c AND b.rid = b.c GROUP BY 1, 2),
 links AS (SELECT a, b FROM pairs JOIN n x ON x.rid = a JOIN n y ON y.rid = b
           WHERE 100 * shared >= {neardup.PERCENT} * (x.n + y.n - shared)),
 e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
 reach(c, t) AS (SELECT DISTINCT c, c FROM named UNION SELECT reach.c, e.b FROM reach JOIN e ON e.a = reach.t),
 ids AS (SELECT c, min(doc_id) AS least FROM named JOIN d USING (rid) GROUP BY c),
 roots AS (SELECT reach.c, min(least) AS least FROM reach JOIN ids ON ids.c = reach.t GROUP BY reach.c)
SELECT d.doc_id, coalesce(named.n, 0)::BIGINT AS n_shingles, coalesce(least, d.doc_id) AS component_id,
       (d.doc_id IS NOT DISTINCT FROM coalesce(least, d.doc_id)) AS kept
FROM d LEFT JOIN named USING (rid) LEFT JOIN roots USING (c)"""


SQL["op9_near_dedup"] = _near()
