"""Independent SQL (DuckDB dialect) for every registered query.

The oracle deliberately takes the literal route where the Spark plan takes a
shortcut: two chained FULL OUTER JOINs instead of the key-set strategy,
label strings split with ``string_split`` instead of the flag columns, and
window functions instead of scalar subqueries.  Numbers must still agree
exactly: money is summed as whole millionths here and as decimals there,
rounding is half-even on the scaled double, the sample standard
deviation from exact decimal sums.

Tables ``orders customer nation`` are DuckDB views over the same parquet
files the Spark queries read.
"""

from __future__ import annotations

from settlekit.config import ReconConfig
from settlekit.functions import labels as L
from derived_queries import DERIVED_FEED_CONFIG

# -- small SQL helpers -------------------------------------------------------


def _dbl(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * {_dbl(100)})"


def _half_even(x: str, digits: int) -> str:
    if digits == 0:
        return f"round_even({x}, 0)"
    scale = _dbl(10 ** digits)
    return f"(round_even(({x}) * {scale}, 0) / {scale})"


def _money_sum(x: str) -> str:
    """Millionths as whole numbers; the Spark side sums decimals."""
    micros = f"CAST(round(({x}) * CAST(1000000 AS DOUBLE)) AS HUGEINT)"
    return f"coalesce(CAST(sum({micros}) AS DOUBLE) / CAST(1000000 AS DOUBLE), CAST(0 AS DOUBLE))"


def _count_true(x: str) -> str:
    return f"coalesce(CAST(sum(CASE WHEN {x} THEN 1 ELSE 0 END) AS BIGINT), CAST(0 AS BIGINT))"


def _fmt(x: str, digits: int = 0) -> str:
    """Thousands-separated fixed-point text, like Spark's format_number."""
    return f"format('{{:,.{digits}f}}', CAST({x} AS DOUBLE))"


def _fmt_int(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def _display(label: str) -> str:
    """Every word of the label capitalised."""
    return (f"array_to_string(list_transform(string_split({label}, '_'), "
            f"lambda w: upper(w[1:1]) || lower(w[2:])), ' ')")


# -- shared CTEs -------------------------------------------------------------

def prefix(cfg: ReconConfig = DERIVED_FEED_CONFIG) -> str:
    flags = {
        "flag_quantity": f"coalesce(abs(quantity_int - quantity_cust) > {int(cfg.qty_tol)}, false)",
        "flag_price": f"coalesce(abs(price_int - price_cust) > {_dbl(cfg.price_tol)}, false)",
        "flag_counterparty": "coalesce(counterparty_int <> counterparty_cust, false)",
        "flag_date": "coalesce(settlement_date_int <> settlement_date_cust, false)",
        "flag_failed": f"coalesce(settlement_status = '{L.FAILED_STATUS}', false)",
        "flag_exchange_qty": f"coalesce(abs(quantity_int - quantity_exch) > {int(cfg.qty_tol)}, false)",
    }
    flag_sql = ",\n    ".join(f"{v} AS {k}" for k, v in flags.items())
    parts = ", ".join(f"CASE WHEN flag_{n} THEN '{lab}' END" for n, lab in L.CHECKS)
    label = f"concat_ws('{L.LABEL_SEPARATOR}', {parts})"
    buckets = " ".join(f"WHEN d <= {u} THEN '{lab}'" for lab, u in L.AGING_BOUNDS)
    as_of = cfg.as_of.isoformat()
    return f"""
WITH base AS (
  SELECT o.o_orderkey AS k, o.o_orderkey % 101 AS m,
    CASE WHEN o.o_orderkey IS NOT NULL THEN printf('TRD-%07d', o.o_orderkey) END AS trade_id,
    CAST(o.o_orderdate AS DATE) AS trade_date,
    CAST(o.o_orderdate AS DATE) + 2 AS settlement_date,
    printf('TKR%02d', o.o_orderkey % 25) AS ticker,
    o.o_orderpriority AS trade_type,
    CAST(100 * (1 + o.o_orderkey % 7) AS BIGINT) AS quantity,
    CAST(floor(o.o_totalprice * 100 / (100 * (1 + o.o_orderkey % 7))) AS DOUBLE) / 100 AS price,
    cn.n_name AS counterparty,
    'CUR-' || (o.o_orderkey % 4) AS currency
  FROM orders o
  LEFT JOIN (SELECT c.c_custkey, n.n_name FROM customer c
             LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey) cn
    ON o.o_custkey = cn.c_custkey
),
internal AS (
  SELECT trade_id, trade_date, settlement_date, ticker, trade_type, quantity, price,
    counterparty, currency, quantity * price AS notional_value, 'internal' AS source,
    printf('TR%03d', k % 40) AS trader_id,
    'DESK-' || (k % 3) AS desk,
    printf('%02d:%02d:%02d', 9 + k % 8, (k * 7) % 60, (k * 13) % 60) AS booking_time
  FROM base WHERE m NOT IN (20, 40)
),
custodian AS (
  SELECT trade_id, trade_date, settlement_date, ticker, trade_type, quantity, price,
    counterparty, currency, quantity * price AS notional_value, 'custodian' AS source,
    printf('CUS-%08d', k) AS custodian_ref, settlement_status
  FROM (
    SELECT k, trade_id, trade_date, ticker, trade_type, currency,
      CASE WHEN m IN (9, 10) THEN settlement_date + CAST(1 + k % 4 AS INTEGER)
           ELSE settlement_date END AS settlement_date,
      CASE WHEN m IN (0, 1, 2) THEN quantity + 100 WHEN m = 6 THEN CAST(0 AS BIGINT)
           ELSE quantity END AS quantity,
      CASE WHEN m IN (3, 4) THEN price + CAST(0.05 AS DOUBLE)
           WHEN m = 5 THEN price + CAST(0.01 AS DOUBLE) ELSE price END AS price,
      CASE WHEN m IN (7, 8) THEN 'NATION_' || CAST(k % 25 AS VARCHAR)
           ELSE counterparty END AS counterparty,
      CASE WHEN m IN (0, 1, 2, 7, 8) THEN 'Unmatched' WHEN m IN (3, 4, 5) THEN 'Partial Match'
           WHEN m = 6 OR m BETWEEN 11 AND 20 THEN '{L.FAILED_STATUS}'
           WHEN m IN (9, 10) THEN 'Pending' ELSE 'Matched' END AS settlement_status
    FROM base WHERE m <> 41)
),
exchange AS (
  SELECT trade_id, trade_date, ticker, trade_type, quantity, price, currency,
    quantity * price AS notional_value, 'exchange' AS source,
    printf('EXC-%08d', k) AS exchange_ref,
    'EXCH-' || (k % 3) AS exchange,
    'VENUE-' || (k % 4) AS execution_venue
  FROM (SELECT k, trade_id, trade_date, ticker, trade_type, price, currency,
          CASE WHEN m IN (0, 21) THEN quantity + 100 ELSE quantity END AS quantity
        FROM base WHERE m <> 42)
),
ic AS (
  SELECT coalesce(i.trade_id, c.trade_id) AS trade_id, i.trade_date,
    i.settlement_date AS settlement_date_int, i.ticker, i.trade_type,
    i.quantity AS quantity_int, i.price AS price_int, i.counterparty AS counterparty_int,
    i.currency, i.notional_value AS notional_value_int, i.source, i.trader_id, i.desk,
    i.booking_time,
    c.quantity AS quantity_cust, c.price AS price_cust, c.counterparty AS counterparty_cust,
    c.settlement_date AS settlement_date_cust, c.settlement_status, c.custodian_ref,
    c.notional_value AS notional_value_cust
  FROM internal i FULL OUTER JOIN custodian c ON i.trade_id = c.trade_id
),
joined AS (
  SELECT coalesce(ic.trade_id, e.trade_id) AS trade_id, ic.trade_date, ic.settlement_date_int,
    ic.ticker, ic.trade_type, ic.quantity_int, ic.price_int, ic.counterparty_int, ic.currency,
    ic.notional_value_int, ic.source, ic.trader_id, ic.desk, ic.booking_time,
    ic.quantity_cust, ic.price_cust, ic.counterparty_cust, ic.settlement_date_cust,
    ic.settlement_status, ic.custodian_ref, ic.notional_value_cust,
    e.quantity AS quantity_exch, e.price AS price_exch, e.exchange_ref, e.exchange,
    e.execution_venue
  FROM ic FULL OUTER JOIN exchange e ON ic.trade_id = e.trade_id
),
flagged AS (
  SELECT *,
    {flag_sql}
  FROM joined
),
labeled AS (
  SELECT *, CASE WHEN {label} = '' THEN '{L.MATCHED}' ELSE {label} END AS break_type
  FROM flagged
),
recon AS (
  SELECT *, break_type <> '{L.MATCHED}' AS is_break,
    CASE WHEN break_type <> '{L.MATCHED}' THEN coalesce(notional_value_int, CAST(0 AS DOUBLE))
         ELSE CAST(0 AS DOUBLE) END AS break_value,
    trade_date AS trade_date_dt,
    CAST(date_diff('day', trade_date, DATE '{as_of}') AS INTEGER) AS days_outstanding,
    CASE WHEN date_diff('day', trade_date, DATE '{as_of}') IS NULL THEN '{L.AGING_UNKNOWN}'
         ELSE (SELECT CASE {buckets} ELSE '{L.AGING_90_PLUS}' END
               FROM (SELECT date_diff('day', trade_date, DATE '{as_of}') AS d))
    END AS aging_bucket
  FROM labeled
),
brk AS (SELECT * FROM recon WHERE is_break),
type_counts AS (
  SELECT t AS break_type, count(*) AS count
  FROM (SELECT unnest(string_split(break_type, '{L.LABEL_SEPARATOR}')) AS t FROM brk)
  GROUP BY t
),
cp_summary AS (
  SELECT counterparty_int, count(trade_id) AS total_trades, {_count_true('is_break')} AS breaks,
    {_half_even(f"({_dbl(1)} - CAST({_count_true('is_break')} AS DOUBLE) / CAST(count(*) AS DOUBLE)) * {_dbl(100)}", 1)} AS match_rate,
    {_half_even(_money_sum('break_value'), 1)} AS total_break_value
  FROM recon WHERE counterparty_int IS NOT NULL GROUP BY counterparty_int
),
daily AS (
  SELECT strftime(trade_date, '%Y-%m-%d') AS trade_date_str, count(trade_id) AS total_trades,
    {_count_true('is_break')} AS breaks, {_money_sum('break_value')} AS break_value,
    {_half_even(f"CAST({_count_true('is_break')} AS DOUBLE) / CAST(count(trade_id) AS DOUBLE) * {_dbl(100)}", 2)} AS break_rate
  FROM recon WHERE trade_date IS NOT NULL GROUP BY 1
),
stats AS (
  SELECT count(*) AS days,
    CAST(sum(CAST(break_rate AS DECIMAL(12,2))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_rate,
    CASE WHEN count(*) > 1 THEN sqrt(CAST(count(*) * sum(CAST(break_rate AS DECIMAL(12,2)) * CAST(break_rate AS DECIMAL(12,2)))
                   - sum(CAST(break_rate AS DECIMAL(12,2))) * sum(CAST(break_rate AS DECIMAL(12,2))) AS DOUBLE)
              / CAST(count(*) * (count(*) - 1) AS DOUBLE)) END AS std_rate
  FROM daily
),
cp_counts AS (
  SELECT counterparty_int AS counterparty, count(*) AS breaks
  FROM brk WHERE counterparty_int IS NOT NULL GROUP BY 1
),
facts AS (
  SELECT {_count_true(f"break_value > {_dbl(cfg.high_value)}")} AS high_value_count,
    {_money_sum(f"CASE WHEN break_value > {_dbl(cfg.high_value)} THEN break_value END")} AS high_value_total,
    {_count_true(f"aging_bucket IN ('{L.AGED_BUCKETS[0]}', '{L.AGED_BUCKETS[1]}')")} AS aged_count,
    {_money_sum(f"CASE WHEN aging_bucket IN ('{L.AGED_BUCKETS[0]}', '{L.AGED_BUCKETS[1]}') THEN break_value END")} AS aged_value,
    {_count_true(f"coalesce(contains(break_type, '{L.FAILED_MARKER}'), false)")} AS failed_count
  FROM brk
),
kpis AS (
  SELECT count(*) AS total_trades, {_count_true('is_break')} AS total_breaks,
    {_money_sum('break_value')} AS total_break_value
  FROM recon
)
"""


# -- the per-query SELECTs -----------------------------------------------------

def _report_cols() -> str:
    from settlekit import schemas
    return ", ".join(schemas.REPORT_COLUMNS)


def _joined_cols() -> str:
    from settlekit import schemas
    return ", ".join(schemas.JOINED_COLUMNS)


def _alerts_sql(cfg: ReconConfig) -> str:
    a = L
    return f"""
spikes AS (
  SELECT d.trade_date_str, d.break_rate FROM daily d, stats s
  WHERE d.break_rate > s.mean_rate + {_dbl(cfg.sigma)} * s.std_rate
),
alerts_raw AS (
  SELECT 1 AS rule, CAST(0 AS DOUBLE) AS sub, '{a.HIGH}' AS severity, '{a.BREAK_RATE_SPIKE}' AS alert_type,
    'days=' || CAST(count(*) AS VARCHAR) || '; sigma={cfg.sigma:g}; limit='
      || {_fmt(f"(SELECT mean_rate + {_dbl(cfg.sigma)} * std_rate FROM stats)", 1)}
      || '; mean=' || {_fmt("(SELECT mean_rate FROM stats)", 1)} AS message,
    (SELECT string_agg(trade_date_str, ',' ORDER BY trade_date_str)
       FROM (SELECT trade_date_str FROM spikes ORDER BY trade_date_str LIMIT 5)) AS dates,
    CAST(NULL AS VARCHAR) AS counterparty, CAST(NULL AS BIGINT) AS alert_count
  FROM spikes HAVING count(*) > 0
  UNION ALL
  SELECT 2, -share_pct, '{a.MEDIUM}', '{a.COUNTERPARTY_CONCENTRATION}',
    'counterparty=' || counterparty || '; share=' || {_fmt('share_pct', 1)} || '; limit={cfg.concentration_pct:g}',
    NULL, counterparty, NULL
  FROM conc
  UNION ALL
  SELECT 3, 0, '{a.HIGH}', '{a.HIGH_VALUE_BREAKS}',
    'breaks=' || {_fmt_int('high_value_count')} || '; value=' || {_fmt('high_value_total', 0)}
      || '; limit={cfg.high_value:,.0f}', NULL, NULL, high_value_count
  FROM facts WHERE high_value_count > 0
  UNION ALL
  SELECT 4, 0, '{a.HIGH}', '{a.AGING_BREAKS}',
    'breaks=' || {_fmt_int('aged_count')} || '; value=' || {_fmt('aged_value', 0)}, NULL, NULL, aged_count
  FROM facts WHERE aged_count > 0
  UNION ALL
  SELECT 5, 0, '{a.MEDIUM}', '{a.FAILED_SETTLEMENT_VOLUME}',
    'failed=' || {_fmt_int('failed_count')} || '; limit={cfg.failed_min:,}',
    NULL, NULL, failed_count
  FROM facts WHERE failed_count > {int(cfg.failed_min)}
),
alerts AS (
  SELECT CAST(row_number() OVER (ORDER BY rule, sub, counterparty NULLS FIRST) AS INTEGER) AS alert_rank,
    severity, alert_type, message, dates, counterparty, alert_count
  FROM alerts_raw
)"""


def _conc_sql(cfg: ReconConfig) -> str:
    return f"""
conc AS (
  SELECT counterparty, breaks, {_pct('breaks', '(SELECT sum(breaks) FROM cp_counts)')} AS share_pct
  FROM cp_counts
  WHERE {_pct('breaks', '(SELECT sum(breaks) FROM cp_counts)')} > {_dbl(cfg.concentration_pct)}
)"""


def _faq_sql(cfg: ReconConfig) -> str:
    top_cp = ("(SELECT counterparty_int, breaks, total_break_value FROM cp_summary "
              "ORDER BY breaks DESC, counterparty_int LIMIT 1)")
    return f"""
SELECT 1 AS faq_rank, 'match_rate' AS question,
  'match_rate=' || {_fmt(_pct('total_trades - total_breaks', 'total_trades'), 1)} || '; breaks='
    || {_fmt_int('total_breaks')} || '; trades=' || {_fmt_int('total_trades')} AS answer
FROM kpis
UNION ALL
SELECT 2, 'top_counterparty', 'counterparty=' || counterparty_int || '; breaks=' || {_fmt_int('breaks')}
    || '; value=' || {_fmt('total_break_value', 0)}
FROM {top_cp}
UNION ALL
SELECT 3, 'common_break_types',
  'types=' || string_agg({_display('break_type')} || ' (' || {_fmt_int('count')} || ')', ', '
                         ORDER BY count DESC, break_type)
FROM (SELECT * FROM type_counts ORDER BY count DESC, break_type LIMIT 3)
UNION ALL
SELECT 4, 'high_value_breaks', 'breaks=' || {_fmt_int('high_value_count')} || '; limit={cfg.high_value:,.0f}'
FROM facts
UNION ALL
SELECT 5, 'breaks_by_age', 'ages=' || coalesce((
    SELECT string_agg(aging_bucket || ': ' || {_fmt_int('n')}, ', ' ORDER BY o)
    FROM (SELECT aging_bucket, count(*) AS n,
            CASE aging_bucket {' '.join(f"WHEN '{b}' THEN {i}" for i, b in enumerate(L.AGING_DISPLAY_ORDER, 1))} END AS o
          FROM brk WHERE aging_bucket <> '{L.AGING_UNKNOWN}' GROUP BY aging_bucket)), '')
UNION ALL
SELECT 6, 'alerts', 'alerts=' || CAST((SELECT count(*) FROM alerts) AS VARCHAR) || '; first='
    || coalesce((SELECT string_agg('[' || severity || '] ' || replace(alert_type, '_', ' '), ' '
                                   ORDER BY alert_rank)
                 FROM alerts WHERE alert_rank <= 3), '')"""


def duplicate_key_sql() -> str:
    """Seats of duplicated keys (see operators.reconcile), feed by feed."""
    legs = {0: "TRUE", 1: "NOT (k % 3 = 0 AND n = 2)", 2: "NOT (k % 4 = 0 AND n = 3)"}
    qty = {0: "q", 1: "CASE WHEN k % 5 = 0 AND n = 1 THEN q + 100 ELSE q END",
           2: "CASE WHEN k % 7 = 0 AND n = 4 THEN q + 200 ELSE q END"}
    parts = ["l AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_quantity AS BIGINT) AS q, "
             "CAST(l_extendedprice AS DOUBLE) AS p FROM lineitem)"]
    for i, keep in legs.items():
        parts.append(f"a{i} AS (SELECT k, q, p, row_number() OVER (PARTITION BY k, q, p) AS c "
                     f"FROM (SELECT k, {qty[i]} AS q, p FROM l WHERE {keep}))")
    parts.append("seats AS (SELECT k, q, p, c, sum(bit) AS held FROM ("
                 + " UNION ALL ".join(f"SELECT *, {1 << i} AS bit FROM a{i}" for i in legs) + ") GROUP BY k, q, p, c)")
    for i in legs:
        order = "row_number() OVER (PARTITION BY k ORDER BY q, p, c) AS r"
        parts += [f"alone{i} AS (SELECT k, q, p, c, {order} FROM seats WHERE held = {1 << i})",
                  f"free{i} AS (SELECT k, q, p, c, {order} FROM seats WHERE held & {1 << i} = 0 AND bit_count(held::BIGINT) > 1)",
                  f"""s{i} AS (SELECT a.k, a.q, a.p,
  CASE WHEN x.k IS NULL THEN struct_pack(q := a.q, p := a.p, c := a.c, r := 0)
       WHEN f.k IS NOT NULL THEN struct_pack(q := f.q, p := f.p, c := f.c, r := 0)
       ELSE struct_pack(q := 0, p := 0.0::DOUBLE, c := 0, r := x.r - coalesce(m.n, 0)) END AS seat
  FROM a{i} a LEFT JOIN alone{i} x ON a.k = x.k AND a.q = x.q AND a.p = x.p AND a.c = x.c
  LEFT JOIN free{i} f ON f.k = x.k AND f.r = x.r
  LEFT JOIN (SELECT k, count(*) AS n FROM free{i} GROUP BY k) m ON m.k = a.k)"""]
    far = lambda a, b, tol: f"coalesce(abs({a} - {b}) > {tol}, false)"
    return f"""WITH {", ".join(parts)},
j AS (SELECT coalesce(s0.k, s1.k, s2.k) AS k, s0.q AS q0, s0.p AS p0, s1.q AS q1, s1.p AS p1, s2.q AS q2, s2.p AS p2
  FROM s0 FULL JOIN s1 ON s0.k = s1.k AND s0.seat = s1.seat
  FULL JOIN s2 ON coalesce(s0.k, s1.k) = s2.k AND coalesce(s0.seat, s1.seat) = s2.seat),
t AS (SELECT *, concat_ws('{L.LABEL_SEPARATOR}',
    CASE WHEN {far('q0', 'q1', 0)} THEN '{L.QUANTITY_MISMATCH}' END,
    CASE WHEN {far('p0', 'p1', _dbl(0.01))} THEN '{L.PRICE_MISMATCH}' END,
    CASE WHEN {far('q0', 'q2', 0)} THEN '{L.EXCHANGE_QTY_MISMATCH}' END) AS x FROM j)
SELECT CAST(k AS VARCHAR) AS trade_id, q0 AS quantity_int, p0 AS price_int, q1 AS quantity_cust, p1 AS price_cust,
  q2 AS quantity_exch, p2 AS price_exch, CASE WHEN x = '' THEN '{L.MATCHED}' ELSE x END AS break_type FROM t"""


def queries_sql(cfg: ReconConfig = DERIVED_FEED_CONFIG) -> dict[str, str]:
    p = prefix(cfg)
    more = "," + _conc_sql(cfg) + "," + _alerts_sql(cfg) + ",\nfaq AS (" + _faq_sql(cfg) + "\n)"
    top_cp = ("(SELECT counterparty_int, breaks, total_break_value FROM cp_summary "
              "ORDER BY breaks DESC, counterparty_int LIMIT 1)")
    q = {
        "feed_counts": """
SELECT 'internal' AS feed, count(*) AS rows FROM internal
UNION ALL SELECT 'custodian', count(*) FROM custodian
UNION ALL SELECT 'exchange', count(*) FROM exchange
UNION ALL SELECT 'reconciled', count(*) FROM joined""",
        "internal_vs_custodian": "SELECT * FROM ic",
        "three_way_recon": f"SELECT {_joined_cols()} FROM joined",
        "text_feed_recon": f"SELECT {_joined_cols()} FROM joined",
        "break_flags": ("SELECT trade_id, flag_quantity, flag_price, flag_counterparty, flag_date, "
                        "flag_failed, flag_exchange_qty, break_type, is_break, break_value FROM recon"),
        "break_aging": "SELECT trade_id, trade_date_dt, days_outstanding, aging_bucket FROM recon",
        "reconciliation_report": f"SELECT {_report_cols()} FROM recon",
        "settlement_breaks": f"SELECT {_report_cols()} FROM recon WHERE is_break",
        "recon_kpis": f"""
SELECT total_trades, total_breaks, total_trades - total_breaks AS matched_trades,
  {_pct('total_trades - total_breaks', 'total_trades')} AS match_rate, total_break_value,
  total_break_value / NULLIF(CAST(total_breaks AS DOUBLE), 0) AS avg_break_value
FROM kpis""",
        "break_type_distribution": f"""
SELECT break_type, count, {_pct('count', '(SELECT sum(count) FROM type_counts)')} AS instance_share_pct
FROM type_counts""",
        "top_counterparties": f"""
SELECT counterparty_int AS counterparty, count(*) AS break_count,
  {_money_sum('break_value')} AS break_value
FROM brk WHERE counterparty_int IS NOT NULL GROUP BY 1
ORDER BY break_count DESC, counterparty LIMIT 10""",
        "aging_distribution": f"""
SELECT CASE aging_bucket {' '.join(f"WHEN '{b}' THEN {i}" for i, b in enumerate(L.AGING_DISPLAY_ORDER, 1))} END
    AS display_order, aging_bucket, count(*) AS count
FROM brk WHERE aging_bucket <> '{L.AGING_UNKNOWN}' GROUP BY aging_bucket""",
        "status_distribution": f"""
SELECT settlement_status, count(*) AS count,
  {_pct('count(*)', '(SELECT count(*) FROM recon)')} AS share_pct
FROM recon WHERE settlement_status IS NOT NULL GROUP BY settlement_status""",
        "counterparty_summary": "SELECT * FROM cp_summary",
        "trade_type_summary": f"""
SELECT trade_type, count(trade_id) AS total_trades, {_count_true('is_break')} AS breaks,
  {_half_even(f"({_dbl(1)} - CAST({_count_true('is_break')} AS DOUBLE) / CAST(count(*) AS DOUBLE)) * {_dbl(100)}", 1)} AS match_rate,
  {_half_even(_money_sum('break_value'), 1)} AS total_break_value
FROM recon WHERE trade_type IS NOT NULL GROUP BY trade_type""",
        "daily_break_trend": "SELECT * FROM daily",
        "aging_summary": f"""
SELECT aging_bucket, count(trade_id) AS count, {_half_even(_money_sum('break_value'), 0)} AS total_value
FROM brk GROUP BY aging_bucket""",
        "modal_break_pattern": f"""
SELECT break_type AS modal_label, count(*) AS label_count,
  split_part(break_type, '{L.LABEL_SEPARATOR}', 1) AS top_break
FROM brk GROUP BY break_type ORDER BY label_count DESC, break_type LIMIT 1""",
        "top3_concentration": f"""
SELECT string_agg(counterparty, ', ' ORDER BY breaks DESC, counterparty) AS top3_counterparties,
  CAST(sum(breaks) AS BIGINT) AS top3_breaks, (SELECT count(*) FROM brk) AS total_breaks,
  {_pct('sum(breaks)', '(SELECT count(*) FROM brk)')} AS top3_share_pct
FROM (SELECT * FROM cp_counts ORDER BY breaks DESC, counterparty LIMIT 3)""",
        "modal_trade_type": """
SELECT trade_type, count(*) AS breaks FROM brk WHERE trade_type IS NOT NULL
GROUP BY trade_type ORDER BY breaks DESC, trade_type LIMIT 1""",
        "breaks_by_weekday": """
SELECT dayname(trade_date_dt) AS weekday, count(*) AS breaks FROM brk
WHERE trade_date_dt IS NOT NULL GROUP BY 1""",
        "pattern_facts": f"""
SELECT
  (SELECT string_agg(counterparty, ', ' ORDER BY breaks DESC, counterparty)
     FROM (SELECT * FROM cp_counts ORDER BY breaks DESC, counterparty LIMIT 3)) AS top3_counterparties,
  {_pct('(SELECT sum(breaks) FROM (SELECT * FROM cp_counts ORDER BY breaks DESC, counterparty LIMIT 3))', '(SELECT count(*) FROM brk)')} AS top3_share_pct,
  mt.trade_type AS modal_trade_type, mt.breaks AS modal_trade_type_breaks,
  wd.weekday AS peak_weekday, wd.breaks AS peak_weekday_breaks
FROM (SELECT trade_type, count(*) AS breaks FROM brk WHERE trade_type IS NOT NULL
      GROUP BY 1 ORDER BY breaks DESC, trade_type LIMIT 1) mt,
     (SELECT dayname(trade_date_dt) AS weekday, count(*) AS breaks FROM brk
      WHERE trade_date_dt IS NOT NULL GROUP BY 1 ORDER BY breaks DESC, weekday LIMIT 1) wd""",
        "daily_trend_change": """
SELECT l.trade_date_str AS latest_date, l.break_rate AS latest_rate,
  p.trade_date_str AS previous_date, p.break_rate AS previous_rate,
  l.break_rate - p.break_rate AS rate_change,
  CASE WHEN l.break_rate - p.break_rate > 0 THEN 'increased'
       WHEN l.break_rate - p.break_rate < 0 THEN 'decreased' ELSE 'remained stable' END AS trend
FROM (SELECT * FROM daily ORDER BY trade_date_str DESC LIMIT 1) l,
     (SELECT * FROM (SELECT * FROM daily ORDER BY trade_date_str DESC LIMIT 2)
      ORDER BY trade_date_str LIMIT 1) p""",
        "break_rate_stats": f"""
SELECT days, mean_rate, std_rate, mean_rate + {_dbl(cfg.sigma)} * std_rate AS threshold FROM stats""",
        "break_rate_spikes": f"""
SELECT d.trade_date_str, d.break_rate, s.mean_rate + {_dbl(cfg.sigma)} * s.std_rate AS threshold,
  s.mean_rate
FROM daily d, stats s WHERE d.break_rate > s.mean_rate + {_dbl(cfg.sigma)} * s.std_rate""",
        "counterparty_concentration": "SELECT * FROM conc",
        "high_value_breaks": f"""
SELECT high_value_count, coalesce(high_value_total, CAST(0 AS DOUBLE)) AS high_value_total,
  {_dbl(cfg.high_value)} AS threshold FROM facts""",
        "aged_breaks": "SELECT aged_count, coalesce(aged_value, CAST(0 AS DOUBLE)) AS aged_value FROM facts",
        "failed_settlements": f"""
SELECT failed_count, failed_count > {int(cfg.failed_min)} AS alert_fires FROM facts""",
        "anomaly_alerts": "SELECT * FROM alerts",
        "daily_summary_facts": f"""
SELECT k.total_trades, k.total_breaks,
  {_half_even(_pct('k.total_trades - k.total_breaks', 'k.total_trades'), 1)} AS match_rate,
  k.total_break_value,
  ch.latest_date, ch.latest_rate, ch.previous_date, ch.previous_rate, ch.trend,
  tc.counterparty_int AS top_counterparty, tc.breaks AS top_counterparty_breaks,
  tc.total_break_value AS top_counterparty_value,
  (SELECT split_part(break_type, '{L.LABEL_SEPARATOR}', 1) FROM brk GROUP BY break_type
   ORDER BY count(*) DESC, break_type LIMIT 1) AS top_break_type
FROM kpis k
LEFT JOIN (SELECT l.trade_date_str AS latest_date, l.break_rate AS latest_rate,
             p.trade_date_str AS previous_date, p.break_rate AS previous_rate,
             CASE WHEN l.break_rate - p.break_rate > 0 THEN 'increased'
                  WHEN l.break_rate - p.break_rate < 0 THEN 'decreased'
                  ELSE 'remained stable' END AS trend
           FROM (SELECT * FROM daily ORDER BY trade_date_str DESC LIMIT 1) l,
                (SELECT * FROM (SELECT * FROM daily ORDER BY trade_date_str DESC LIMIT 2)
                 ORDER BY trade_date_str LIMIT 1) p) ch ON true
LEFT JOIN {top_cp} tc ON true""",
        "feed_losses": """
SELECT 'internal' AS feed, c.column_name,
  CASE c.column_name WHEN 'price' THEN (SELECT count(*) FROM base WHERE m NOT IN (20, 40) AND k % 7 = 0)
    WHEN 'trade_date' THEN (SELECT count(*) FROM base WHERE m NOT IN (20, 40) AND k % 11 = 0)
    WHEN 'counterparty' THEN (SELECT count(*) FROM base WHERE m NOT IN (20, 40) AND k % 13 = 0) ELSE 0 END AS lost,
  CASE c.column_name WHEN 'price' THEN (SELECT count(*) FROM base WHERE m NOT IN (20, 40) AND k % 7 = 0)
    WHEN 'trade_date' THEN (SELECT count(*) FROM base WHERE m NOT IN (20, 40) AND k % 11 = 0)
    WHEN 'counterparty' THEN (SELECT count(*) FROM base WHERE m NOT IN (20, 40) AND k % 13 = 0) ELSE 0 END AS missing
FROM (SELECT unnest(['trade_id', 'trade_date', 'settlement_date', 'ticker', 'trade_type', 'quantity', 'price',
  'counterparty', 'currency', 'notional_value', 'source', 'trader_id', 'desk', 'booking_time']) AS column_name) c""",
        "rejected_rows": """
SELECT 'internal' AS feed, trade_id, concat_ws(',', CASE WHEN k % 11 = 0 THEN 'trade_date' END,
    CASE WHEN k % 7 = 0 THEN 'price' END, CASE WHEN k % 13 = 0 THEN 'counterparty' END) AS lost_columns,
  CASE WHEN k % 7 = 0 THEN 'NaN' ELSE CAST(price AS VARCHAR) END AS raw_price
FROM base WHERE m NOT IN (20, 40) AND (k % 7 = 0 OR k % 11 = 0 OR k % 13 = 0)""",
        "dirty_feed_labels": f"""
SELECT trade_id, CASE WHEN n % 13 = 0 THEN NULL ELSE counterparty_int END AS counterparty_int,
  CASE WHEN n % 7 = 0 THEN NULL ELSE price_int END AS price_int,
  CASE WHEN n % 11 = 0 THEN '{L.AGING_UNKNOWN}' ELSE aging_bucket END AS aging_bucket,
  CASE WHEN x = '' THEN '{L.MATCHED}' ELSE x END AS break_type
FROM (SELECT *, concat_ws('{L.LABEL_SEPARATOR}',
    CASE WHEN flag_quantity THEN '{L.QUANTITY_MISMATCH}' END,
    CASE WHEN flag_price AND n % 7 <> 0 THEN '{L.PRICE_MISMATCH}' END,
    CASE WHEN flag_counterparty AND n % 13 <> 0 THEN '{L.COUNTERPARTY_MISMATCH}' END,
    CASE WHEN flag_date THEN '{L.DATE_MISMATCH}' END,
    CASE WHEN flag_failed THEN '{L.SETTLEMENT_FAILED}' END,
    CASE WHEN flag_exchange_qty THEN '{L.EXCHANGE_QTY_MISMATCH}' END) AS x
  FROM (SELECT *, CAST(substr(trade_id, 5) AS BIGINT) AS n FROM recon))""",
        "root_cause_by_type": f"""
SELECT t.break_type, {_display('t.break_type')} AS display_name, t.count,
  {_half_even(_pct('t.count', '(SELECT sum(count) FROM type_counts)'), 1)} AS share_pct,
  CAST(NULL AS VARCHAR) AS root_cause, CAST(NULL AS VARCHAR) AS action,
  CASE t.break_type WHEN '{L.QUANTITY_MISMATCH}' THEN 'HIGH' WHEN '{L.SETTLEMENT_FAILED}' THEN 'HIGH'
    WHEN '{L.PRICE_MISMATCH}' THEN 'MEDIUM' WHEN '{L.COUNTERPARTY_MISMATCH}' THEN 'MEDIUM'
    WHEN '{L.DATE_MISMATCH}' THEN 'LOW' END AS priority
FROM type_counts t""",
        "kb_overview": f"""
SELECT total_trades, total_breaks,
  {_half_even(_pct('total_trades - total_breaks', 'total_trades'), 1)} AS match_rate,
  {_half_even('total_break_value', 2)} AS total_break_value,
  '{cfg.effective_report_date.isoformat()}' AS report_date
FROM kpis""",
        "kb_break_types": f"""
SELECT lower(break_type) AS break_type, count,
  {_half_even(_pct('count', '(SELECT sum(count) FROM type_counts)'), 1)} AS percentage
FROM type_counts""",
        "kb_top_counterparties": f"""
SELECT counterparty_int AS counterparty, total_trades, breaks,
  {_half_even('match_rate', 1)} AS match_rate, {_half_even('total_break_value', 0)} AS break_value
FROM cp_summary ORDER BY breaks DESC, counterparty_int LIMIT 5""",
        "kb_faq": "SELECT * FROM faq",
        "kb_document": f"""
SELECT to_json({{
  'overview': (SELECT {{'total_trades': total_trades, 'total_breaks': total_breaks,
      'match_rate': CAST({_half_even(_pct('total_trades - total_breaks', 'total_trades'), 1)} AS DECIMAL(6,1)),
      'total_break_value': CAST({_half_even('total_break_value', 2)} AS DECIMAL(20,2)),
      'report_date': '{cfg.effective_report_date.isoformat()}'}} FROM kpis),
  'break_types': (SELECT map_from_entries(list({{'key': lower(break_type), 'value': {{'count': count,
      'percentage': CAST({_half_even(_pct('count', '(SELECT sum(count) FROM type_counts)'), 1)} AS DECIMAL(6,1))}}}}
      ORDER BY count DESC, lower(break_type))) FROM type_counts),
  'counterparty_breaks': (SELECT map_from_entries(list({{'key': counterparty_int, 'value': {{
      'total_trades': total_trades, 'breaks': breaks,
      'match_rate': CAST({_half_even('match_rate', 1)} AS DECIMAL(6,1)),
      'break_value': CAST({_half_even('total_break_value', 0)} AS DECIMAL(20,0))}}}}
      ORDER BY breaks DESC, counterparty_int))
    FROM (SELECT * FROM cp_summary ORDER BY breaks DESC, counterparty_int LIMIT 5)),
  'faq_pairs': (SELECT list({{'question': question, 'answer': answer}} ORDER BY faq_rank) FROM faq)
}}) AS kb_json""",
    }
    for same, name in (("reopened_alerts", "anomaly_alerts"), ("reopened_kb", "kb_document"),
                       ("bucketed_recon", "three_way_recon"), ("replaced_days", "daily_break_trend")):
        q[same] = q[name]
    return {name: p + more + "\n" + sql for name, sql in q.items()} | {
        "duplicate_key_recon": duplicate_key_sql()}
