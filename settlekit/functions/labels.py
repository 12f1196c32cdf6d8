"""Label vocabulary shared by the break, aging and alert operators.

Fixed values: these strings are the output contract of the reference
(labels, bucket names, statuses, severities, alert types) and must be
reproduced exactly.
"""

# --- fixed values: break labels, in the order the checks are applied -------
QUANTITY_MISMATCH = "QUANTITY_MISMATCH"
PRICE_MISMATCH = "PRICE_MISMATCH"
COUNTERPARTY_MISMATCH = "COUNTERPARTY_MISMATCH"
DATE_MISMATCH = "DATE_MISMATCH"
SETTLEMENT_FAILED = "SETTLEMENT_FAILED"
EXCHANGE_QTY_MISMATCH = "EXCHANGE_QTY_MISMATCH"
MATCHED = "MATCHED"
LABEL_SEPARATOR = " | "

# --- fixed values: settlement status that is a break by itself --------------
FAILED_STATUS = "Failed"

# --- fixed values: aging buckets (label, inclusive upper bound in days) -----
AGING_T0_T1 = "T+0 to T+1"
AGING_T2_T3 = "T+2 to T+3"
AGING_4_7 = "4-7 days"
AGING_8_30 = "8-30 days"
AGING_31_90 = "31-90 days"
AGING_90_PLUS = "90+ days"
AGING_UNKNOWN = "Unknown"
AGING_BOUNDS = (
    (AGING_T0_T1, 1),
    (AGING_T2_T3, 3),
    (AGING_4_7, 7),
    (AGING_8_30, 30),
    (AGING_31_90, 90),
)
# display order of the aging distribution (Unknown is not displayed)
AGING_DISPLAY_ORDER = (AGING_T0_T1, AGING_T2_T3, AGING_4_7, AGING_8_30, AGING_31_90, AGING_90_PLUS)
# buckets the AGING_BREAKS alert counts
AGED_BUCKETS = (AGING_31_90, AGING_90_PLUS)

# --- fixed values: alert severities and types, in rule order ---------------
HIGH = "HIGH"
MEDIUM = "MEDIUM"
LOW = "LOW"
BREAK_RATE_SPIKE = "BREAK_RATE_SPIKE"
COUNTERPARTY_CONCENTRATION = "COUNTERPARTY_CONCENTRATION"
HIGH_VALUE_BREAKS = "HIGH_VALUE_BREAKS"
AGING_BREAKS = "AGING_BREAKS"
FAILED_SETTLEMENT_VOLUME = "FAILED_SETTLEMENT_VOLUME"
# substring that marks a failed settlement inside a break label
FAILED_MARKER = "FAILED"

# trend words of the day-over-day break-rate change
TREND_UP = "increased"
TREND_DOWN = "decreased"
TREND_FLAT = "remained stable"

# (name, label) of the six checks in application order; the boolean flag
# column of each check is named flag_<name>
CHECKS = (
    ("quantity", QUANTITY_MISMATCH),
    ("price", PRICE_MISMATCH),
    ("counterparty", COUNTERPARTY_MISMATCH),
    ("date", DATE_MISMATCH),
    ("failed", SETTLEMENT_FAILED),
    ("exchange_qty", EXCHANGE_QTY_MISMATCH),
)
