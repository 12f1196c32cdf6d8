"""settlekit: three-way trade reconciliation and break analytics on Spark.

Layout
------
sources/    feed readers, feed derivation from the driver tables, sinks
operators/  the join, break classification, aging, summaries, trend,
            alerts and insight tables -- DataFrame in, DataFrame out
functions/  fixed label vocabulary and numeric helpers (rounding, money sums)
plans/      ReconContext (shared lazy frames), the query catalog and the
            SQL oracle used for cross-checking
streaming/  incremental (micro-batch) runs of the same operators
"""

from .config import ReconConfig  # noqa: F401
