"""A reconciliation run: feeds + parameters -> lazily built shared frames.

``ReconContext`` owns the DataFrames every query starts from (joined rows,
classified and aged rows, the break cube and the tables read from it).
Nothing is collected to the driver.  Two jobs run when a context is first
used: the duplicate-key check of the join and the write of the row-level
aggregates under the checkpoint dir; everything else stays lazy until the
caller's action.

``materialize()`` writes the classified rows once as parquet under the
cluster's shared ``spark.checkpoint.dir`` (the reference also writes its
report and reads it back) and continues from the files: each summary reads
only its columns, and a later failure re-reads files instead of re-joining
the feeds.  ``release()`` deletes what a context has written.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..config import ReconConfig
from ..operators import aging, breaks, reconcile, summaries
from ..operators.cube import break_cube, row_aggregates
from ..session import remove, scratch
from ..sources import feeds
from ..sources.feeds import Feeds
from . import runs


class ReconContext:
    def __init__(self, spark: SparkSession, feeds: Feeds | None, cfg: ReconConfig | None = None):
        self.spark = spark
        self._feeds = feeds
        self.cfg = cfg or ReconConfig()
        self.run: runs.Run | None = None
        self._recon: DataFrame | None = None
        self._aggregates: DataFrame | None = None
        self._cube: DataFrame | None = None
        self._join_caches: list[DataFrame] = []   # key table of the join
        self._written: list[str] = []

    # -- published runs -------------------------------------------------------
    @classmethod
    def open(cls, spark: SparkSession, out_dir: str, cfg: ReconConfig | None = None,
             inputs: dict[str, str] | None = None, number: int | None = None) -> "ReconContext":
        """Start from a published run (the current one, or ``number``),
        without its feeds.  A run that is not whole, or not made with ``cfg`` and
        of the ``inputs`` as they are now, is refused (``plans.runs``)."""
        run = runs.check(spark, runs.current(spark, out_dir, number), cfg, inputs)
        ctx = cls(spark, None, run.config)
        ctx.run = run
        ctx._recon = ctx._classified(run.read(spark, "reconciliation_report").select(*schemas.JOINED_COLUMNS))
        ctx._rows_kept = True
        ctx._aggregates = run.read(spark, "row_aggregates")
        ctx._cube = run.read(spark, "break_cube").coalesce(1).persist()
        return ctx

    @classmethod
    def of_aggregates(cls, spark: SparkSession, aggregates: DataFrame, cfg: ReconConfig) -> "ReconContext":
        """Summaries and insights over row aggregates that are there already."""
        ctx = cls(spark, None, cfg)
        ctx._aggregates = aggregates
        return ctx

    def publish(self, out_dir: str, fmt: str = "parquet", inputs: dict[str, str] | None = None, keep: int = 2,
                **options) -> runs.Run:
        """Write all outputs and make them the current run of ``out_dir``."""
        return runs.publish(self, out_dir, fmt, inputs, keep, **options)

    @property
    def feeds(self) -> Feeds:
        if self._feeds is None:
            raise runs.RunError("this run was not made from feeds")
        return self._feeds

    # -- row level ----------------------------------------------------------
    @cached_property
    def joined(self) -> DataFrame:
        """J1 + J2: 26 joined columns, presence and audit columns."""
        return reconcile.three_way(self.feeds, self.cfg.strategy, cached=self._join_caches)

    def _classified(self, joined: DataFrame) -> DataFrame:
        aged = aging.add_aging(breaks.classify(joined, self.cfg), self.cfg.as_of)
        side = [c for c in joined.columns if c not in schemas.JOINED_COLUMNS]
        return aged.select(*schemas.REPORT_COLUMNS, *breaks.FLAG_COLUMNS, "break_types", *side)

    @property
    def recon(self) -> DataFrame:
        """Joined rows + flags + labels + value + aging (report columns, the six
        flag_* columns, break_types, presence and audit columns)."""
        if self._recon is None:
            self._recon = self._classified(self.joined)
        return self._recon

    @property
    def report(self) -> DataFrame:
        """The 32-column reconciliation report."""
        return self.recon.select(*schemas.REPORT_COLUMNS)

    @property
    def settlement_breaks(self) -> DataFrame:
        """Report rows that are breaks."""
        return summaries.breaks_only(self.report)

    @property
    def feed_losses(self) -> DataFrame:
        """Lost and missing values per column of the audited feeds, counted on
        the joined rows."""
        return feeds.losses(self.recon)

    @property
    def rejected_rows(self) -> DataFrame:
        """The rows of the audited feeds that lost a value or their key, or were
        malformed, as they came."""
        return feeds.rejects(self.recon)

    @property
    def audited(self) -> bool:
        return any(c in self.recon.columns for c in schemas.AUDIT_COLUMNS)

    # -- shared aggregates -----------------------------------------------------
    def _write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch(self.spark, name)
        df.write.parquet(path)
        self._written.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @property
    def aggregates(self) -> DataFrame:
        """The one-pass aggregation of the rows, written on first use."""
        if self._aggregates is None:
            self._aggregates = self._write(row_aggregates(self.recon, self.cfg), "aggregates")
        return self._aggregates

    @property
    def cube(self) -> DataFrame:
        """All one-key aggregates from one pass over the rows (see
        operators.cube), written on first use.

        The aggregation of the rows is written with whatever partitioning it
        has, and its result, which is bounded by the dimensions (days,
        counterparties, labels, ...), is read back to derive the cube.  The
        cube is kept as one partition, so every query over it is one small
        task without exchanges; a lost block is re-read from the file."""
        if self._cube is None:
            self._cube = self._write(break_cube(self.aggregates, self.cfg), "cube").coalesce(1).persist()
            if self._rows_kept:
                self._release_join_caches()
        return self._cube

    @property
    def daily(self) -> DataFrame:
        return summaries.daily_break_trend(self.cube)

    @property
    def counterparty_summary(self) -> DataFrame:
        return summaries.counterparty_summary(self.cube)

    # -- reuse ---------------------------------------------------------------
    _rows_kept = False   # set once the joined rows are written

    def _release_join_caches(self) -> None:
        for df in self._join_caches:
            df.unpersist()
        self._join_caches.clear()

    def materialize(self) -> "ReconContext":
        """Write the classified rows as parquet and continue from the files."""
        if not self._rows_kept:
            self._recon = self._write(self.recon, "rows")
            self._rows_kept = True
            self._release_join_caches()
        return self

    def release(self) -> None:
        """Drop the caches and delete the written tables; the context must
        not be used afterwards."""
        if self._cube is not None:
            self._cube.unpersist()
        self._release_join_caches()
        for path in self._written:
            remove(self.spark, path)
        self._written.clear()
