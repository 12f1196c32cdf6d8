"""Mergeable aggregates kept per trade date (A1-A9): a corrected day replaces
its slice and the cube is derived anew without reading the other days' rows.

A ``DayStore`` is a folder with the row aggregates of every day.  ``create``
writes all days in one pass; ``replace`` reconciles the given days' feeds and
writes their aggregates into a folder of their own; a numbered manifest says
which folder holds which day, and is written last, so readers see the days
before or after a replacement.  The counts and decimal sums of a day are added
up over the days exactly, so the cube is the one of a full run.

A day is the trade date in the feeds.  The feeds have to agree on a trade's
date (``create`` refuses trades whose feeds do not: their legs would be on
different days); a trade that moves to another date is corrected by replacing
both days.  Rows without any date are a day of their own (None).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ReconConfig
from ..operators.cube import measures, merged, row_aggregates
from ..session import remove
from ..sources.feeds import Feeds
from . import runs
from .context import ReconContext

_DAY = "slice_day"


def _slice_day() -> Column:
    return F.coalesce("day_int", "day_cust", "day_exch")


def _on(days: list[_dt.date | None], column: str) -> Column:
    dates = [d for d in days if d is not None]
    hit = F.col(column).isin(dates) if dates else F.lit(False)
    return hit | F.col(column).isNull() if None in days else F.coalesce(hit, F.lit(False))


def feeds_of(feeds: Feeds, days: list[_dt.date | None]) -> Feeds:
    """The feeds' rows of some days; the filter reaches the scans."""
    return Feeds(*[df.where(_on(days, "trade_date")) for df in feeds.as_dict().values()])


class DayStore:
    def __init__(self, spark: SparkSession, path: str):
        """Open the store at ``path``."""
        self.spark, self.path = spark, path.rstrip("/")
        self.number, self.manifest = runs.last_manifest(spark, self.path)
        self.cfg = runs.config_from(self.manifest["config"])

    @classmethod
    def create(cls, spark: SparkSession, feeds: Feeds, path: str, cfg: ReconConfig) -> "DayStore":
        """Reconcile all days and keep their aggregates."""
        ctx = ReconContext(spark, feeds, cfg).materialize()
        try:
            apart = ctx.recon.where(F.greatest("day_int", "day_cust", "day_exch") > F.least("day_int", "day_cust", "day_exch"))
            if not apart.isEmpty():
                raise ValueError("feeds disagree on a trade's date: its legs would be on different days")
            base = f"base-{uuid.uuid4().hex}"
            cls._write(ctx.recon, cfg, f"{path.rstrip('/')}/{base}")
        finally:
            ctx.release()
        runs.write_manifest(spark, path.rstrip("/"), {"config": runs.config_to(cfg), "base": base, "replaced": {}})
        return cls(spark, path)

    @staticmethod
    def _write(recon: DataFrame, cfg: ReconConfig, path: str) -> None:
        rows = row_aggregates(recon.withColumn(_DAY, _slice_day()), cfg, also=_DAY)
        rows.repartition(_DAY).write.partitionBy(_DAY).parquet(path)

    def replace(self, days: list[_dt.date | None], feeds: Feeds) -> "DayStore":
        """The store with these days made anew from ``feeds`` (their other rows
        are not read).  Days without any row are then empty."""
        folder = f"days-{uuid.uuid4().hex}"
        ctx = ReconContext(self.spark, feeds_of(feeds, days), self.cfg)
        self._write(ctx.recon, self.cfg, f"{self.path}/{folder}")
        # on top of what is published now, which may be newer than this object
        now = DayStore(self.spark, self.path)
        replaced = now.manifest["replaced"] | {_key(d): folder for d in days}
        runs.write_manifest(self.spark, self.path, {k: now.manifest[k] for k in ("config", "base")} | {"replaced": replaced})
        return DayStore(self.spark, self.path)

    @property
    def days(self) -> DataFrame:
        """The aggregates of every day, with ``slice_day``."""
        replaced = self.manifest["replaced"]
        gone = [_date(k) for k in replaced]
        base = self._read(self.manifest["base"])
        out = base.where(~_on(gone, _DAY)) if gone else base
        for folder in dict.fromkeys(replaced.values()):
            mine = [_date(k) for k, f in replaced.items() if f == folder]
            out = out.unionByName(self._read(folder).where(_on(mine, _DAY)))
        return out

    def _read(self, folder: str) -> DataFrame:
        return self.spark.read.schema(measures(_DAY)).parquet(f"{self.path}/{folder}")

    def context(self) -> ReconContext:
        """Summaries, alerts and insights of all days; without rows or feeds."""
        return ReconContext.of_aggregates(self.spark, merged(self.days), self.cfg)

    def compact(self) -> "DayStore":
        """All days in one folder again.  The older folders go, so nobody may
        still read the store as it was."""
        base = f"base-{uuid.uuid4().hex}"
        self.days.repartition(_DAY).write.partitionBy(_DAY).parquet(f"{self.path}/{base}")
        old = {self.manifest["base"], *self.manifest["replaced"].values()}
        runs.write_manifest(self.spark, self.path, {"config": self.manifest["config"], "base": base, "replaced": {}})
        for folder in old:
            remove(self.spark, f"{self.path}/{folder}")
        return DayStore(self.spark, self.path)


def _key(day: _dt.date | None) -> str:
    return "none" if day is None else day.isoformat()


def _date(key: str) -> _dt.date | None:
    return None if key == "none" else _dt.date.fromisoformat(key)
