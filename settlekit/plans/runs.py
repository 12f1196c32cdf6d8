"""Published runs: all outputs of a reconciliation, switched at once.

``publish`` writes every table of a run into a folder of its own and then one
manifest file.  A run exists once its manifest does, so readers see the
previous run or the whole new one, never a mixture; a write that fails leaves
the previous run as it was.

    <out>/run-<id>/<table>/...       the tables
    <out>/_runs/<number>.json        the manifests; the highest number is current

``open_run`` starts from the tables of a published run, without the feeds, in
any session: alerts, summaries and the knowledge base are derived from them.
The manifest names for every table the format, schema, number and bytes of its
files and a digest of their names and sizes, the configuration, and stamps of
the inputs.  A run whose files are not those of its manifest, or whose
configuration or inputs are not the expected ones, is refused.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ReconConfig
from ..session import get_file, names_in, put_file, remove
from ..sources import sinks

FORMAT = 1


class RunError(RuntimeError):
    """No run, or one that cannot be used."""


class StaleRunError(RunError):
    """The run was made of other inputs or with another configuration."""


@dataclasses.dataclass(frozen=True)
class Run:
    """A published run: its number, folder and manifest."""
    out_dir: str
    number: int
    manifest: dict

    @property
    def paths(self) -> dict[str, str]:
        return {name: f"{self.out_dir}/{t['path']}" for name, t in self.manifest["tables"].items()}

    @property
    def config(self) -> ReconConfig:
        return config_from(self.manifest["config"])

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        t = self.manifest["tables"][name]
        return spark.read.format(t["format"]).options(**t["options"]).schema(
            T.StructType.fromJson(t["schema"])).load(self.paths[name])


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _files(spark: SparkSession, path: str, times: bool = False) -> dict:
    """Number, bytes and a digest of the files below a path, listed and summed by Spark."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return {"files": 0, "bytes": 0, "digest": "0"}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    below = F.substring_index("path", f"/{p.getName()}/", -1)
    what = [below, "length", *(["modificationTime"] if times else [])]
    row = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                    F.coalesce(F.sum(F.xxhash64(*what).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest")).first()
    return row.asDict()


def stamps(spark: SparkSession, inputs: dict[str, str] | None) -> dict[str, dict]:
    """A stamp of each input path: changed, added and removed files change it."""
    return {name: _files(spark, path, times=True) for name, path in (inputs or {}).items()}


def config_from(kept: dict) -> ReconConfig:
    fields = {f.name: f.type for f in dataclasses.fields(ReconConfig)}
    return ReconConfig(**{k: _dt.date.fromisoformat(v) if v is not None and "date" in fields[k] else v
                          for k, v in kept.items()})


def config_to(cfg: ReconConfig) -> dict:
    return {k: v.isoformat() if isinstance(v, _dt.date) else v for k, v in dataclasses.asdict(cfg).items()}


def _numbers(spark: SparkSession, out_dir: str) -> list[int]:
    return [int(n[:-5]) for n in names_in(spark, f"{out_dir}/_runs") if n.endswith(".json") and n[:-5].isdigit()]


def _manifest_path(out_dir: str, number: int) -> str:
    return f"{out_dir}/_runs/{number:08d}.json"


def read_manifest(spark: SparkSession, out_dir: str, number: int) -> dict | None:
    """A manifest, or None while it is being written."""
    try:
        found = json.loads(get_file(spark, _manifest_path(out_dir, number)))
    except ValueError:
        return None
    if found.get("format") != FORMAT:
        raise RunError(f"{_manifest_path(out_dir, number)}: unknown format {found.get('format')}")
    return found


def last_manifest(spark: SparkSession, out_dir: str) -> tuple[int, dict]:
    for n in reversed(_numbers(spark, out_dir)):
        manifest = read_manifest(spark, out_dir, n)
        if manifest is not None:
            return n, manifest
    raise RunError(f"no published run in {out_dir}")


def write_manifest(spark: SparkSession, out_dir: str, manifest: dict) -> int:
    """The manifest under the next free number; another writer's number is never overwritten."""
    number = max(_numbers(spark, out_dir), default=0) + 1
    text = json.dumps({"format": FORMAT} | manifest, indent=1)
    while not put_file(spark, _manifest_path(out_dir, number), text):
        number += 1
    return number


def current(spark: SparkSession, out_dir: str, number: int | None = None) -> Run:
    """The published run with the highest number (or the given one)."""
    out_dir = out_dir.rstrip("/")
    if number is None:
        return Run(out_dir, *last_manifest(spark, out_dir))
    manifest = read_manifest(spark, out_dir, number) if number in _numbers(spark, out_dir) else None
    if manifest is None:
        raise RunError(f"no run {number} in {out_dir}")
    return Run(out_dir, number, manifest)


def publish(ctx, out_dir: str, fmt: str = "parquet", inputs: dict[str, str] | None = None, keep: int = 2,
            **options) -> Run:
    """Write every output of ``ctx`` and make it the current run.

    ``inputs`` are the paths of the feeds, whose stamps are kept; ``options``
    go to the writer of the row-level tables.  Of older runs the last ``keep``
    - 1 stay, so that their readers can finish."""
    spark, out_dir = ctx.spark, out_dir.rstrip("/")
    run_id = uuid.uuid4().hex
    folder = f"run-{run_id}"
    stamped = stamps(spark, inputs)                # before the feeds are read
    try:
        tables = {}
        for name, (df, written, how) in sinks.write_tables(ctx, f"{out_dir}/{folder}", fmt, **options).items():
            tables[name] = {"path": f"{folder}/{name}", "format": written, "options": how,
                            "schema": df.schema.jsonValue(), **_files(spark, f"{out_dir}/{folder}/{name}")}
        if stamped != stamps(spark, inputs):
            raise StaleRunError("the inputs changed while the run was made")
        number = write_manifest(spark, out_dir, {
            "run": run_id, "config": config_to(ctx.cfg), "inputs": stamped, "tables": tables})
    except BaseException:
        remove(spark, f"{out_dir}/{folder}")
        raise
    for old in _numbers(spark, out_dir):
        if old <= number - keep:
            gone = read_manifest(spark, out_dir, old)
            remove(spark, _manifest_path(out_dir, old))
            if gone is not None:
                remove(spark, f"{out_dir}/run-{gone['run']}")
    return current(spark, out_dir, number)


def check(spark: SparkSession, run: Run, cfg: ReconConfig | None = None, inputs: dict[str, str] | None = None) -> Run:
    """The run, if its files are those of the manifest and its configuration
    and inputs the expected ones."""
    for name, t in run.manifest["tables"].items():
        found = _files(spark, run.paths[name])
        if found != {k: t[k] for k in found}:
            raise RunError(f"run {run.number} is not whole: {name} has {found['files']} files of {found['bytes']} "
                           f"bytes, its manifest {t['files']} of {t['bytes']}")
    if cfg is not None and config_to(cfg) != run.manifest["config"]:
        other = {k for k, v in config_to(cfg).items() if run.manifest["config"].get(k) != v}
        raise StaleRunError(f"run {run.number} was made with another {', '.join(sorted(other))}")
    now = stamps(spark, inputs)
    changed = [n for n in now if now[n] != run.manifest["inputs"].get(n)]
    if changed:
        raise StaleRunError(f"run {run.number} was made of other {', '.join(changed)}")
    return run
