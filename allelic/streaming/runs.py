"""Tables that grow by micro-batches, as runs named by a manifest.

A table lies in parts (hash buckets, event dates); a part is a list of runs,
``{base}/{run column}={batch}/{part column}={part}``, from the oldest to the
newest.  A batch writes one run of each part it touches, and may take in the
part's newest runs: those of at most twice the size of what it writes, so a
row is written again only when what it lies with grows by half.  What a
batch writes follows the batch, not the table, and a part has few runs.

``version={batch}`` under the manifest folder names every run, and is written
after them.  A replayed batch starts from the manifest before it and rewrites
its own runs and manifest.  Runs that the newest manifests don't name are
deleted after that.
"""

from __future__ import annotations

import json
import os
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

#: Runs of each part: (batch, rows), from the oldest.
Held = dict[str | None, list[tuple[int, int]]]
#: Spark's folder name of a NULL part.
_NULL = "__HIVE_DEFAULT_PARTITION__"


class Table(NamedTuple):
    """Where a table's runs and manifests are."""
    base: str
    manifests: str
    run: str
    part: str

    def folder(self, run: int, part: str | None) -> str:
        return os.path.join(self.base, f"{self.run}={run}", f"{self.part}={_NULL if part is None else part}")


def read_manifest(spark: SparkSession, table: Table, version: int) -> tuple[dict, Held]:
    """The table's settings and its runs: a row for each run of a part."""
    held: Held = {}
    settings = {}
    for r in sorted(spark.read.parquet(os.path.join(table.manifests, f"version={version}")).collect(), key=lambda r: r["run"]):
        if r["settings"] is not None:
            settings = json.loads(r["settings"])
        else:
            held.setdefault(r["part"], []).append((r["run"], r["rows"]))
    return settings, held


def write_manifest(spark: SparkSession, table: Table, version: int, settings: dict, held: Held) -> None:
    rows = [(part, run, n, None) for part, runs in held.items() for run, n in runs] + [(None, -1, 0, json.dumps(settings))]
    (spark.createDataFrame(rows, "part string, run long, rows long, settings string").coalesce(1)
     .write.mode("overwrite").parquet(os.path.join(table.manifests, f"version={version}")))


def previous(spark: SparkSession, table: Table, batch_id: int) -> tuple[dict | None, Held]:
    """Settings and runs before a batch; no settings if it is the first."""
    before = latest_version(spark, table.manifests, before=batch_id)
    return (None, {}) if before is None else read_manifest(spark, table, before)


def take_in(held: Held, touched: dict[str | None, int], *, unless_over: int, most: int) -> tuple[list[tuple[int, str | None]], Held]:
    """The (run, part) that a batch takes in, by the rows it brings to each
    part, and the runs that stay.  Parts of up to ``unless_over`` runs are left
    alone; of one with ``most`` runs or more all are taken in."""
    taken, left = [], {part: list(runs) for part, runs in held.items()}
    for part, size in touched.items():
        runs = left.setdefault(part, [])
        if len(runs) <= unless_over:
            continue
        every = len(runs) >= most
        while runs and (every or runs[-1][1] <= 2 * size):
            run, rows = runs.pop()
            taken.append((run, part))
            size += rows
    return taken, left


def read_runs(spark: SparkSession, table: Table, wanted: list[tuple[int, str | None]]) -> DataFrame:
    """The rows of some (run, part), with the part as a column."""
    folders = [table.folder(run, part) for run, part in sorted(wanted, key=str)]
    return spark.read.option("basePath", table.base).parquet(*folders).drop(table.run)


def all_runs(held: Held) -> list[tuple[int, str | None]]:
    return [(run, part) for part, runs in held.items() for run, _ in runs]


def forget(spark: SparkSession, table: Table, batch_id: int, keep: int) -> None:
    """Deletes manifests before the ``keep`` newest, and the runs only they name."""
    versions = numbered(spark, table.manifests, "version=")
    old = [v for v in versions[:-keep] if v < batch_id]
    if not old:
        return

    def named(which: list[int]) -> set[tuple[int, str | None]]:
        return {x for v in which for x in all_runs(read_manifest(spark, table, v)[1])}
    kept, gone = named([v for v in versions if v not in old]), named(old)
    still = {run for run, _ in kept}
    for run in sorted({run for run, _ in gone} - still):
        delete(spark, os.path.join(table.base, f"{table.run}={run}"))
    for run, part in gone - kept:
        if run in still:
            delete(spark, table.folder(run, part))
    for v in old:
        delete(spark, os.path.join(table.manifests, f"version={v}"))


def _hadoop(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the finished folders ``{prefix}{number}`` under ``path``, ascending."""
    fs, hpath = _hadoop(spark, path)
    if not fs.exists(hpath):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(hpath) if fs.exists(
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def has_parts(spark: SparkSession, path: str) -> bool:
    """Whether a table written by parts has any: Spark writes no part for a table without rows."""
    fs, hpath = _hadoop(spark, path)
    return any(st.isDirectory() for st in fs.listStatus(hpath))


def delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop(spark, path)
    fs.delete(hpath, True)


def latest_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """Highest committed snapshot version (optionally below ``before``).
    Lists the snapshot folder through the Hadoop FileSystem of the session,
    so it works on HDFS and object stores as well as local disks."""
    vs = [v for v in numbered(spark, path, "version=") if before is None or v < before]
    return max(vs) if vs else None
