"""The last-write-wins snapshot and the archive: what a batch writes, replays, killed batches, odd rows."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from allelic.streaming import runner as R
from allelic.streaming import runs
from allelic.streaming import stateful as ST

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp, v int"


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def _rows(spark, path):
    return {(r.k, r.ts, r.v) for r in ST.read_snapshot(spark, path).collect()}


def _plain(batches):
    out = {}
    for batch in batches:
        for k, ts, v in batch:
            old = out.get(k)
            rank = (ts is not None, ts or T0, v is not None, v or 0)
            if old is None or rank > (old[0] is not None, old[0] or T0, old[1] is not None, old[1] or 0):
                out[k] = (ts, v)
    return {(k, ts, v) for k, (ts, v) in out.items()}


def test_a_batch_writes_what_it_holds(spark, tmp_path):
    root, draw = str(tmp_path / "snap"), random.Random(1)
    first = [(f"p{i}", T0, i) for i in range(20_000)]
    batches = [first]
    ST.upsert_snapshot(spark, spark.createDataFrame(first, SCHEMA), 0, root, ["k"], "ts", buckets=8)
    whole = _bytes(os.path.join(root, "runs", "_run=0"))
    written = []
    for n in range(1, 9):
        batch = [(f"p{draw.randrange(20_000)}", T0 + dt.timedelta(seconds=n), n), (f"new{n}", T0, n)]
        batches.append(batch)
        ST.upsert_snapshot(spark, spark.createDataFrame(batch, SCHEMA), n, root, ["k"], "ts")
        written.append(_bytes(os.path.join(root, "runs", f"_run={n}")))
    assert max(written) < whole / 10
    assert _rows(spark, root) == _plain(batches)
    _, held = runs.read_manifest(spark, ST._snapshot(root), 8)
    assert max(len(runs) for runs in held.values()) <= ST.MOST_RUNS + 1
    assert len(os.listdir(os.path.join(root, "runs"))) <= 1 + 8 * ST.MOST_RUNS
    assert len(runs.numbered(spark, os.path.join(root, "manifest"), "version=")) == 2


def test_replayed_and_killed_batches(spark, tmp_path):
    root, draw = str(tmp_path / "snap"), random.Random(2)
    batches = [[(f"p{draw.randrange(40)}", T0 + dt.timedelta(seconds=draw.randrange(50)), draw.randrange(9)) for _ in range(30)] for _ in range(5)]
    frames = [spark.createDataFrame(b, SCHEMA) for b in batches]
    for n, df in enumerate(frames):
        if n == 3:  # killed after the run was written, before the manifest
            ST.upsert_snapshot(spark, df, n, root, ["k"], "ts")
            runs.delete(spark, os.path.join(root, "manifest", f"version={n}"))
            assert _rows(spark, root) == _plain(batches[:3])
        ST.upsert_snapshot(spark, df, n, root, ["k"], "ts")
        ST.upsert_snapshot(spark, df, n, root, ["k"], "ts")  # replay
        assert _rows(spark, root) == _plain(batches[:n + 1])


def test_odd_rows_and_empty_batches(spark, tmp_path):
    root = str(tmp_path / "snap")
    with pytest.raises(FileNotFoundError):
        ST.read_snapshot(spark, root)
    empty = spark.createDataFrame([], SCHEMA)
    ST.upsert_snapshot(spark, empty, 0, root, ["k"], "ts")
    assert ST.read_snapshot(spark, root).collect() == [] and ST.read_snapshot(spark, root).columns == ["k", "ts", "v"]
    batch = [(None, T0, 1), (None, T0, 3), (None, T0, 2), ("a", None, 5), ("a", None, 4), ("b", None, 1), ("b", T0, None), ("c", T0, 7)] + [("hot", T0, 1)] * 500
    ST.upsert_snapshot(spark, spark.createDataFrame(batch, SCHEMA), 1, root, ["k"], "ts")
    ST.upsert_snapshot(spark, empty, 2, root, ["k"], "ts")
    assert _rows(spark, root) == {(None, T0, 3), ("a", None, 5), ("b", T0, None), ("c", T0, 7), ("hot", T0, 1)}
    assert ST.read_snapshot(spark, root).agg(F.count("*")).first()[0] == 5


# --- archive ------------------------------------------------------------------------
ROWS = "ts timestamp, kind string, person_id string, n int"


def _batch(n):
    """A few rows of today, one late row, one corrupt row without a time."""
    day = dt.datetime(2024, 3, 1) + dt.timedelta(days=n // 10)
    rows = [(day + dt.timedelta(minutes=i * 7 + n), "snp", f"p{i}", n) for i in range(5)]
    return [*rows, (dt.datetime(2024, 2, 1), "snp", "late", n), (None, "corrupt", None, n)]


def _archived(spark, path):
    return sorted(((r.ts, r.kind, r.person_id, r.n) for r in R.read_archive(spark, path).collect()), key=str)


def test_archive_files_stay_few(spark, tmp_path):
    path, expected = str(tmp_path / "archive"), []
    for n in range(24):
        rows = _batch(n)
        expected += rows
        assert R.archive_batch(spark, spark.createDataFrame(rows, ROWS).coalesce(1), n, path) == 1
        if n == 15:  # a merge killed before its manifest, then the replay
            before = _archived(spark, path)
            runs.delete(spark, str(tmp_path / "archive" / "_manifest" / f"version={n}"))
            assert _archived(spark, path) == sorted(expected[:-len(rows)], key=str)
            R.archive_batch(spark, spark.createDataFrame(rows, ROWS).coalesce(1), n, path)
            assert _archived(spark, path) == before
    R.archive_batch(spark, spark.createDataFrame(rows, ROWS).coalesce(1), 23, path)  # replay
    assert _archived(spark, path) == sorted(expected, key=str)
    _, held = runs.read_manifest(spark, R._archive(path), 23)
    assert len(held) == 5 and max(len(x) for x in held.values()) <= R.FEW_RUNS + 6
    files = [f for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * (5 * (R.FEW_RUNS + 6))
    day = R.read_archive(spark, path).filter(F.col("event_date") == dt.date(2024, 3, 1))
    assert day.count() == 50 and {r.event_hour for r in day.select("event_hour").distinct().collect()} <= {0, 1}
    # the corrupt rows have no date and are kept
    assert R.read_archive(spark, path).filter(F.col("event_date").isNull()).count() == 24


def test_archive_of_nothing(spark, tmp_path):
    path = str(tmp_path / "archive")
    with pytest.raises(FileNotFoundError):
        R.read_archive(spark, path)
    assert R.archive_batch(spark, spark.createDataFrame([], ROWS), 0, path) == 0
    with pytest.raises(FileNotFoundError):
        R.read_archive(spark, path)
    R.archive_batch(spark, spark.createDataFrame(_batch(1), ROWS), 1, path)
    assert R.read_archive(spark, path).count() == 7


def test_taking_in_small_runs():
    held = {"a": [(0, 1000), (1, 60), (2, 20), (3, 12)], "b": [(0, 5)], None: [(2, 1)]}
    taken, left = runs.take_in(held, {"a": 10, None: 3}, unless_over=0, most=16)
    assert sorted(taken, key=str) == sorted([(3, "a"), (2, "a"), (1, "a"), (2, None)], key=str)
    assert left == {"a": [(0, 1000)], "b": [(0, 5)], None: []}
    assert runs.take_in(held, {"a": 10}, unless_over=4, most=16) == ([], held)
    assert len(runs.take_in(held, {"a": 1}, unless_over=0, most=4)[0]) == 4
