"""Live alerts and completion checks: equal to the batch operators, over
restarts and late rows."""
import datetime as dt
import os
import random
import tempfile

import pytest

from allelic.operators import family as FAM
from allelic.operators import timeseries as TS
from allelic.streaming import live as L
from allelic.streaming import runner as R

T0 = dt.datetime(2024, 1, 1, 12)


def sec(s):
    return T0 + dt.timedelta(seconds=s)


def feed(spark, root, ddl, parts, live):
    """Each part is a file, read by a query that starts from the checkpoint of
    the one before; returns what the sink holds."""
    src, out = os.path.join(root, "src"), os.path.join(root, "out")
    os.makedirs(src)
    for part in parts:
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ddl).parquet(src)
        R.archive(live(stream), out, os.path.join(root, "ck"), available_now=True).awaitTermination()
    return spark.read.parquet(out)


def bursts(seed):
    rng, rows = random.Random(seed), []
    for s in range(0, 400):
        n = 30 if 120 <= s < 126 else 0 if 200 <= s < 280 else rng.choice([0, 0, 1, 2])
        rows += [(rng.choice(["father", "child"]), sec(s), rng.random() < 0.9) for _ in range(n)]
    return rows


@pytest.mark.parametrize("by", [[], ["member_type"]])
def test_rate_alerts_equal_batch(spark, by):
    ddl = "member_type string, ts timestamp, has_snp boolean"
    rows = bursts(1)
    rng = random.Random(2)
    # out of order by up to 20 s, three runs of the query, then the clock far on
    rows_by_arrival = sorted(rows, key=lambda r: r[1] + dt.timedelta(seconds=rng.uniform(0, 20)))
    k = len(rows_by_arrival) // 3
    end = [(m, sec(10_000), True) for m in ("father", "child")]
    late = [("child", sec(100), True)]
    parts = [rows_by_arrival[:k], rows_by_arrival[k:2 * k], rows_by_arrival[2 * k:], end, late]
    root = tempfile.mkdtemp(prefix="allelic-alert-")
    got = feed(spark, root, ddl, parts, lambda s: L.stream_rate_alerts(s, 10, 60, by=by, watermark="40 seconds"))
    batch = spark.createDataFrame(rows, ddl)
    cols = [*by, "ts", "n_at", "n_short", "n_long", "expected_rate", "current_rate", "deviation", "is_anomaly", "severity"]
    ref = TS.rate_anomaly(batch, 10, 60, by=by, keep_n_at=True).select(*cols)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, ref.collect()))
    # ten of sixty seconds are at most six times the expected rate: never over twice 2.5
    assert {r["severity"] for r in got.collect()} == {"medium", "normal"}
    trend = [*by, "ts", "change_pct", "direction"]
    ref = TS.rate_trend(batch, 10, 60, by=by).select(*trend)
    assert sorted(map(tuple, got.select(*trend).collect())) == sorted(map(tuple, ref.collect()))


def test_rate_alerts_of_a_silent_stream(spark):
    ddl = "member_type string, ts timestamp, has_snp boolean"
    root = tempfile.mkdtemp(prefix="allelic-silent-")
    got = feed(spark, root, ddl, [[("child", sec(s), True) for s in range(60)], [("child", sec(5_000), True)]],
               lambda s: L.stream_rate_alerts(s, 10, 60, 0.9, quiet_ticks=True, watermark="10 seconds")).collect()
    silent = {(r["ts"] - T0).seconds: r for r in got if r["n_at"] == 0}
    assert set(silent) == set(range(60, 119))
    assert silent[75]["n_short"] == 0 and silent[75]["n_long"] == 44 and silent[75]["is_anomaly"]
    with pytest.raises(ValueError):
        L.stream_rate_alerts(spark.createDataFrame([], ddl), 10, 65, tick=10)


MESSAGE = ("family_id string, person_id string, member_type string, gender string, ts timestamp, has_snp boolean, kind string, "
           "total_members int, num_children int, snps_per_member struct<father:int,mother:int,children:array<int>>")


def person(family, who, member, start, n):
    return [(family, f"{family}-{who}", member, "x", sec(start + i), True, "snp", None, None, None) for i in range(n)]


def token(family, at, members, children, snps):
    return (family, None, None, None, sec(at), False, "token", members, children, snps)


def test_completion_equals_batch(spark):
    whole = (person("A", 1, "father", 0, 5) + person("A", 2, "mother", 5, 4) + person("A", 3, "child", 9, 3)
             + person("A", 4, "child", 12, 2))
    short = person("B", 1, "father", 3, 5) + person("B", 2, "mother", 8, 5)
    untold = person("D", 1, "father", 20, 3)
    tokens = [token("A", 15, 4, 2, (5, 4, [3, 2])), token("B", 16, 3, 1, (5, 5, [6])), token("C", 18, 2, 0, (1, 1, [])),
              token("A", 17, 4, 2, (5, 4, [3, 2])), token("E", 19, 2, 0, None)]
    rows = whole + short + untold
    random.Random(5).shuffle(rows)
    end = person("Z", 1, "father", 20_000, 1) + [token("Z", 20_000, 1, 0, (1, 0, []))]
    # a later clock, by when tokens without rows are given out; then a late token
    parts = [rows[:12] + tokens[:2], rows[12:] + tokens[2:], end, [token("D", 25, 1, 0, (3, 0, []))]]
    root = tempfile.mkdtemp(prefix="allelic-tokens-")
    got = feed(spark, root, MESSAGE, parts, lambda s: L.stream_check_tokens(s, quiet=30, wait=60, watermark="1 minute"))
    everything = spark.createDataFrame(rows + tokens, MESSAGE)
    ref = FAM.check_tokens(everything.filter("kind = 'token'").dropDuplicates(["family_id"]), everything)
    cols = ["family_id", "stated_members", "stated_children", "stated_snps", "total_members", "num_children", "total_snps", "agrees"]

    def plain(df):
        return sorted(map(tuple, df.select(*cols).collect()), key=str)
    assert plain(got) == plain(ref)
    assert {r["family_id"]: r["agrees"] for r in got.collect()} == {"A": True, "B": False, "C": False, "E": False}
