"""Rates, trends, anomalies and metric histories.

Trailing counts ``n(t - w, t]`` are computed without bounded window
frames: Spark re-aggregates a sliding frame's whole buffer for every row,
which costs O(rows x frame size) and collapses when a frame holds millions
of events.  ``rate_series`` takes differences of prefix counts instead.  With
P(x) the number of events at or before x, ``n(t - w, t] = P(t) - P(t - w)``:

1. pre-aggregate to one row per (group, timestamp), which collapses hot
   timestamps before any shuffle;
2. every timestamp asks for P at t and at t - w for each width w; time is cut
   into cells of ``CELL_SECONDS``, whatever the widths;
3. P(x) = events in earlier cells (a prefix sum over one row per cell) +
   events up to x in x's own cell (a running sum inside the cell);
4. a group-by on (group, timestamp) puts the answers side by side.

A task holds cells, never a whole window, so a wide window with most of the
rows is as parallel as its cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelic.functions.genotype import trend_direction
from allelic.operators.firsts import first_rows, sortable
from allelic.operators.metrics import epoch_us, row_order
from allelic.operators.ranks import numbered_rows
from allelic.operators.topk import top_k

US = 1_000_000
#: Width of the time cells of the prefix counts, in seconds.
CELL_SECONDS = 60
#: Rows of a chunk of a numbered series.
CHUNK = 10_000


def rate_series(df: DataFrame, seconds: Sequence[int] = (60, 30, 10), *,
                by: Sequence[str] = (), ts: str = "ts", valid_only: bool = True) -> DataFrame:
    """For every distinct event time t (per group): ``n_{w}s`` = events with
    ``t - w < ts <= t`` (strict on the left, as ``now - ts < w``) and
    ``rate_{w}s = n / w`` for each width ``w`` in seconds."""
    by = list(by)
    seconds = list(dict.fromkeys(seconds))
    if not seconds or any(int(s) != s or s <= 0 for s in seconds):
        raise ValueError(f"window widths must be positive whole seconds, got {seconds}")
    seconds = [int(s) for s in seconds]
    src = df.filter(F.col("has_snp")) if valid_only else df
    per_ts = (src.groupBy(*by, F.col(ts).alias("ts"))
              .agg(F.count(F.lit(1)).alias("n_at"))
              .withColumn("_us", epoch_us("ts")))
    asks = F.array(*[F.struct(F.lit(i).alias("wid"), (F.col("_us") - s * US).alias("x"))
                     for i, s in enumerate([0, *seconds])])
    x = (per_ts.select(*by, "ts", "n_at", F.explode(asks).alias("_a"))
         .select(*by, "ts", "n_at", "_a.*", F.floor(F.col("_a.x") / (CELL_SECONDS * US)).alias("cell"),
                 F.when(F.col("_a.wid") == 0, F.col("n_at")).otherwise(F.lit(0)).alias("_n")))
    cells = x.groupBy(*by, "cell").agg(F.sum("_n").alias("_cell_n"))
    earlier = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("cell")
    cells = cells.select(*[F.col(k).alias(f"_c_{i}") for i, k in enumerate(by)], F.col("cell").alias("_c"),
                         F.coalesce(F.sum("_cell_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)),
                                    F.lit(0)).alias("_before"))
    on = [F.col(k).eqNullSafe(F.col(f"_c_{i}")) for i, k in enumerate(by)] + [F.col("cell") == F.col("_c")]
    # the event at x itself counts for P(x): it comes before the questions
    run = (Window.partitionBy(*by, "cell").orderBy("x", "wid")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = x.withColumn("_run", F.sum("_n").over(run)).join(cells, on, "inner").select(
        *by, "ts", "n_at", "wid", (F.col("_before") + F.col("_run")).alias("p"))

    def at(i):
        return F.max(F.when(F.col("wid") == i, F.col("p")))
    wide = counted.groupBy(*by, "ts").agg(
        F.max("n_at").alias("n_at"), *[(at(0) - at(i)).alias(f"n_{s}s") for i, s in enumerate(seconds, 1)])
    return wide.select(*by, "ts", "n_at", *[F.col(f"n_{s}s").cast("long").alias(f"n_{s}s") for s in seconds],
                       *[(F.col(f"n_{s}s").cast("double") / float(s)).alias(f"rate_{s}s") for s in seconds])


def mutation_rate(df: DataFrame, seconds: int = 60, *, by: Sequence[str] = (),
                  ts: str = "ts") -> DataFrame:
    """Trailing event rate (events per second over the last
    ``seconds``), evaluated at every distinct event time."""
    s = rate_series(df, (seconds,), by=by, ts=ts)
    return s.select(*by, "ts", "n_at", F.col(f"n_{seconds}s").alias("n_window"),
                    F.round(F.col(f"rate_{seconds}s"), 4).alias("mutation_rate"))


def rate_history(rates: DataFrame, n: int = 60, *, by: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` computed rates (newest first)."""
    return top_k(rates, [F.desc("ts")], n, by=list(by) or None)


def mutation_rate_history(df: DataFrame, seconds: int = 60, n: int = 60, *, ts: str = "ts") -> DataFrame:
    """The rates at the ``n`` newest event times.  Only events that one of
    their windows reaches are counted: the oldest of the newest times is a
    scalar subquery over the time column."""
    src = df.filter(F.col("has_snp") & F.col(ts).isNotNull())
    newest = src.select(ts).distinct().orderBy(F.desc(ts)).limit(n)
    oldest = newest.select(F.min(epoch_us(ts))).scalar()
    tail = src.filter(epoch_us(ts) > oldest - seconds * US)
    return rate_history(mutation_rate(tail, seconds, ts=ts), n)


def rate_trend(df: DataFrame, short: int = 30, long: int = 60, *,
               by: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """At each event time the ``short`` rate against the ``long`` rate
    recorded at that event: change in percent (0 when the long rate is 0),
    and its direction (P15)."""
    s = rate_series(df, (long, short), by=by, ts=ts)
    rl, rs = F.col(f"rate_{long}s"), F.col(f"rate_{short}s")
    change = F.when(rl > 0, F.round((rs - rl) / rl * 100.0, 2)).otherwise(F.lit(0.0))
    return s.select(*by, "ts", F.round(rs, 4).alias("current_rate"),
                    F.round(rl, 4).alias("previous_rate"), change.alias("change_pct"),
                    trend_direction(change).alias("direction"))


def rate_anomaly(df: DataFrame, short: int = 10, long: int = 60, threshold: float = 2.5, *,
                 by: Sequence[str] = (), ts: str = "ts", keep_n_at: bool = False) -> DataFrame:
    """Current (``short``) rate against expected (``long``) rate.

    Anomaly when ``|current - expected| / expected > threshold``; severity
    ``high`` above twice the threshold, else ``medium``; ``normal`` when not
    anomalous or expected = 0.  Compared exactly on the integer counts:
    ``|n_s * long - n_l * short| > threshold * n_l * short``.
    """
    s = rate_series(df, (long, short), by=by, ts=ts)
    return s.select(*by, "ts", *(["n_at"] if keep_n_at else []),
                    *anomaly_columns(F.col(f"n_{short}s"), F.col(f"n_{long}s"), short, long, threshold))


def anomaly_columns(ns: Column, nl: Column, short: int, long: int, threshold: float) -> list[Column]:
    """The columns of W5 from the counts of the short and the long window."""
    lhs = F.abs(ns * long - nl * short).cast("double")
    rhs = (nl * short).cast("double") * float(threshold)
    anomalous = (nl > 0) & (lhs > rhs)
    expected, current = nl.cast("double") / float(long), ns.cast("double") / float(short)
    return [ns.alias("n_short"), nl.alias("n_long"), F.round(expected, 4).alias("expected_rate"),
            F.round(current, 4).alias("current_rate"), F.round(current - expected, 4).alias("deviation"),
            anomalous.alias("is_anomaly"),
            F.when(~anomalous, "normal").when(lhs > rhs * 2, "high").otherwise("medium").alias("severity")]


def anomaly_rate(df: DataFrame, short: int = 10, long: int = 60, threshold: float = 2.5, *,
                 ts: str = "ts") -> DataFrame:
    """Anomalies / (variants + 1) x 100 (2 dp), one row.  One
    aggregation over the anomaly series: its ``n_at`` column sums to the
    number of variants, so no second pass over the input is needed."""
    a = rate_anomaly(df, short, long, threshold, ts=ts, keep_n_at=True).agg(
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.coalesce(F.sum("n_at"), F.lit(0)).cast("long").alias("total_variants"))
    return a.select("anomaly_count", "total_variants",
                    F.round(F.col("anomaly_count").cast("double")
                            / (F.col("total_variants") + 1).cast("double") * 100.0, 2).alias("anomaly_rate"))


def zscore_anomaly(series: DataFrame, value: str, order: str, *, by: Sequence[str] = (),
                   k: float = 3.0, history: int = 50) -> DataFrame:
    """Flag values more than ``k`` sample standard deviations from the
    mean of the previous ``history`` points of the same group (k = 3 in the
    report, 2.5 in the README).

    The series is numbered and cut into chunks of ``CHUNK`` points; the last
    ``history`` points of a chunk also go to the next one, so a long series
    of one group is many tasks."""
    by = list(by)
    chunk = max(CHUNK, history)
    own = F.floor(F.col("_seq") / chunk)
    goes_on = F.col("_seq") % chunk >= chunk - history
    x = (sequence(series, by, order, name="_seq").withColumn("_own", own)
         .withColumn("_chunk", F.explode(F.when(goes_on, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own")))))
    w = Window.partitionBy(*by, "_chunk").orderBy("_seq").rowsBetween(-history, -1)
    x = x.select("*", F.avg(value).over(w).alias("_mean"), F.stddev_samp(value).over(w).alias("_std"))
    return x.filter(F.col("_own") == F.col("_chunk")).select(
        *series.columns, F.round("_mean", 6).alias("hist_mean"), F.round("_std", 6).alias("hist_std"),
        F.coalesce(F.abs(F.col(value) - F.col("_mean")) > F.lit(k) * F.col("_std"), F.lit(False)).alias("is_anomaly"))


# --- histories over per-batch metric rows (W3, W7, W8, W9, W11) ---------------------
def last_n(df: DataFrame, n: int, order: str, *, by: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` rows by ``order`` (per group)."""
    return top_k(df, [F.desc(order)], n, by=list(by) or None)


def _columns(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def sequence(df: DataFrame, by: Sequence[str], order: str | Sequence[str], *, name: str = "seq") -> DataFrame:
    """0-based sequence number per group in ``order`` (NULL first; ties by
    the other columns, so every row has its own number).  Sorts the rows into
    ranges and stores them (see ``numbered_rows``)."""
    return numbered_rows(df, by, _columns(order)).withColumnRenamed("_i", name).drop("_n")


def downsample(df: DataFrame, limit: int, order: str | Sequence[str], *, by: Sequence[str] = ()) -> DataFrame:
    """When a group has more than ``limit`` rows keep every
    ``ceil(n/limit)``-th row (from the first), then the last ``limit``.  Rows
    are counted one by one, also those with equal or NULL order values."""
    r = numbered_rows(df, by, _columns(order))
    step = F.greatest(F.ceil(F.col("_n") / F.lit(limit)), F.lit(1))
    kept = r.filter((F.col("_n") <= limit) | ((F.col("_i") % step) == 0))
    return top_k(kept, [F.desc("_i")], limit, by=list(by) or None).drop("_i", "_n")


def latest_by_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str | None = None) -> DataFrame:
    """Last write wins per key; equal times by ``tiebreak``, then by the
    other columns (the larger wins).  The latest time per key is a hash
    aggregate; only rows that reach it are ranked (see ``first_rows``).  Keys
    whose times are all NULL keep one row."""
    keys = list(keys)
    first = [F.desc_nulls_last(tiebreak)] if tiebreak else []
    rest = [F.desc_nulls_last(c) for c in sortable(df, [*keys, ts, *([tiebreak] if tiebreak else [])])]
    return first_rows(df, keys, [ts], largest=True, ties=first + rest).select(*keys, *[c for c in df.columns if c not in keys])


def first_per_batch(df: DataFrame, batch_col: str, order: str = "snp_id") -> DataFrame:
    """The first valid row of each batch by ``order``, rows without it
    by time and content (the reference took an arbitrary ``first()``)."""
    leads = [c for c in dict.fromkeys((order, "ts")) if c in df.columns]
    out = first_rows(df, [batch_col], leads, ties=[F.asc(row_order(df, order))])
    return out.select(batch_col, *[c for c in df.columns if c != batch_col])
