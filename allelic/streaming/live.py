"""Live checks on a stream: rate alerts (W4, W5) and finished families.

Both are chains of native stateful operators in append mode: a row leaves
once the watermark says that it is final, so results do not depend on how the
messages fall into micro-batches, on restarts or on replays.  Late rows are
dropped by Spark's watermark.  Write them with ``runner.archive`` (the file
sink commits each batch once) or any append sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import trend_direction
from allelic.operators.family import stated_tokens, tokens_agree
from allelic.operators.timeseries import anomaly_columns
from allelic.streaming.stateful import DEFAULT_WATERMARK


def stream_rate_alerts(snps: DataFrame, short: int = 10, long: int = 60, threshold: float = 2.5, *,
                       by: Sequence[str] = (), tick: int = 1, quiet_ticks: bool = False,
                       watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """The ``short`` rate against the ``long`` rate, live: the columns of
    ``rate_anomaly`` plus ``n_at``, ``change_pct`` and ``direction`` (W4), a row
    per ``tick`` seconds with SNPs; ``ts`` is the tick's start.

    SNPs are counted per tick, which leaves few rows whatever the load, and a
    tick's count goes to the long / tick windows that end at or after it.  With
    event times in whole ticks the rows equal ``rate_anomaly`` on the same
    SNPs; finer times are judged at the end of their tick.  ``quiet_ticks``
    adds the ticks without SNPs whose long window holds some, so that a stream
    that falls silent is reported too.  State is ticks and windows per ``by``
    within the watermark.
    """
    if any(int(s) != s or s <= 0 for s in (short, long, tick)) or short % tick or long % tick or short > long:
        raise ValueError(f"widths must be positive multiples of the tick, short within long: {short}, {long}, {tick}")
    counts = (snps.filter(F.col("has_snp")).withWatermark("ts", watermark)
              .groupBy(*by, F.window("ts", f"{tick} seconds").alias("tick"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select(*by, F.col("tick.start").alias("at"), F.window_time("tick").alias("closes"), "n"))
    w = F.window("closes", f"{long} seconds", f"{tick} seconds").alias("long")
    before_end = (F.col("long.end").cast("long") - F.col("at").cast("long"))
    windows = counts.select(*by, "at", "n", w).withColumn("age", before_end)
    sums = windows.groupBy(*by, "long").agg(
        F.sum("n").alias("nl"), F.sum(F.when(F.col("age") <= short, F.col("n")).otherwise(0)).alias("ns"),
        F.sum(F.when(F.col("age") <= tick, F.col("n")).otherwise(0)).alias("n_at"))
    if not quiet_ticks:
        sums = sums.filter(F.col("n_at") > 0)
    rl, rs = F.col("nl") / float(long), F.col("ns") / float(short)
    change = F.when(rl > 0, F.round((rs - rl) / rl * 100.0, 2)).otherwise(F.lit(0.0))
    return sums.select(*by, (F.col("long.end") - F.expr(f"INTERVAL {tick} SECONDS")).alias("ts"), "n_at",
                       *anomaly_columns(F.col("ns"), F.col("nl"), short, long, threshold),
                       change.alias("change_pct"), trend_direction(change).alias("direction"))


def stream_check_tokens(messages: DataFrame, *, quiet: int = 120, wait: int = 600,
                        watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Completion tokens against the family's rows, live: the columns of
    ``check_tokens`` and the token's ``ts``.

    Persons' SNPs are counted per session (no row for ``quiet`` seconds), persons per
    session of their family, and a token meets the session that ends within
    ``wait`` seconds of it.  A token without rows is given out with counts of 0 once
    the watermark is ``wait`` past it; a second token of a family within the
    watermark is dropped.  A family whose rows pause for longer than ``quiet``
    has a session, and a row here, for each part.
    """
    known = F.col("person_id").isNotNull() & F.col("family_id").isNotNull()
    rows = messages.filter(F.col("has_snp") & known).withWatermark("ts", watermark)
    persons = (rows.groupBy("family_id", "person_id", "member_type", "gender", F.session_window("ts", f"{quiet} seconds").alias("s"))
               .agg(F.count(F.lit(1)).alias("snps"))
               .select("family_id", "member_type", "snps", F.window_time("s").alias("ended")))
    families = (persons.groupBy(F.col("family_id").alias("_f"), F.session_window("ended", f"{quiet} seconds").alias("s"))
                .agg(F.count(F.lit(1)).alias("total_members"), F.count_if(F.col("member_type") == "child").alias("num_children"),
                     F.sum("snps").alias("total_snps"))
                .select("_f", "total_members", "num_children", "total_snps", F.window_time("s").alias("closed")))
    tokens = (messages.filter(F.col("kind") == "token").withWatermark("ts", watermark)
              .dropDuplicatesWithinWatermark(["family_id"]))
    stated = stated_tokens(tokens, "ts")
    # a session's window closes ``quiet`` after its last person's, that one ``quiet`` after its last row
    near = ((F.col("family_id") == F.col("_f")) & (F.col("closed") >= F.col("ts") - F.expr(f"INTERVAL {wait} SECONDS"))
            & (F.col("closed") <= F.col("ts") + F.expr(f"INTERVAL {wait + 2 * quiet} SECONDS")))
    x = stated.join(families, near, "left").drop("_f", "closed")
    return tokens_agree(x)
