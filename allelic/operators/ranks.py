"""Exact, distributed ranks of values within groups.

``rank_index`` gives every distinct value of a column (per group) the
0-based index range it occupies in the group's sorted value list.  It is
the building block of the ECDF, exact quantiles and box plots.

Plan (no task ever holds more than one value bin of one group):

1. hash-aggregate to distinct (group, value) with multiplicity ``n_at``
   (a hot value collapses to one row before the shuffle);
2. per (group, bin) totals, and a prefix sum over the bins of each group (a
   few thousand rows at most).  Bins have a given width, or lie between
   approximate quantiles of the column, so that they stay even when the
   values are not;
3. inside each (group, bin) partition a running sum over the sorted
   distinct values gives the offset within the bin.

``first_idx = rows in earlier bins + rows before this value in its bin``.
Ranks are exact whatever the bins.  Nothing runs while the plan is built; the
two branches over the distinct values share their exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelic.session import checkpoint_dir

#: Default bins: parts of equal width between this many approximate quantiles.
QUANTILES, PARTS = 32, 128


def _on(keys: list[str], left: DataFrame, right: DataFrame) -> list[Column]:
    return [left[k].eqNullSafe(right[k]) for k in keys]


def with_quantile_bin(df: DataFrame, x: Column, values: DataFrame, name: str = "_bin") -> DataFrame:
    """``df`` with the bin number of ``x``, not falling as x grows: ``PARTS``
    parts of equal width between each two of ``QUANTILES`` approximate
    quantiles of the one column of ``values`` (a scalar subquery), so that
    bins stay even under outliers.  NULL has no bin."""
    col = values.columns[0]
    edges = values.select(F.percentile_approx(col, [i / QUANTILES for i in range(QUANTILES + 1)], 10_000)).scalar()
    inner = F.slice("_edges", 2, QUANTILES - 1)
    df = df.withColumns({"_edges": edges, "_x": x})
    df = df.withColumn("_coarse", F.size(F.filter(inner, lambda e: e <= F.col("_x"))))
    df = df.withColumns({"_lo": F.get("_edges", F.col("_coarse")), "_hi": F.get("_edges", F.col("_coarse") + 1)})
    part = F.when(F.col("_hi") > F.col("_lo"), F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * PARTS)).otherwise(0)
    number = F.col("_coarse") * PARTS + F.least(F.greatest(part, F.lit(0)), F.lit(PARTS - 1))
    return (df.withColumn(name, F.when(F.col("_x").isNotNull(), number.cast("long")))
            .drop("_edges", "_x", "_coarse", "_lo", "_hi"))


def rank_index(df: DataFrame, col: str, by: Sequence[str] = (), *,
               bin_width: float | None = None) -> DataFrame:
    """Columns: by..., value, n_at, first_idx, last_idx, n (group size).

    ``bin_width`` splits the value axis (e.g. 1,000,000 bases for genome
    positions); when None the bins lie between approximate quantiles (see
    ``with_quantile_bin``).
    """
    keys = list(by)
    v = df.filter(F.col(col).isNotNull())
    d = v.groupBy(*keys, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n_at"))
    if bin_width is not None:
        d = d.withColumn("_bin", F.floor(F.col("value") / F.lit(float(bin_width))).cast("long"))
    else:
        d = with_quantile_bin(d, F.col("value").cast("double"), v.select(F.col(col).cast("double").alias("x")))
    tot = d.groupBy(*keys, "_bin").agg(F.sum("n_at").alias("_bin_n"))
    grp = Window.partitionBy(*keys) if keys else Window.partitionBy()
    tot = tot.select(
        *keys, "_bin",
        F.coalesce(F.sum("_bin_n").over(grp.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_before_bin"),
        F.sum("_bin_n").over(grp).alias("n"))
    # one row per (group, bin): AQE broadcasts it from its measured size
    j = d.join(tot.withColumnRenamed("_bin", "_tbin"),
               _on(keys, d, tot) + [d["_bin"].eqNullSafe(F.col("_tbin"))], "inner")
    in_bin = Window.partitionBy(*[d[k] for k in keys], d["_bin"]).orderBy("value")
    before = F.coalesce(F.sum("n_at").over(in_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = (F.col("_before_bin") + before).cast("long")
    return j.select(*[d[k] for k in keys], "value", "n_at", first.alias("first_idx"),
                    (first + F.col("n_at") - 1).cast("long").alias("last_idx"),
                    F.col("n").cast("long").alias("n"))



#: monotonically_increasing_id is the partition number above this many bits of the row's place in it.
_PLACE_BITS = 33


def range_sorted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` sorted by ``columns`` (NULL first) over ranges, with ``_range``
    (number of the range) and ``_at`` (place of the row in it), stored.

    The ranges lie between sampled rows, compared by all ``columns`` and, among
    rows that agree in those, by a row id, so a hot value or a run of repeated
    rows is cut like any other.  Two readers of a range sort may cut it
    differently, so the sorted rows are written to the shared checkpoint
    folder once; this runs when the operator is called.
    """
    checkpoint_dir(df.sparkSession)
    order = [*[F.asc_nulls_first(c) for c in columns], F.col("_row")]
    rows = (df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order)
            .sortWithinPartitions(*order).drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    return (rows.withColumn("_range", F.shiftright("_at", _PLACE_BITS).cast("int"))
            .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).checkpoint())


def numbered_rows(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` + ``_i`` (0-based position of the row in its group) and ``_n``
    (group size).  Rows are ordered by all ``order`` columns, NULL first, and
    among equal ones by their other columns, so every row has a position of
    its own.

    A row's number is its place in its range, plus the group's rows in earlier
    ranges: a prefix sum over one row per range and group.  No task holds a
    group, whatever the type of the order column and however hot its values.
    """
    keys, order = list(by), [c for c in order if c not in by]
    rest = [c for c, t in df.dtypes if c not in keys and c not in order and not t.startswith(("map", "variant"))]
    rows = range_sorted(df, [*keys, *order, *rest])
    group = Window.partitionBy(*keys) if keys else Window.partitionBy()
    here = rows.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_here"), F.min("_at").alias("_first"))
    earlier = F.sum("_here").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    here = here.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], F.col("_range").alias("_of"),
                       (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_here").over(group).alias("_n"))
    on = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)] + [F.col("_range") == F.col("_of")]
    return rows.join(here, on, "inner").select(
        *df.columns, (F.col("_at") + F.col("_shift")).cast("long").alias("_i"), F.col("_n").cast("long").alias("_n"))
