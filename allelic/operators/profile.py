"""Genome profiling and comparison.

A "genome" is any grouping column of the SNP view (``person_id`` for one
person's genome, ``member_type`` for a population).  Statistics that need a
global value (histogram range, totals) take it from a scalar subquery or a
group-level aggregate, never from a cross join or a driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.operators.metrics import with_group_total
from allelic.operators.ranks import rank_index
from allelic.operators.topk import top_k


def _genomes(df: DataFrame) -> DataFrame:
    return df.filter(F.col("has_snp")) if "has_snp" in df.columns else df


# --- A23 / A24 / A33 --------------------------------------------------------------
def value_profile(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Normalised value frequency (NULLs excluded): value, count, share."""
    by = list(by)
    counts = (_genomes(df).filter(F.col(col).isNotNull())
              .groupBy(*by, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count")))
    # group totals without a window over all distinct values of a group:
    # a scalar subquery (one group) or a per-group total joined back
    if not by:
        total = counts.select(F.sum("count")).scalar()
        out = counts.withColumn("_total", total)
    else:
        tot = counts.groupBy(*by).agg(F.sum("count").alias("_total"))
        tot = tot.select(*[F.col(k).alias(f"_t_{i}") for i, k in enumerate(by)], "_total")
        out = counts.join(tot, [F.col(k).eqNullSafe(F.col(f"_t_{i}")) for i, k in enumerate(by)], "inner")
    return out.select(*by, "value", "count",
                      F.round(F.col("count").cast("double") / F.col("_total").cast("double"), 6).alias("share"))


def value_counts_by(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Value counts of ``col`` per genome (NULL kept as its own key)."""
    return _genomes(df).groupBy(*by, col).agg(F.count(F.lit(1)).alias("count"))


# --- A25 / A26 --------------------------------------------------------------------
def position_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per chromosome: n, min, max, mean and sample std of the position;
    the std of a single row (undefined) becomes 1,000,000."""
    by = list(by)
    v = _genomes(df).filter(F.col("chromosome").isNotNull() & F.col("position").isNotNull())
    return v.groupBy(*by, "chromosome").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("position").alias("min_position"),
        F.max("position").alias("max_position"),
        F.round(F.avg("position"), 4).alias("mean_position"),
        F.round(F.coalesce(F.stddev_samp("position"), F.lit(1e6)), 4).alias("std_position"))


def compare_moments(df: DataFrame, genome: str) -> DataFrame:
    """Mean, sample std and population std of position per genome."""
    v = _genomes(df).filter(F.col("position").isNotNull())
    return v.groupBy(genome).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("position"), 4).alias("mean_position"),
        F.round(F.stddev_samp("position"), 4).alias("std_sample"),
        F.round(F.stddev_pop("position"), 4).alias("std_population"))


# --- A27 / A28 --------------------------------------------------------------------
def compare_chromosomes(df: DataFrame, genome: str, genomes: Sequence[str]) -> DataFrame:
    """Percent of each genome's SNPs per chromosome, one column per
    genome (the genome list is passed, which saves a distinct job)."""
    v = _genomes(df).filter(F.col("chromosome").isNotNull())
    long = v.groupBy(genome, "chromosome").agg(F.count(F.lit(1)).alias("count"))
    long = with_group_total(long, [genome], "_total").select(
        genome, "chromosome", F.round(F.lit(100.0) * F.col("count") / F.col("_total"), 4).alias("pct"))
    return long.groupBy("chromosome").pivot(genome, list(genomes)).agg(F.first("pct"))


def compare_genotypes(df: DataFrame, genome: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent genotypes of each genome with their
    percent share (ties by genotype)."""
    v = _genomes(df).filter(F.col("genotype").isNotNull())
    counts = v.groupBy(genome, "genotype").agg(F.count(F.lit(1)).alias("count"))
    counts = with_group_total(counts, [genome], "_total").select(
        genome, "genotype", "count", F.round(F.lit(100.0) * F.col("count") / F.col("_total"), 4).alias("pct"))
    return top_k(counts, [F.desc("count"), F.asc("genotype")], k, by=[genome], rank_col="rank")


# --- A29 --------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 50, density: bool = False) -> DataFrame:
    """Equal-width histogram between the column's min and max (the last bin
    is closed).  Bin = least(floor((x - lo) * bins / (hi - lo)), bins - 1).
    All ``bins`` bins are returned, empty ones with count 0.  When min =
    max the range is (min - 0.5, min + 0.5), as numpy does.

    Two scans of the one column: its range and number (one scalar subquery),
    then the bin counts, of which each task sends ``bins`` rows at most."""
    vals = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("_x"))
    x = F.col("_x")
    span = vals.select(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"))).scalar()
    lo0, hi0, n = span["lo"], span["hi"], span["n"]
    lo = F.when(lo0 == hi0, lo0 - 0.5).otherwise(lo0)
    hi = F.when(lo0 == hi0, hi0 + 0.5).otherwise(hi0)
    idx = F.least(F.floor((x - lo) * F.lit(float(bins)) / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = vals.select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    # the bin index domain is a parameter (bins rows), not data
    domain = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    out = (domain.join(counts, "bin", "left")
           .select("bin", (lo + F.col("bin") * width).alias("bin_lo"),
                   (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
                   F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))
    out = out.withColumn("bin_lo", F.round("bin_lo", 4)).withColumn("bin_hi", F.round("bin_hi", 4))
    if density:
        out = out.withColumn("density", F.col("count").cast("double") / (n.cast("double") * width))
    return out


# --- A30 / A31 --------------------------------------------------------------------
def null_counts(df: DataFrame) -> DataFrame:
    """Number of NULLs in every column (one row)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def table_shape(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and columns per genome."""
    ncols = len(df.columns)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.lit(ncols).alias("columns"))


# --- A32 --------------------------------------------------------------------------
def _interpolated(index: DataFrame, keys: list[str], ps: Sequence[float], h_of) -> DataFrame:
    """(keys, p, value): linear interpolation between the ranks around
    h = h_of(p, n) in each group's sorted values.

    Every index row carries its group size ``n``, so it can test itself
    against the two target ranks of each p: one projection over the index
    (exploded by the short p list) and one small aggregation, no join."""
    x = index.select(*keys, "value", "first_idx", "last_idx", "n",
                     F.explode(F.array(*[F.lit(float(p)) for p in ps])).alias("p"))
    n = F.col("n")
    h = h_of(F.col("p"), n)
    j = F.least(F.greatest(F.floor(h), F.lit(0)), n - 1).cast("long")
    j1 = F.least(j + 1, n - 1)
    f = F.when((h <= 0) | (j >= n - 1), F.lit(0.0)).otherwise(h - j)
    lo, hi = F.col("first_idx"), F.col("last_idx")
    hit0 = (j >= lo) & (j <= hi)
    hit1 = (j1 >= lo) & (j1 <= hi)
    x = x.filter(hit0 | hit1).select(*keys, "p", f.alias("f"), F.when(hit0, F.col("value")).alias("v0"),
                                     F.when(hit1, F.col("value")).alias("v1"))
    res = x.groupBy(*keys, "p").agg(F.max("f").alias("f"), F.max("v0").alias("v0"), F.max("v1").alias("v1"))
    v0, v1 = F.col("v0").cast("double"), F.col("v1").cast("double")
    return res.select(*keys, "p", (v0 + F.col("f") * (v1 - v0)).alias("value"))


def boxplot_stats(df: DataFrame, col: str, by: Sequence[str] = (), *,
                  bin_width: float | None = None) -> DataFrame:
    """matplotlib's default box plot: quartiles with linear
    interpolation at h = (n - 1) p (numpy's default), whiskers at the most
    extreme values inside 1.5 IQR of the box, and the count of outliers.

    Exact and distributed: ranks come from :func:`rank_index`, and the
    whiskers are aggregated over distinct values, never over a whole group
    held in one task.  ``bin_width`` (value units) sizes the rank index's
    bins; by default they lie between approximate quantiles."""
    keys = list(by)
    idx = rank_index(df, col, keys, bin_width=bin_width)
    q = _interpolated(idx, keys, (0.25, 0.5, 0.75), lambda p, n: (n - 1).cast("double") * p)
    stats = q.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
                                   for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    if keys:
        # one stats row per group against the distinct-value index
        st = stats.select(*[F.col(k).alias(f"_st_{i}") for i, k in enumerate(keys)], "q1", "median", "q3")
        j = idx.join(st, [F.col(k).eqNullSafe(F.col(f"_st_{i}")) for i, k in enumerate(keys)], "inner")
    else:
        # a single group: its quartiles arrive as one scalar subquery
        row = stats.select(F.struct("q1", "median", "q3")).scalar()
        j = idx.select("*", row["q1"].alias("q1"), row["median"].alias("median"), row["q3"].alias("q3"))
    j = (j.withColumn("iqr", F.col("q3") - F.col("q1"))
         .withColumn("_lof", F.col("q1") - 1.5 * F.col("iqr"))
         .withColumn("_hif", F.col("q3") + 1.5 * F.col("iqr")))
    x = F.col("value").cast("double")
    inside = (x >= F.col("_lof")) & (x <= F.col("_hif"))
    agg = j.groupBy(*keys, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, x)).alias("whisker_lo"),
        F.max(F.when(inside, x)).alias("whisker_hi"),
        F.coalesce(F.sum(F.when(~inside, F.col("n_at"))), F.lit(0)).cast("long").alias("outliers"),
        F.sum("n_at").cast("long").alias("n"))
    return agg.select(*keys, *[F.round(c, 4).alias(c) for c in
                               ("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")],
                      "outliers", "n")


# --- A34 --------------------------------------------------------------------------
def distinct_positions(df: DataFrame) -> DataFrame:
    """One row per distinct (chromosome, position)."""
    return df.select("chromosome", "position").dropDuplicates(["chromosome", "position"])


# --- W12 / W13 --------------------------------------------------------------------
POSITION_BIN = 1_000_000


def _position_index(df: DataFrame, by: list[str]) -> DataFrame:
    """Distinct positions per (by, chromosome) with the index range they
    occupy in the sorted position list (see :func:`rank_index`: windows run
    per 1 Mb bin, never over a whole chromosome)."""
    v = _genomes(df).filter(F.col("chromosome").isNotNull())
    idx = rank_index(v, "position", by + ["chromosome"], bin_width=POSITION_BIN)
    return idx.withColumnRenamed("value", "position")


def position_ecdf(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Empirical CDF knots i/n over the sorted positions of each
    chromosome, i from 0.  Reported per distinct position: ``ecdf`` is the
    value at its first occurrence, ``n_at`` how many knots it spans (the
    knots of a repeated position are ecdf, ecdf + 1/n, ...)."""
    idx = _position_index(df, list(by))
    return idx.select(*by, "chromosome", "position", "n_at", "n",
                      (F.col("first_idx").cast("double") / F.col("n")).alias("ecdf"))


def position_quantile(df: DataFrame, quantiles: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Inverse of the ECDF at each ``u``: linear between the knots
    (i/n, pos_i), the first position for u <= 0 and the last beyond
    (n-1)/n.  With j = floor(u n) and f = u n - j the value is
    pos_j + f (pos_{j+1} - pos_j)."""
    keys = list(by) + ["chromosome"]
    idx = _position_index(df, list(by)).withColumnRenamed("position", "value")
    res = _interpolated(idx, keys, quantiles, lambda p, n: p * n.cast("double"))
    return res.select(*keys, F.col("p").alias("u"), F.round("value", 4).alias("position"))
