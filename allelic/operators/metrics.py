"""Batch-or-stream metric aggregates over the flattened SNP view.

Input columns (FIXTURES section 3): snp_id, ts, family_id, member_type,
person_id, gender, has_snp, chromosome, position, genotype, gt_num.

Every function is lazy (no action), groups with hash aggregation and its
map-side partial combine, and only applies window functions to already
aggregated rows whose count is bounded by the number of groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import (
    bucket, classify_genotype, default_genotype, genotype_orientation, is_het, normalize_chromosome, pct, ratio,
)
from allelic.operators.firsts import first_rows, renamed, same_keys
from allelic.operators.genes import annotate_gene

MEMBER = "member_type"


def _valid(df: DataFrame) -> DataFrame:
    """Rows that carry SNP data."""
    return df.filter(F.col("has_snp"))


def epoch_us(ts: str | Column = "ts") -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column
    (the session time zone is UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def row_order(df: DataFrame, first: str = "snp_id") -> Column:
    """A sort key that is never NULL: ``first`` (NULL last), then event time
    and the rest of the message, for rows that came without an id."""
    names = [c for c in (first, "ts", "family_id", MEMBER, "person_id", "chromosome", "position", "genotype")
             if c in df.columns]
    return F.struct(*[x for i, c in enumerate(dict.fromkeys(names))
                      for x in (F.col(c).isNull().alias(f"none_{i}"), F.col(c).alias(f"key_{i}"))])


# --- A1 ---------------------------------------------------------------------
def batch_metrics(df: DataFrame, batch_col: str | None = None, *, with_sample: bool = False) -> DataFrame:
    """Per member (and batch): valid SNP records, messages, tokens, last ts.

    ``with_sample`` adds the batch's sample genetic record (the reference
    sent one with every batch): the valid SNP with the smallest ``snp_id``
    (deterministic, where the reference took an arbitrary ``first()``),
    with its default-filled genotype and its gene.  Messages without an id
    are ordered by their content (see ``row_order``).  A hash aggregate gives
    the smallest id of each batch; only rows that reach it are ranked (see
    ``first_rows``), and only the few sample rows are annotated."""
    keys = [MEMBER] + ([batch_col] if batch_col else [])
    aggs = [F.count_if(F.col("has_snp")).alias("total_records"),
            F.count(F.lit(1)).alias("messages"),
            F.count_if(~F.col("has_snp")).alias("tokens"),
            F.max("ts").alias("last_ts")]
    out = df.groupBy(*keys).agg(*aggs)
    if not with_sample:
        return out
    valid = df.filter(F.col("has_snp"))
    valid = valid.select(*[c for c in dict.fromkeys([*keys, "snp_id", "ts", "family_id", MEMBER, "person_id", "chromosome",
                                                     "position", "genotype"]) if c in df.columns])
    first = first_rows(valid, keys, ["snp_id", "ts"], ties=[F.asc(row_order(valid))])
    sample = first.select(*renamed(keys), F.lit(True).alias("_s"), F.col("snp_id").alias("sample_snp_id"),
                          F.col("chromosome").alias("sample_chromosome"), F.col("position").alias("sample_position"),
                          default_genotype("genotype").alias("sample_genotype"))
    out = out.join(sample, same_keys(keys), "left").drop(*[f"_key_{i}" for i in range(len(keys))])
    ann = annotate_gene(out, chrom="sample_chromosome", pos="sample_position", out="sample_gene")
    return ann.withColumn("sample_gene", F.when(F.col("_s"), F.col("sample_gene"))).drop("_s")


# --- A2 / R3 / R4 -------------------------------------------------------------
def window_counts(df: DataFrame, width: str, *, slide: str | None = None,
                  watermark: str | None = None, ts: str = "ts") -> DataFrame:
    """Tumbling (or sliding) event-time windows by member: all messages,
    messages with SNP data and the mean event time in microseconds."""
    src = df.withWatermark(ts, watermark) if watermark else df
    win = F.window(ts, width, slide) if slide else F.window(ts, width)
    us = epoch_us(ts)
    return (src.groupBy(win.alias("window"), F.col(MEMBER))
            .agg(F.count(F.lit(1)).alias("total_records"),
                 F.count_if(F.col("has_snp")).alias("valid_records"),
                 F.sum(us.cast("decimal(38,0)")).alias("_sum_us"))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), MEMBER,
                    "total_records", "valid_records",
                    F.expr("cast(_sum_us div total_records as bigint)").alias("avg_epoch_us")))


def with_group_total(counts: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``counts`` with the group's summed ``count``.  Labels are free text, so
    the total is a partial aggregate that is joined back, not a window that
    brings all labels of a group into one task."""
    by = list(by)
    if not by:
        return counts.withColumn(name, counts.select(F.sum("count")).scalar())
    total = counts.groupBy(*by).agg(F.sum("count").alias(name))
    total = total.select(*[F.col(k).alias(f"_t_{i}") for i, k in enumerate(by)], name)
    on = [F.col(k).eqNullSafe(F.col(f"_t_{i}")) for i, k in enumerate(by)]
    return counts.join(total, on, "inner").select(*counts.columns, name)


# --- A3 / A37 ------------------------------------------------------------------
def chromosome_distribution(df: DataFrame, as_map: bool = False) -> DataFrame:
    """Per member x chromosome x genotype counts plus the chromosome total.
    Empty labels are bucketed before grouping (NULL/'' chromosome ->
    'Unknown', genotype -> '0/0')."""
    base = (_valid(df)
            .select(MEMBER, bucket("chromosome", "Unknown").alias("chromosome"),
                    bucket("genotype", "0/0").alias("genotype"))
            .groupBy(MEMBER, "chromosome", "genotype").agg(F.count(F.lit(1)).alias("count")))
    if as_map:
        return base.groupBy(MEMBER, "chromosome").agg(
            F.sum("count").alias("chromosome_total"),
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("genotype", "count"))))
            .alias("genotypes"))
    return with_group_total(base, [MEMBER, "chromosome"], "chromosome_total")


def hotspot_chromosomes(df: DataFrame, k: int = 5) -> DataFrame:
    """Most frequent chromosome labels over all members (top k)."""
    from allelic.operators.topk import top_k
    totals = (_valid(df).select(bucket("chromosome", "Unknown").alias("chromosome"))
              .groupBy("chromosome").agg(F.count(F.lit(1)).alias("total")))
    return top_k(totals, [F.desc("total"), F.asc("chromosome")], k, rank_col="rank")


# --- A4 / T1 / W10 ---------------------------------------------------------------
def position_hotspots(df: DataFrame, k: int = 10, per_member: bool = False) -> DataFrame:
    """Top-k (chromosome, position) by frequency; NULL positions excluded.
    Ties: chromosome, then position (NULL chromosome last)."""
    from allelic.operators.topk import top_k
    keys = ([MEMBER] if per_member else []) + ["chromosome", "position"]
    freq = (_valid(df).filter(F.col("position").isNotNull())
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("frequency")))
    order = [F.desc("frequency"), F.asc_nulls_last("chromosome"), F.asc("position")]
    return top_k(freq, order, k, by=[MEMBER] if per_member else None, rank_col="rank")


# --- A5 ---------------------------------------------------------------------------
def genotype_trends(df: DataFrame, by: Sequence[str] = (MEMBER,)) -> DataFrame:
    """Genotype counts, share in percent (2 dp) and total per group."""
    by = list(by)
    counts = (_valid(df).select(*by, bucket("genotype", "0/0").alias("genotype"))
              .groupBy(*by, "genotype").agg(F.count(F.lit(1)).alias("count")))
    return with_group_total(counts, by, "total").withColumn("pct", pct("count", "total", share_first=True))


# --- A6 ---------------------------------------------------------------------------
def individual_heterozygosity(df: DataFrame) -> DataFrame:
    """Per person: heterozygous and homozygous share of length-2 genotypes.
    Rows with NULL/'' person or another genotype length are skipped."""
    # count(_h) skips the NULLs (other genotype lengths); filtering on the
    # derived column instead would push the whole expression into the scan
    h = (_valid(df).filter(F.col("person_id").isNotNull() & (F.col("person_id") != ""))
         .select(MEMBER, "person_id", is_het("genotype").alias("_h")))
    agg = h.groupBy(MEMBER, "person_id").agg(
        F.sum("_h").cast("long").alias("heterozygous"),
        F.count("_h").alias("total_snps")).filter(F.col("total_snps") > 0)
    return agg.select(
        MEMBER, "person_id", "heterozygous",
        (F.col("total_snps") - F.col("heterozygous")).alias("homozygous"),
        pct("heterozygous", "total_snps").alias("heterozygous_pct"),
        pct(F.col("total_snps") - F.col("heterozygous"), "total_snps").alias("homozygous_pct"),
        "total_snps")


# --- A7 ---------------------------------------------------------------------------
def _het_summary(agg: DataFrame, keys: list[str]) -> DataFrame:
    n = F.col("total_snps").cast("double")
    p = F.col("heterozygous").cast("double") / n
    q = F.col("homozygous").cast("double") / n
    return agg.select(
        *keys, "heterozygous", "homozygous",
        pct("heterozygous", "total_snps").alias("heterozygous_pct"),
        pct("homozygous", "total_snps").alias("homozygous_pct"),
        F.round(F.lit(2.0) * p * q, 4).alias("diversity"),
        "total_snps")


def population_heterozygosity(df: DataFrame, by: Sequence[str] = (MEMBER,)) -> DataFrame:
    """Per group: het %, hom %, n and diversity = round(2pq, 4) with p the
    heterozygous and q the homozygous share (the reference's formula).
    Includes rows whose person is NULL."""
    keys = list(by)
    h = _valid(df).select(*keys, is_het("genotype").alias("_h"))
    agg = (h.groupBy(*keys).agg(F.sum("_h").cast("long").alias("heterozygous"),
                                F.count("_h").alias("total_snps"))
           .filter(F.col("total_snps") > 0)
           .withColumn("homozygous", F.col("total_snps") - F.col("heterozygous")))
    return _het_summary(agg, keys)


def diversity_history(df: DataFrame, width: str, n: int = 100, ts: str = "ts") -> DataFrame:
    """Population heterozygosity per event-time window and member;
    the last ``n`` windows per member."""
    from allelic.operators.topk import top_k
    h = _valid(df).select(MEMBER, F.window(ts, width).alias("w"), is_het("genotype").alias("_h"))
    agg = (h.groupBy(MEMBER, F.col("w.start").alias("window_start"))
           .agg(F.sum("_h").cast("long").alias("heterozygous"),
                F.count("_h").alias("total_snps"))
           .filter(F.col("total_snps") > 0)
           .withColumn("homozygous", F.col("total_snps") - F.col("heterozygous")))
    summ = _het_summary(agg, [MEMBER, "window_start"])
    return top_k(summ, [F.desc("window_start")], n, by=[MEMBER])


# --- A8 / A9 ----------------------------------------------------------------------
def running_totals(df: DataFrame) -> DataFrame:
    """Cumulative valid records per member and the grand total ('all')."""
    r = df.rollup(MEMBER).agg(F.count_if(F.col("has_snp")).alias("total_records"),
                              F.grouping(MEMBER).alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col(MEMBER)).alias(MEMBER),
                    "total_records")


def pipeline_counters(df: DataFrame, batch_col: str) -> DataFrame:
    """Batches processed (member x batch), families completed (distinct
    families with a completion token) and the last update time."""
    return df.agg(
        F.count_distinct(F.col(MEMBER), F.col(batch_col)).alias("batches_processed"),
        F.count_distinct(F.when(~F.col("has_snp"), F.col("family_id"))).alias("families_completed"),
        F.max("ts").alias("last_update"))


# --- A10 / A11 ---------------------------------------------------------------------
def gene_frequency(df: DataFrame, *, strict_types: bool = False) -> DataFrame:
    """Count of valid SNPs per gene."""
    ann = annotate_gene(_valid(df).select("chromosome", "position"), strict_types=strict_types)
    return ann.groupBy("gene").agg(F.count(F.lit(1)).alias("count"))


def variant_type_frequency(df: DataFrame) -> DataFrame:
    """Count per variant type (every record is an SNP)."""
    return (_valid(df).select(F.lit("SNP").alias("variant_type"))
            .groupBy("variant_type").agg(F.count(F.lit(1)).alias("count")))


# --- A12 / A13 / A14 / A19 / A20 / A21 ----------------------------------------------
def orientation(style: str, col: str | None = None) -> Column:
    """Orientation class of a genotype column: ``letters`` uses P9 (with
    'invalid' mapped to NULL), ``vcf`` uses P10."""
    if style == "letters":
        c = classify_genotype(col or "genotype")
        return F.when(c != "invalid", c)
    if style == "vcf":
        return genotype_orientation(col or "gt_num")
    raise ValueError(f"unknown orientation style {style!r}")


_CLASSES = ("dominant", "recessive", "heterozygous")


def _class_counts(df: DataFrame, style: str, col: str | None, keys: list[str]) -> DataFrame:
    o = _valid(df).select(*keys, orientation(style, col).alias("_o"))
    return o.groupBy(*keys).agg(
        *[F.count_if(F.col("_o") == k).alias(k) for k in _CLASSES],
        F.count(F.col("_o")).alias("total_genotypes"))


def _stack_classes(wide: DataFrame, keys: list[str], value_cols: Sequence[str], name: str) -> DataFrame:
    pairs = ", ".join(f"'{k}', `{v}`" for k, v in zip(_CLASSES, value_cols))
    return wide.select(*keys, F.expr(f"stack(3, {pairs}) as (orientation, {name})"))


def orientation_distribution(df: DataFrame, style: str = "letters", col: str | None = None) -> DataFrame:
    """Counts of dominant / recessive / heterozygous; all three always
    present (0 when absent); unclassifiable genotypes skipped."""
    wide = _class_counts(df, style, col, [])
    return _stack_classes(wide, [], _CLASSES, "count")


def orientation_percentages(df: DataFrame, style: str = "letters", col: str | None = None) -> DataFrame:
    """Share of each class in percent (2 dp); no rows when nothing is
    classified."""
    wide = _class_counts(df, style, col, []).filter(F.col("total_genotypes") > 0)
    wide = wide.select(*[pct(k, "total_genotypes", share_first=True).alias(f"{k}_pct") for k in _CLASSES])
    return _stack_classes(wide, [], [f"{k}_pct" for k in _CLASSES], "pct")


def gene_diversity(df: DataFrame, style: str = "vcf", col: str | None = None,
                   strict_types: bool = False, approximate: bool = False) -> DataFrame:
    """One row: distinct genes / (classified genotypes + 1), 4 dp, 0 when
    nothing is classified (dashboard formula), and distinct genes / all
    variants (README formula).  ``approximate`` counts genes with
    HyperLogLog++ (``approx_count_distinct``) instead of exactly."""
    v = _valid(df)
    ann = annotate_gene(v.select("chromosome", "position", orientation(style, col).alias("_o")),
                        strict_types=strict_types)
    if approximate:
        a = ann.agg(F.approx_count_distinct("gene").alias("distinct_genes"),
                    F.count(F.col("_o")).alias("total_genotypes"),
                    F.count(F.lit(1)).alias("total_variants"))
    else:
        # two-level aggregation: per gene first (map-side partial), then one
        # row per gene is counted; no Expand for the distinct count
        per_gene = ann.groupBy("gene").agg(F.count(F.col("_o")).alias("_g"), F.count(F.lit(1)).alias("_n"))
        a = per_gene.agg(F.count(F.lit(1)).alias("distinct_genes"),
                         F.coalesce(F.sum("_g"), F.lit(0)).cast("long").alias("total_genotypes"),
                         F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_variants"))
    return a.select(
        "distinct_genes", "total_genotypes", "total_variants",
        F.when(F.col("total_genotypes") > 0,
               F.round(F.col("distinct_genes").cast("double")
                       / (F.col("total_genotypes") + 1).cast("double"), 4))
        .otherwise(F.lit(0.0)).alias("gene_diversity"),
        ratio("distinct_genes", "total_variants").alias("gene_diversity_readme"))


def genotype_class_trends(df: DataFrame, style: str = "letters", col: str | None = None) -> DataFrame:
    """Per member, share of dominant / recessive / heterozygous."""
    c = _class_counts(df, style, col, [MEMBER])
    return c.select(MEMBER, *_CLASSES, "total_genotypes",
                    *[pct(k, "total_genotypes").alias(f"{k}_pct") for k in _CLASSES])


def genetic_orientation(df: DataFrame, style: str = "letters", col: str | None = None,
                        strict_types: bool = False) -> DataFrame:
    """Per member class shares plus the per-member gene diversity
    (distinct genes / (classified genotypes + 1), 4 dp)."""
    v = _valid(df)
    ann = annotate_gene(v.select(MEMBER, "chromosome", "position",
                                 orientation(style, col).alias("_o")),
                        strict_types=strict_types)
    # per (member, gene) first, then per member: the distinct gene count is
    # a plain row count, no Expand
    per_gene = ann.groupBy(MEMBER, "gene").agg(
        *[F.count_if(F.col("_o") == k).alias(k) for k in _CLASSES],
        F.count(F.col("_o")).alias("total_genotypes"))
    a = per_gene.groupBy(MEMBER).agg(
        *[F.sum(k).cast("long").alias(k) for k in _CLASSES],
        F.sum("total_genotypes").cast("long").alias("total_genotypes"),
        F.count(F.lit(1)).alias("distinct_genes"))
    return a.select(
        MEMBER, *[pct(k, "total_genotypes").alias(f"{k}_pct") for k in _CLASSES],
        F.when(F.col("total_genotypes") > 0,
               F.round(F.col("distinct_genes").cast("double")
                       / (F.col("total_genotypes") + 1).cast("double"), 4))
        .otherwise(F.lit(0.0)).alias("genetic_diversity"))


def member_diversity(df: DataFrame, style: str = "letters", col: str | None = None) -> DataFrame:
    """Genetic diversity per member (projection of A20)."""
    return genetic_orientation(df, style, col).select(MEMBER, "genetic_diversity")


# --- A35 / A36 ------------------------------------------------------------------------
def mutation_rate_by_chromosome(df: DataFrame) -> DataFrame:
    """Share of heterozygous ("variant") calls among length-2 genotypes per
    normalised chromosome."""
    h = _valid(df).select(normalize_chromosome("chromosome").alias("chromosome"),
                          is_het("genotype").alias("_h"))
    a = (h.groupBy("chromosome").agg(F.sum("_h").cast("long").alias("variant_snps"),
                                     F.count("_h").alias("total_snps"))
         .filter(F.col("total_snps") > 0))
    return a.withColumn("mutation_rate", ratio("variant_snps", "total_snps"))


def member_rollup(df: DataFrame) -> DataFrame:
    """ROLLUP(chromosome, member_type, family_id) with count and position
    avg / min / max; ``level`` is the grouping id (0 = finest)."""
    v = _valid(df).select(normalize_chromosome("chromosome").alias("chromosome"),
                          MEMBER, "family_id", "position")
    return v.rollup("chromosome", MEMBER, "family_id").agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)).alias("snps"),
        F.round(F.avg("position"), 2).alias("avg_position"),
        F.min("position").alias("min_position"),
        F.max("position").alias("max_position"))
