"""Registered aggregate, time-series, profile and family queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from allelic.operators.genes import apply_record_defaults
from allelic.functions import genotype as G
from allelic.operators import family as FAM
from allelic.operators import metrics as M
from allelic.operators import profile as P
from allelic.operators import timeseries as TS
from allelic.operators import topk as TK
from allelic.plans import sqlparts as S
from allelic.plans.catalog import (
    HOUR_US, LONG_S, MID_S, QUANTILES, SHORT_S, W, hour_batch, load_snps, query,
)
from allelic.session import scratch_path
from allelic.streaming import runner as R

HET = S.is_het("genotype")


def _pop_sql(keys: str, src: str = "snps", extra_where: str = "") -> str:
    return (f"SELECT {keys}, CAST(sum(h) AS BIGINT) AS heterozygous, "
            f"CAST(count(*) - sum(h) AS BIGINT) AS homozygous, "
            f"{S.pct('sum(h)', 'count(*)')} AS heterozygous_pct, "
            f"{S.pct('count(*) - sum(h)', 'count(*)')} AS homozygous_pct, "
            f"round(2.0 * (CAST(sum(h) AS DOUBLE) / CAST(count(*) AS DOUBLE)) * "
            f"(CAST(count(*) - sum(h) AS DOUBLE) / CAST(count(*) AS DOUBLE)), 4) AS diversity, "
            f"count(*) AS total_snps "
            f"FROM (SELECT *, {HET} AS h FROM {src} WHERE has_snp {extra_where}) WHERE h IS NOT NULL "
            f"GROUP BY {keys}")


# ----------------------------------------------------------------------------
# Heterozygosity and distributions
# ----------------------------------------------------------------------------
@query("population_heterozygosity", W() + _pop_sql("member_type"))
def q_population(spark, d):
    return M.population_heterozygosity(load_snps(spark, d))


@query("individual_heterozygosity", W() + f"""SELECT member_type, person_id, CAST(sum(h) AS BIGINT) AS heterozygous,
  CAST(count(*) - sum(h) AS BIGINT) AS homozygous, {S.pct('sum(h)', 'count(*)')} AS heterozygous_pct,
  {S.pct('count(*) - sum(h)', 'count(*)')} AS homozygous_pct, count(*) AS total_snps
  FROM (SELECT *, {HET} AS h FROM snps WHERE has_snp AND person_id IS NOT NULL AND person_id <> '')
  WHERE h IS NOT NULL GROUP BY member_type, person_id""")
def q_individual(spark, d):
    return M.individual_heterozygosity(load_snps(spark, d))


@query("chromosome_distribution", W() + f"""SELECT member_type, chromosome, genotype, count,
  CAST(sum(count) OVER (PARTITION BY member_type, chromosome) AS BIGINT) AS chromosome_total FROM (
  SELECT member_type, {S.bucket('chromosome', 'Unknown')} AS chromosome, {S.bucket('genotype', '0/0')} AS genotype,
  count(*) AS count FROM snps WHERE has_snp GROUP BY ALL)""")
def q_chrom_dist(spark, d):
    return M.chromosome_distribution(load_snps(spark, d))


@query("chromosome_distribution_map", W() + f"""SELECT member_type, chromosome, CAST(sum(count) AS BIGINT) AS chromosome_total,
  string_agg(genotype || '=' || CAST(count AS VARCHAR), ',' ORDER BY genotype) AS genotypes FROM (
  SELECT member_type, {S.bucket('chromosome', 'Unknown')} AS chromosome, {S.bucket('genotype', '0/0')} AS genotype,
  count(*) AS count FROM snps WHERE has_snp GROUP BY ALL) GROUP BY member_type, chromosome""")
def q_chrom_map(spark, d):
    m = M.chromosome_distribution(load_snps(spark, d), as_map=True)
    entries = F.transform(F.map_entries("genotypes"),
                          lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return m.select("member_type", "chromosome", "chromosome_total",
                    F.array_join(entries, ",").alias("genotypes"))


@query("genotype_trends", W() + f"""SELECT member_type, genotype, count,
  CAST(sum(count) OVER (PARTITION BY member_type) AS BIGINT) AS total,
  {S.pct('count', 'sum(count) OVER (PARTITION BY member_type)', share_first=True)} AS pct FROM (
  SELECT member_type, {S.bucket('genotype', '0/0')} AS genotype, count(*) AS count
  FROM snps WHERE has_snp GROUP BY ALL)""")
def q_genotype_trends(spark, d):
    return M.genotype_trends(load_snps(spark, d))


_HOT = (f"SELECT chromosome, position, count(*) AS frequency FROM snps WHERE has_snp AND position IS NOT NULL "
        f"GROUP BY ALL")


@query("position_hotspots", W() + f"""SELECT *, row_number() OVER (ORDER BY frequency DESC,
  chromosome ASC NULLS LAST, position ASC) AS rank FROM ({_HOT}) QUALIFY rank <= 10""")
def q_hotspots(spark, d):
    return M.position_hotspots(load_snps(spark, d), k=10)


@query("hotspots_per_member", W() + """SELECT *, row_number() OVER (PARTITION BY member_type ORDER BY frequency DESC,
  chromosome ASC NULLS LAST, position ASC) AS rank FROM (
  SELECT member_type, chromosome, position, count(*) AS frequency FROM snps
  WHERE has_snp AND position IS NOT NULL GROUP BY ALL) QUALIFY rank <= 10""")
def q_hot_member(spark, d):
    return M.position_hotspots(load_snps(spark, d), k=10, per_member=True)


@query("hotspot_label", W() + f"""SELECT chromosome, position, frequency,
  'Chr' || chromosome || ':' || CAST(position AS VARCHAR) AS label FROM ({_HOT})
  ORDER BY frequency DESC, chromosome ASC NULLS LAST, position ASC LIMIT 10""")
def q_hot_label(spark, d):
    h = M.position_hotspots(load_snps(spark, d), k=10)
    return h.select("chromosome", "position", "frequency",
                    G.hotspot_label("chromosome", "position").alias("label"))


@query("global_hotspots", W() + """, pm AS (SELECT * FROM (SELECT member_type, chromosome, position, count(*) AS frequency
  FROM snps WHERE has_snp AND position IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY member_type ORDER BY frequency DESC, chromosome ASC NULLS LAST, position) <= 10)
  SELECT chromosome, position, CAST(sum(frequency) AS BIGINT) AS frequency,
  row_number() OVER (ORDER BY sum(frequency) DESC, chromosome ASC NULLS LAST, position) AS rank
  FROM pm GROUP BY chromosome, position QUALIFY rank <= 10""")
def q_global_hot(spark, d):
    per = M.position_hotspots(load_snps(spark, d), k=10, per_member=True)
    return TK.global_hotspots(per.drop("rank"), k=10)


@query("hotspot_chromosomes", W() + f"""SELECT chromosome, total, row_number() OVER (ORDER BY total DESC, chromosome) AS rank
  FROM (SELECT {S.bucket('chromosome', 'Unknown')} AS chromosome, count(*) AS total FROM snps WHERE has_snp GROUP BY 1)
  QUALIFY rank <= 5""")
def q_hot_chrom(spark, d):
    return M.hotspot_chromosomes(load_snps(spark, d), k=5)


# ----------------------------------------------------------------------------
# Batch metrics and counters
# ----------------------------------------------------------------------------
@query("batch_metrics", W() + """SELECT member_type, count(*) FILTER (WHERE has_snp) AS total_records,
  count(*) AS messages, count(*) FILTER (WHERE NOT has_snp) AS tokens, max(ts) AS last_ts
  FROM snps GROUP BY member_type""")
def q_batch_metrics(spark, d):
    return M.batch_metrics(load_snps(spark, d))


@query("batch_metrics_sample", W(
    "smp AS (SELECT member_type, min(snp_id) FILTER (WHERE has_snp) AS sid FROM snps GROUP BY member_type)",
    *S.annotated_cte(where="snp_id IN (SELECT sid FROM smp)")) + f"""SELECT b.member_type,
  count(*) FILTER (WHERE b.has_snp) AS total_records, count(*) AS messages,
  count(*) FILTER (WHERE NOT b.has_snp) AS tokens, max(b.ts) AS last_ts,
  any_value(a.snp_id) AS sample_snp_id, any_value(a.chromosome) AS sample_chromosome,
  any_value(a.position) AS sample_position, any_value({S.bucket('a.genotype', '0/0')}) AS sample_genotype,
  any_value(a.gene) AS sample_gene
  FROM snps b JOIN smp USING (member_type) LEFT JOIN ann a ON a.snp_id = smp.sid GROUP BY b.member_type""")
def q_batch_metrics_sample(spark, d):
    """A1 with the per-batch sample genetic record."""
    return M.batch_metrics(load_snps(spark, d), with_sample=True)


def _window_sql(width_us: int) -> str:
    return W() + f"""SELECT {S.window_start(width_us)} AS window_start,
  {S.window_start(width_us)} + to_microseconds({width_us}) AS window_end, member_type,
  count(*) AS total_records, count(*) FILTER (WHERE has_snp) AS valid_records,
  CAST(sum(epoch_us(ts)) // count(*) AS BIGINT) AS avg_epoch_us FROM snps GROUP BY ALL"""


for _name, _width, _us in [("window_counts_1m", "1 minute", 60), ("window_counts_5m", "5 minutes", 300),
                           ("window_counts_15m", "15 minutes", 900), ("window_counts_1h", "1 hour", 3600),
                           ("window_counts_10s", "10 seconds", 10)]:
    def _mk(width):
        def q(spark, d):
            return M.window_counts(load_snps(spark, d), width)
        q.__doc__ = f"A2/R3/R4: tumbling {width} event-time windows per member."
        return q
    query(_name, _window_sql(_us * 1_000_000))(_mk(_width))


@query("running_totals", W() + """SELECT CASE WHEN grouping(member_type) = 1 THEN 'all' ELSE member_type END AS member_type,
  count(*) FILTER (WHERE has_snp) AS total_records FROM snps GROUP BY ROLLUP (member_type)""")
def q_running(spark, d):
    return M.running_totals(load_snps(spark, d))


@query("pipeline_counters", W() + f"""SELECT count(DISTINCT (member_type, {S.window_start(HOUR_US)})) AS batches_processed,
  count(DISTINCT CASE WHEN NOT has_snp THEN family_id END) AS families_completed, max(ts) AS last_update FROM snps""")
def q_counters(spark, d):
    return M.pipeline_counters(hour_batch(load_snps(spark, d)), "batch")


@query("ingest_statistics", W() + """SELECT count(DISTINCT family_id) AS families,
  count(*) FILTER (WHERE has_snp) AS total_snps,
  round(CAST(count(*) FILTER (WHERE has_snp) AS DOUBLE) / CAST(greatest(count(DISTINCT family_id), 1) AS DOUBLE), 2)
  AS avg_snps_per_family FROM snps""")
def q_ingest(spark, d):
    return FAM.ingest_statistics(load_snps(spark, d))


_BATCHES = (f"SELECT member_type, {S.window_start(HOUR_US)} AS batch, count(*) FILTER (WHERE has_snp) AS total_records, "
            f"count(*) AS messages, count(*) FILTER (WHERE NOT has_snp) AS tokens, max(ts) AS last_ts "
            f"FROM snps GROUP BY ALL")


def _batches(spark, d):
    return M.batch_metrics(hour_batch(load_snps(spark, d)), "batch")


@query("processing_history", W() + f"""SELECT * FROM ({_BATCHES}) ORDER BY batch DESC, member_type DESC LIMIT 50""")
def q_proc_hist(spark, d):
    b = _batches(spark, d)
    return TK.top_k(b, [F.desc("batch"), F.desc("member_type")], 50)


@query("record_defaults", W() + """SELECT CASE WHEN has_snp THEN 'SNP' ELSE 'SNP' END AS variant_type,
  coalesce(person_id, 'Unknown') AS gene, coalesce(genotype, 'Unknown') AS genotype, coalesce(chromosome, '0') AS chromosome,
  coalesce(position, 0) AS position, CASE WHEN has_snp THEN 99 ELSE 0 END AS quality FROM snps""")
def q_record_defaults(spark, d):
    """P12 over records of all rows: the person stands in for the gene, and
    completion tokens for records without fields."""
    has = F.col("has_snp")
    rec = load_snps(spark, d).select(
        F.when(has, "SNP").alias("variant_type"), F.col("person_id").alias("gene"), "genotype", "chromosome", "position",
        F.when(has, 99).alias("quality"))
    return apply_record_defaults(rec)


@query("task_time_series", W() + f"""SELECT *, row_number() OVER (PARTITION BY member_type ORDER BY batch) - 1 AS seq
  FROM ({_BATCHES})""")
def q_task_series(spark, d):
    return TS.sequence(_batches(spark, d), ["member_type"], "batch")


@query("downsample_last_n", W() + f""", b AS (SELECT *, row_number() OVER (PARTITION BY member_type ORDER BY batch) - 1 AS i,
  count(*) OVER (PARTITION BY member_type) AS n FROM ({_BATCHES})),
  k AS (SELECT * EXCLUDE (i, n) FROM b WHERE n <= 100 OR i % greatest(CAST(ceil(n / 100.0) AS BIGINT), 1) = 0)
  SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY member_type ORDER BY batch DESC) <= 100""")
def q_downsample(spark, d):
    return TS.downsample(_batches(spark, d), 100, "batch", by=["member_type"])


@query("live_hotspots", W() + """SELECT *, row_number() OVER (PARTITION BY member_type ORDER BY frequency DESC,
  chromosome ASC NULLS LAST, position ASC) AS rank FROM (
  SELECT member_type, chromosome, position, count(*) AS frequency FROM snps
  WHERE has_snp AND position IS NOT NULL GROUP BY ALL) QUALIFY rank <= 10""")
def q_live_hotspots(spark, d):
    """The sink's own path: the table in three batches by day, the lists of
    hotspots kept from the first refresh to the second."""
    out = scratch_path(spark, f"live-hotspots-{uuid.uuid4().hex}")
    snps = load_snps(spark, d).withColumn("kind", F.when(F.col("has_snp"), "snp").otherwise("token"))
    of = F.pmod(F.coalesce(F.dayofyear("ts"), F.lit(0)), F.lit(3))
    for batch in range(3):
        R.write_partials(snps.filter(of == batch), batch, out)
        if batch != 1:
            R.refresh_positions(spark, out, batch)
    return R.derived_snapshot(spark, out, "hotspots").drop("batch_id")


@query("metric_snapshot", W() + """SELECT member_type, count(*) FILTER (WHERE has_snp) AS total_records, count(*) AS messages,
  count(*) FILTER (WHERE NOT has_snp) AS tokens, max(ts) AS last_ts FROM snps GROUP BY member_type""")
def q_snapshot(spark, d):
    """The sink's own path: the table in three batches by day, each written as
    partials, the first two merged into a base, all read as one snapshot."""
    out = scratch_path(spark, f"metric-snapshot-{uuid.uuid4().hex}")
    snps = load_snps(spark, d).withColumn("kind", F.when(F.col("has_snp"), "snp").otherwise("token"))
    of = F.pmod(F.coalesce(F.dayofyear("ts"), F.lit(0)), F.lit(3))
    for batch in range(3):
        R.write_partials(snps.filter(of == batch), batch, out)
        if batch == 1:
            R.compact(spark, out, batch)
    return R.metric_snapshot(spark, out, "batch_metrics")


@query("latest_by_key", W() + """SELECT person_id, arg_max_null(snp_id, (ts, snp_id)) AS snp_id, max(ts) AS ts,
  arg_max_null(chromosome, (ts, snp_id)) AS chromosome, arg_max_null(position, (ts, snp_id)) AS position,
  arg_max_null(genotype, (ts, snp_id)) AS genotype FROM snps WHERE has_snp AND person_id IS NOT NULL GROUP BY person_id""")
def q_latest(spark, d):
    s = load_snps(spark, d).filter(F.col("has_snp") & F.col("person_id").isNotNull()).select(
        "person_id", "snp_id", "ts", "chromosome", "position", "genotype")
    return TS.latest_by_key(s, ["person_id"], "ts", tiebreak="snp_id")


@query("sample_first_per_batch", W() + f"""SELECT {S.window_start(HOUR_US)} AS batch, min(snp_id) AS snp_id,
  arg_min_null(chromosome, snp_id) AS chromosome, arg_min_null(position, snp_id) AS position, arg_min_null(genotype, snp_id) AS genotype
  FROM snps WHERE has_snp GROUP BY 1""")
def q_first_batch(spark, d):
    s = hour_batch(load_snps(spark, d)).filter("has_snp").select(
        "batch", "snp_id", "chromosome", "position", "genotype")
    return TS.first_per_batch(s, "batch")


@query("union_member_streams", W() + """SELECT member_type, count(*) AS messages FROM snps
  WHERE member_type IN ('father', 'mother', 'child') GROUP BY member_type""")
def q_union(spark, d):
    s = TK.members_of(load_snps(spark, d))
    return s.groupBy("member_type").agg(F.count(F.lit(1)).alias("messages"))


@query("union_member_metrics", W() + f"""SELECT DISTINCT {S.bucket('chromosome', 'Unknown')} AS chromosome FROM snps WHERE has_snp""")
def q_union_metrics(spark, d):
    s = TK.members_of(load_snps(spark, d)).filter(F.col("has_snp"))
    return s.select(G.bucket("chromosome", "Unknown").alias("chromosome")).distinct()


@query("chromosome_order", W() + """SELECT chromosome, row_number() OVER (ORDER BY chromosome) AS lexical_rank,
  row_number() OVER (ORDER BY CASE WHEN regexp_full_match(regexp_replace(upper(chromosome), '^CHR', ''), '[0-9]+')
    THEN CAST(regexp_replace(upper(chromosome), '^CHR', '') AS INTEGER)
   WHEN regexp_replace(upper(chromosome), '^CHR', '') = 'X' THEN 1001
   WHEN regexp_replace(upper(chromosome), '^CHR', '') = 'Y' THEN 1002
   WHEN regexp_replace(upper(chromosome), '^CHR', '') = 'MT' THEN 1003 ELSE 2000 END, chromosome) AS natural_rank
  FROM (SELECT DISTINCT chromosome FROM snps WHERE chromosome IS NOT NULL)""")
def q_chrom_order(spark, d):
    o = TK.chromosome_order(load_snps(spark, d))
    return o.select("chromosome", F.col("lexical_rank").cast("long"), F.col("natural_rank").cast("long"))


# ----------------------------------------------------------------------------
# Genes and orientation
# ----------------------------------------------------------------------------
@query("gene_lookup_join", W(*S.annotated_cte()) + "SELECT snp_id, chromosome, position, gene FROM ann")
def q_gene_lookup(spark, d):
    from allelic.operators.genes import annotate_gene
    s = load_snps(spark, d).filter("has_snp").select("snp_id", "chromosome", "position")
    return annotate_gene(s)


@query("gene_frequency", W(*S.annotated_cte()) + "SELECT gene, count(*) AS count FROM ann GROUP BY gene")
def q_gene_freq(spark, d):
    return M.gene_frequency(load_snps(spark, d))


@query("top_genes", W(*S.annotated_cte()) + """SELECT gene, count, row_number() OVER (ORDER BY count DESC, gene) AS rank
  FROM (SELECT gene, count(*) AS count FROM ann GROUP BY gene) QUALIFY rank <= 5""")
def q_top_genes(spark, d):
    return TK.top_genes(M.gene_frequency(load_snps(spark, d)), 5)


@query("variant_type_frequency", W() + "SELECT 'SNP' AS variant_type, count(*) AS count FROM snps WHERE has_snp")
def q_variant_freq(spark, d):
    return M.variant_type_frequency(load_snps(spark, d))


@query("top_variants", W() + """SELECT 'SNP' AS variant_type, count(*) AS count, CAST(1 AS BIGINT) AS rank
  FROM snps WHERE has_snp""")
def q_top_variants(spark, d):
    return TK.top_variants(M.variant_type_frequency(load_snps(spark, d)), 5)


def _orient_counts_sql(style: str, keys: str = "") -> str:
    o = S.orientation(style)
    sel = f"{keys}, " if keys else ""
    grp = f"GROUP BY {keys}" if keys else ""
    return (f"SELECT {sel}count(*) FILTER (WHERE o = 'dominant') AS dominant, "
            f"count(*) FILTER (WHERE o = 'recessive') AS recessive, "
            f"count(*) FILTER (WHERE o = 'heterozygous') AS heterozygous, count(o) AS total_genotypes "
            f"FROM (SELECT *, {o} AS o FROM snps WHERE has_snp) {grp}")


for _style, _suffix in [("letters", ""), ("vcf", "_vcf")]:
    def _dist(style):
        def q(spark, d):
            return M.orientation_distribution(load_snps(spark, d), style)
        return q

    def _pcts(style):
        def q(spark, d):
            return M.orientation_percentages(load_snps(spark, d), style)
        return q
    query(f"orientation_distribution{_suffix}", W(f"c AS ({_orient_counts_sql(_style)})") +
          """SELECT 'dominant' AS orientation, dominant AS count FROM c UNION ALL
             SELECT 'recessive', recessive FROM c UNION ALL SELECT 'heterozygous', heterozygous FROM c""")(_dist(_style))
    query(f"orientation_percentages{_suffix}", W(f"c AS ({_orient_counts_sql(_style)} )") +
          f"""SELECT 'dominant' AS orientation, {S.pct('dominant', 'total_genotypes', share_first=True)} AS pct FROM c WHERE total_genotypes > 0
             UNION ALL SELECT 'recessive', {S.pct('recessive', 'total_genotypes', share_first=True)} FROM c WHERE total_genotypes > 0
             UNION ALL SELECT 'heterozygous', {S.pct('heterozygous', 'total_genotypes', share_first=True)} FROM c WHERE total_genotypes > 0
          """)(_pcts(_style))


@query("gene_diversity", W(*S.annotated_cte()) + f"""SELECT count(DISTINCT gene) AS distinct_genes,
  count(o) AS total_genotypes, count(*) AS total_variants,
  CASE WHEN count(o) > 0 THEN round(CAST(count(DISTINCT gene) AS DOUBLE) / CAST(count(o) + 1 AS DOUBLE), 4) ELSE 0.0 END
   AS gene_diversity, {S.ratio('count(DISTINCT gene)', 'count(*)')} AS gene_diversity_readme
  FROM (SELECT *, {S.orientation('vcf')} AS o FROM ann)""")
def q_gene_div(spark, d):
    return M.gene_diversity(load_snps(spark, d), style="vcf")


@query("genotype_class_trends", W() + f"""SELECT member_type, dominant, recessive, heterozygous, total_genotypes,
  {S.pct('dominant', 'total_genotypes')} AS dominant_pct, {S.pct('recessive', 'total_genotypes')} AS recessive_pct,
  {S.pct('heterozygous', 'total_genotypes')} AS heterozygous_pct FROM ({_orient_counts_sql('letters', 'member_type')})""")
def q_class_trends(spark, d):
    return M.genotype_class_trends(load_snps(spark, d))


_ORIENT_MEMBER = (f"SELECT member_type, count(*) FILTER (WHERE o = 'dominant') AS dominant, "
                  f"count(*) FILTER (WHERE o = 'recessive') AS recessive, "
                  f"count(*) FILTER (WHERE o = 'heterozygous') AS heterozygous, count(o) AS total_genotypes, "
                  f"count(DISTINCT gene) AS distinct_genes "
                  f"FROM (SELECT *, {S.orientation('letters')} AS o FROM ann) GROUP BY member_type")
_GDIV = ("CASE WHEN total_genotypes > 0 THEN round(CAST(distinct_genes AS DOUBLE) / "
         "CAST(total_genotypes + 1 AS DOUBLE), 4) ELSE 0.0 END AS genetic_diversity")


@query("genetic_orientation", W(*S.annotated_cte()) + f"""SELECT member_type,
  {S.pct('dominant', 'total_genotypes')} AS dominant_pct, {S.pct('recessive', 'total_genotypes')} AS recessive_pct,
  {S.pct('heterozygous', 'total_genotypes')} AS heterozygous_pct, {_GDIV} FROM ({_ORIENT_MEMBER})""")
def q_gen_orient(spark, d):
    return M.genetic_orientation(load_snps(spark, d))


@query("member_diversity", W(*S.annotated_cte()) + f"SELECT member_type, {_GDIV} FROM ({_ORIENT_MEMBER})")
def q_member_div(spark, d):
    return M.member_diversity(load_snps(spark, d))


# ----------------------------------------------------------------------------
# Rates, trends, anomalies
# ----------------------------------------------------------------------------
@query("mutation_rate_trailing", W(S.rate_cte([LONG_S])) + f"""SELECT ts, n_at, n_{LONG_S}s AS n_window,
  round(CAST(n_{LONG_S}s AS DOUBLE) / {float(LONG_S)}, 4) AS mutation_rate FROM rates""")
def q_mut_rate(spark, d):
    return TS.mutation_rate(load_snps(spark, d), LONG_S)


@query("mutation_rate_by_member", W(S.rate_cte([LONG_S], by=["member_type"])) + f"""SELECT member_type, ts, n_at,
  n_{LONG_S}s AS n_window, round(CAST(n_{LONG_S}s AS DOUBLE) / {float(LONG_S)}, 4) AS mutation_rate FROM rates""")
def q_mut_rate_member(spark, d):
    return TS.mutation_rate(load_snps(spark, d), LONG_S, by=["member_type"])


@query("mutation_rate_history", W(S.rate_cte([LONG_S])) + f"""SELECT ts, n_at, n_{LONG_S}s AS n_window,
  round(CAST(n_{LONG_S}s AS DOUBLE) / {float(LONG_S)}, 4) AS mutation_rate FROM rates ORDER BY ts DESC LIMIT 60""")
def q_mut_hist(spark, d):
    return TS.mutation_rate_history(load_snps(spark, d), LONG_S, 60)


@query("rate_level", W(S.rate_cte([LONG_S])) + f"""SELECT ts, round(CAST(n_{LONG_S}s AS DOUBLE) / {float(LONG_S)} * 100.0, 2) AS rate_pct,
  CASE WHEN CAST(n_{LONG_S}s AS DOUBLE) / {float(LONG_S)} * 100.0 > 5 THEN 'high'
       WHEN CAST(n_{LONG_S}s AS DOUBLE) / {float(LONG_S)} * 100.0 > 2 THEN 'medium' ELSE 'low' END AS level FROM rates""")
def q_rate_level(spark, d):
    s = TS.rate_series(load_snps(spark, d), (LONG_S,))
    p = F.col(f"rate_{LONG_S}s") * 100.0
    return s.select("ts", F.round(p, 2).alias("rate_pct"), G.rate_level(p).alias("level"))


_RL, _RS = f"(CAST(n_{LONG_S}s AS DOUBLE) / {float(LONG_S)})", f"(CAST(n_{MID_S}s AS DOUBLE) / {float(MID_S)})"
_CHG = f"CASE WHEN {_RL} > 0 THEN round(({_RS} - {_RL}) / {_RL} * 100.0, 2) + 0.0 ELSE 0.0 END"


@query("rate_trend", W(S.rate_cte([LONG_S, MID_S])) + f"""SELECT ts, round({_RS}, 4) AS current_rate,
  round({_RL}, 4) AS previous_rate, {_CHG} AS change_pct,
  CASE WHEN {_CHG} > 5 THEN 'up' WHEN {_CHG} < -5 THEN 'down' ELSE 'stable' END AS direction FROM rates""")
def q_rate_trend(spark, d):
    return TS.rate_trend(load_snps(spark, d), MID_S, LONG_S)


_NS, _NL = f"n_{SHORT_S}s", f"n_{LONG_S}s"
_LHS = f"CAST(abs({_NS} * {LONG_S} - {_NL} * {SHORT_S}) AS DOUBLE)"
_RHS = f"(CAST({_NL} * {SHORT_S} AS DOUBLE) * 2.5)"
_ANOM = f"({_NL} > 0 AND {_LHS} > {_RHS})"


@query("rate_anomaly", W(S.rate_cte([LONG_S, SHORT_S])) + f"""SELECT ts, {_NS} AS n_short, {_NL} AS n_long,
  round(CAST({_NL} AS DOUBLE) / {float(LONG_S)}, 4) AS expected_rate,
  round(CAST({_NS} AS DOUBLE) / {float(SHORT_S)}, 4) AS current_rate,
  round(CAST({_NS} AS DOUBLE) / {float(SHORT_S)} - CAST({_NL} AS DOUBLE) / {float(LONG_S)}, 4) + 0.0 AS deviation,
  {_ANOM} AS is_anomaly,
  CASE WHEN NOT {_ANOM} THEN 'normal' WHEN {_LHS} > {_RHS} * 2 THEN 'high' ELSE 'medium' END AS severity FROM rates""")
def q_rate_anomaly(spark, d):
    return TS.rate_anomaly(load_snps(spark, d), SHORT_S, LONG_S, 2.5)


@query("anomaly_rate", W(S.rate_cte([LONG_S, SHORT_S])) + f"""SELECT count(*) FILTER (WHERE {_ANOM}) AS anomaly_count,
  (SELECT count(*) FROM snps WHERE has_snp) AS total_variants,
  round(CAST(count(*) FILTER (WHERE {_ANOM}) AS DOUBLE) / CAST((SELECT count(*) FROM snps WHERE has_snp) + 1 AS DOUBLE)
   * 100.0, 2) AS anomaly_rate FROM rates""")
def q_anomaly_rate(spark, d):
    return TS.anomaly_rate(load_snps(spark, d), SHORT_S, LONG_S, 2.5)


_WC_HOUR = (f"wc AS (SELECT {S.window_start(HOUR_US)} AS window_start, member_type, "
            f"count(*) FILTER (WHERE has_snp) AS valid_records FROM snps GROUP BY ALL)")


@query("zscore_anomaly", W(_WC_HOUR) + """SELECT window_start,
  member_type, valid_records, round(avg(valid_records) OVER w, 6) AS hist_mean, round(stddev_samp(valid_records) OVER w, 6) AS hist_std,
  coalesce(abs(valid_records - avg(valid_records) OVER w) > 3.0 * stddev_samp(valid_records) OVER w, false) AS is_anomaly
  FROM wc WINDOW w AS (PARTITION BY member_type ORDER BY window_start ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)""")
def q_zscore(spark, d):
    wc = M.window_counts(load_snps(spark, d), "1 hour").select("window_start", "member_type", "valid_records")
    return TS.zscore_anomaly(wc, "valid_records", "window_start", by=["member_type"], k=3.0, history=50)


@query("zscore_anomaly_readme", W(_WC_HOUR) + """SELECT window_start,
  member_type, valid_records, round(avg(valid_records) OVER w, 6) AS hist_mean, round(stddev_samp(valid_records) OVER w, 6) AS hist_std,
  coalesce(abs(valid_records - avg(valid_records) OVER w) > 2.5 * stddev_samp(valid_records) OVER w, false) AS is_anomaly
  FROM wc WINDOW w AS (PARTITION BY member_type ORDER BY window_start ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)""")
def q_zscore_readme(spark, d):
    """W6 with the README's 2.5 sigma threshold (the report uses 3)."""
    wc = M.window_counts(load_snps(spark, d), "1 hour").select("window_start", "member_type", "valid_records")
    return TS.zscore_anomaly(wc, "valid_records", "window_start", by=["member_type"], k=2.5, history=50)


@query("diversity_history", W() + f"""SELECT * FROM ({_pop_sql('member_type, window_start',
    src=f"(SELECT *, {S.window_start(24 * HOUR_US)} AS window_start FROM snps)")})
  QUALIFY row_number() OVER (PARTITION BY member_type ORDER BY window_start DESC) <= 100""")
def q_div_hist(spark, d):
    return M.diversity_history(load_snps(spark, d), "1 day", n=100)


# ----------------------------------------------------------------------------
# Documented analytics
# ----------------------------------------------------------------------------
@query("mutation_rate_by_chromosome", W() + f"""SELECT {S.norm_chrom('chromosome')} AS chromosome,
  CAST(sum(h) AS BIGINT) AS variant_snps, count(*) AS total_snps, {S.ratio('sum(h)', 'count(*)')} AS mutation_rate
  FROM (SELECT *, {HET} AS h FROM snps WHERE has_snp) WHERE h IS NOT NULL GROUP BY 1""")
def q_mut_chrom(spark, d):
    return M.mutation_rate_by_chromosome(load_snps(spark, d))


@query("family_member_chromosome_rollup", W() + f"""SELECT chromosome, member_type, family_id,
  CAST(grouping(chromosome, member_type, family_id) AS BIGINT) AS level, count(*) AS snps,
  round(avg(position), 2) AS avg_position, min(position) AS min_position, max(position) AS max_position
  FROM (SELECT {S.norm_chrom('chromosome')} AS chromosome, member_type, family_id, position FROM snps WHERE has_snp)
  GROUP BY ROLLUP (chromosome, member_type, family_id)""")
def q_rollup(spark, d):
    return M.member_rollup(load_snps(spark, d))


# ----------------------------------------------------------------------------
# Family statistics and trios
# ----------------------------------------------------------------------------
_PERSONS = ("SELECT family_id, person_id, member_type, gender, count(*) FILTER (WHERE has_snp) AS snps, "
            "min(ts) AS first_ts, max(ts) AS last_ts FROM snps WHERE person_id IS NOT NULL GROUP BY ALL")


@query("family_stats", W() + f"""SELECT family_id, count(*) AS members_count, count(DISTINCT person_id) AS unique_persons,
  round(avg(snps), 4) AS avg_snps, max(snps) AS max_snps, min(snps) AS min_snps,
  array_to_string(list_sort(list_distinct(list(gender))), ',') AS genders,
  (SELECT count(DISTINCT family_id) FROM snps WHERE person_id IS NOT NULL) AS total_families
  FROM ({_PERSONS}) GROUP BY family_id""")
def q_family_stats(spark, d):
    f = FAM.family_stats(load_snps(spark, d))
    return f.withColumn("genders", F.array_join("genders", ","))


@query("family_completion_summary", W() + f"""SELECT family_id, count(*) AS total_members,
  count(*) FILTER (WHERE member_type = 'child') AS num_children, CAST(sum(snps) AS BIGINT) AS total_snps,
  CAST(sum(snps) FILTER (WHERE member_type = 'father') AS BIGINT) AS father_snps,
  CAST(sum(snps) FILTER (WHERE member_type = 'mother') AS BIGINT) AS mother_snps,
  coalesce(string_agg(CAST(snps AS VARCHAR), ',' ORDER BY person_id) FILTER (WHERE member_type = 'child'), '') AS children_snps,
  min(first_ts) AS generation_start, max(last_ts) AS generation_end,
  (epoch_us(max(last_ts)) - epoch_us(min(first_ts))) / 1e6 AS generation_duration_secs
  FROM ({_PERSONS}) GROUP BY family_id""")
def q_family_completion(spark, d):
    f = FAM.family_completion_summary(load_snps(spark, d))
    return f.withColumn("children_snps", F.array_join(F.col("children_snps").cast("array<string>"), ","))


def _calls(spark, d):
    return FAM.genotype_calls(load_snps(spark, d))


_CALLS = (f"calls AS (SELECT family_id, person_id, member_type, {S.norm_chrom('chromosome')} || ':' || position AS locus, "
          "arg_min(genotype, snp_id) AS genotype FROM snps WHERE has_snp AND person_id IS NOT NULL "
          "AND family_id IS NOT NULL AND position IS NOT NULL AND chromosome IS NOT NULL "
          "AND regexp_full_match(genotype, '[ACGT]{2}') GROUP BY ALL)")
_TRIOS = ("trios AS (SELECT c.family_id, c.locus, c.person_id AS child_id, c.genotype AS child_gt, "
          "f.person_id AS father_id, f.genotype AS father_gt, m.person_id AS mother_id, m.genotype AS mother_gt "
          "FROM calls c JOIN calls f ON c.family_id = f.family_id AND c.locus = f.locus AND f.member_type = 'father' "
          "JOIN calls m ON c.family_id = m.family_id AND c.locus = m.locus AND m.member_type = 'mother' "
          "WHERE c.member_type = 'child')")


@query("trio_join", W(_CALLS, _TRIOS) + "SELECT * FROM trios")
def q_trio(spark, d):
    return FAM.trio_join(_calls(spark, d))


def _in(a: str, g: str) -> str:
    return f"({a} = substr({g},1,1) OR {a} = substr({g},2,1))"


_CA, _CB = "substr(child_gt,1,1)", "substr(child_gt,2,1)"
_OK = (f"(({_in(_CA, 'father_gt')} AND {_in(_CB, 'mother_gt')}) OR "
       f"({_in(_CB, 'father_gt')} AND {_in(_CA, 'mother_gt')}))")


@query("mendelian_consistency", W(_CALLS, _TRIOS) + f"""SELECT family_id, count(*) AS trios,
  count(*) FILTER (WHERE {_OK}) AS consistent, {S.ratio(f'count(*) FILTER (WHERE {_OK})', 'count(*)')} AS consistent_share
  FROM trios GROUP BY family_id""")
def q_mendel(spark, d):
    return FAM.mendelian_consistency(_calls(spark, d))


def _ibs(a: str, b: str) -> str:
    a1, b1, a2, b2 = f"substr({a},1,1)", f"substr({a},2,1)", f"substr({b},1,1)", f"substr({b},2,1)"
    return (f"CASE WHEN ({a1} = {a2} AND {b1} = {b2}) OR ({a1} = {b2} AND {b1} = {a2}) THEN 2 "
            f"WHEN {a1} = {a2} OR {a1} = {b2} OR {b1} = {a2} OR {b1} = {b2} THEN 1 ELSE 0 END")


def _pairs_sql(ra: str, rb: str, rel: str) -> str:
    return (f"SELECT a.family_id, '{rel}' AS relation, a.person_id AS person_a, b.person_id AS person_b, "
            f"a.genotype AS gt_a, b.genotype AS gt_b FROM calls a JOIN calls b ON a.family_id = b.family_id "
            f"AND a.locus = b.locus WHERE a.member_type = '{ra}' AND b.member_type = '{rb}'")


@query("genetic_similarity", W(_CALLS) + f"""SELECT family_id, relation, person_a, person_b, count(*) AS loci,
  round(avg({_ibs('gt_a', 'gt_b')} / 2.0), 4) AS similarity FROM (
  {_pairs_sql('father', 'mother', 'father-mother')} UNION ALL {_pairs_sql('father', 'child', 'father-child')}
  UNION ALL {_pairs_sql('mother', 'child', 'mother-child')}
  UNION ALL {_pairs_sql('child', 'child', 'siblings')} AND a.person_id < b.person_id) GROUP BY ALL""")
def q_similarity(spark, d):
    return FAM.genetic_similarity(_calls(spark, d))


# ----------------------------------------------------------------------------
# Genome profiling
# ----------------------------------------------------------------------------
def _profile_sql(col: str) -> str:
    return W() + f"""SELECT member_type, value, count,
  round(CAST(count AS DOUBLE) / CAST(sum(count) OVER (PARTITION BY member_type) AS DOUBLE), 6) AS share FROM (
  SELECT member_type, {col} AS value, count(*) AS count FROM snps WHERE has_snp AND {col} IS NOT NULL GROUP BY ALL)"""


@query("genotype_profile", _profile_sql("genotype"))
def q_gt_profile(spark, d):
    return P.value_profile(load_snps(spark, d), "genotype", by=["member_type"])


@query("chromosome_profile", _profile_sql("chromosome"))
def q_chrom_profile(spark, d):
    return P.value_profile(load_snps(spark, d), "chromosome", by=["member_type"])


@query("position_profile", W() + """SELECT member_type, chromosome, count(*) AS n, min(position) AS min_position,
  max(position) AS max_position, round(avg(position), 4) AS mean_position,
  round(coalesce(stddev_samp(position), 1e6), 4) AS std_position
  FROM snps WHERE has_snp AND chromosome IS NOT NULL AND position IS NOT NULL GROUP BY ALL""")
def q_pos_profile(spark, d):
    return P.position_profile(load_snps(spark, d), by=["member_type"])


@query("profile_compare_moments", W() + """SELECT member_type, count(*) AS n, round(avg(position), 4) AS mean_position,
  round(stddev_samp(position), 4) AS std_sample, round(stddev_pop(position), 4) AS std_population
  FROM snps WHERE has_snp AND position IS NOT NULL GROUP BY member_type""")
def q_moments(spark, d):
    return P.compare_moments(load_snps(spark, d), "member_type")


@query("profile_compare_chromosomes", W() + """, l AS (SELECT member_type, chromosome, count(*) AS count FROM snps
  WHERE has_snp AND chromosome IS NOT NULL GROUP BY ALL),
  p AS (SELECT member_type, chromosome, round(100.0 * count / sum(count) OVER (PARTITION BY member_type), 4) AS pct FROM l)
  SELECT chromosome, max(pct) FILTER (WHERE member_type = 'father') AS father,
  max(pct) FILTER (WHERE member_type = 'mother') AS mother, max(pct) FILTER (WHERE member_type = 'child') AS child
  FROM p GROUP BY chromosome""")
def q_cmp_chrom(spark, d):
    return P.compare_chromosomes(load_snps(spark, d), "member_type", ["father", "mother", "child"])


@query("profile_compare_genotypes", W() + """SELECT member_type, genotype, count,
  round(100.0 * count / sum(count) OVER (PARTITION BY member_type), 4) AS pct,
  row_number() OVER (PARTITION BY member_type ORDER BY count DESC, genotype) AS rank FROM (
  SELECT member_type, genotype, count(*) AS count FROM snps WHERE has_snp AND genotype IS NOT NULL GROUP BY ALL)
  QUALIFY rank <= 10""")
def q_cmp_gt(spark, d):
    return P.compare_genotypes(load_snps(spark, d), "member_type", 10)


@query("position_histogram", W() + """, x AS (SELECT CAST(position AS DOUBLE) AS x FROM snps WHERE position IS NOT NULL),
  r AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
               CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM x),
  c AS (SELECT CAST(least(floor((x - lo) * 50.0 / (hi - lo)), 49) AS INTEGER) AS bin, count(*) AS count FROM x, r GROUP BY 1),
  b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50))
  SELECT b.bin, round(lo + b.bin * ((hi - lo) / 50.0), 4) AS bin_lo, round(lo + (b.bin + 1) * ((hi - lo) / 50.0), 4) AS bin_hi,
  CAST(coalesce(c.count, 0) AS BIGINT) AS count FROM b CROSS JOIN r LEFT JOIN c USING (bin)""")
def q_hist(spark, d):
    return P.histogram(load_snps(spark, d), "position", bins=50)


@query("null_counts", W() + """SELECT count(*) FILTER (WHERE snp_id IS NULL) AS snp_id, count(*) FILTER (WHERE ts IS NULL) AS ts,
  count(*) FILTER (WHERE family_id IS NULL) AS family_id, count(*) FILTER (WHERE member_type IS NULL) AS member_type,
  count(*) FILTER (WHERE person_id IS NULL) AS person_id, count(*) FILTER (WHERE gender IS NULL) AS gender,
  count(*) FILTER (WHERE has_snp IS NULL) AS has_snp, count(*) FILTER (WHERE chromosome IS NULL) AS chromosome,
  count(*) FILTER (WHERE position IS NULL) AS position, count(*) FILTER (WHERE genotype IS NULL) AS genotype,
  count(*) FILTER (WHERE gt_num IS NULL) AS gt_num FROM snps""")
def q_nulls(spark, d):
    return P.null_counts(load_snps(spark, d))


@query("table_shape", W() + "SELECT member_type, count(*) AS rows, 11 AS columns FROM snps GROUP BY member_type")
def q_shape(spark, d):
    return P.table_shape(load_snps(spark, d), by=["member_type"])


@query("boxplot_stats", W() + """, x AS (SELECT member_type, CAST(position AS DOUBLE) AS x FROM snps WHERE position IS NOT NULL),
  q AS (SELECT member_type, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
        FROM x GROUP BY member_type),
  j AS (SELECT x.member_type, x, q1, median, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lof, q3 + 1.5 * (q3 - q1) AS hif
        FROM x JOIN q USING (member_type))
  SELECT member_type, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(iqr, 4) AS iqr,
  round(min(x) FILTER (WHERE x >= lof AND x <= hif), 4) AS whisker_lo, round(max(x) FILTER (WHERE x >= lof AND x <= hif), 4) AS whisker_hi,
  count(*) FILTER (WHERE NOT (x >= lof AND x <= hif)) AS outliers, count(*) AS n FROM j GROUP BY member_type, q1, median, q3, iqr""")
def q_box(spark, d):
    return P.boxplot_stats(load_snps(spark, d), "position", by=["member_type"], bin_width=P.POSITION_BIN)


@query("value_counts_by_genome", W() + "SELECT member_type, genotype, count(*) AS count FROM snps WHERE has_snp GROUP BY ALL")
def q_value_counts(spark, d):
    return P.value_counts_by(load_snps(spark, d), ["member_type"], "genotype")


@query("distinct_positions", W() + "SELECT DISTINCT chromosome, position FROM snps")
def q_distinct_pos(spark, d):
    return P.distinct_positions(load_snps(spark, d))


_POSIDX = ("idx AS (SELECT chromosome, position, n_at, CAST(coalesce(sum(n_at) OVER (PARTITION BY chromosome ORDER BY position "
           "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_idx, "
           "CAST(sum(n_at) OVER (PARTITION BY chromosome) AS BIGINT) AS n FROM (SELECT chromosome, position, count(*) AS n_at "
           "FROM snps WHERE has_snp AND chromosome IS NOT NULL AND position IS NOT NULL GROUP BY ALL))")


@query("position_ecdf", W(_POSIDX) + "SELECT chromosome, position, n_at, n, CAST(first_idx AS DOUBLE) / n AS ecdf FROM idx")
def q_ecdf(spark, d):
    return P.position_ecdf(load_snps(spark, d))


_QLIST = ", ".join(f"CAST({float(u)} AS DOUBLE)" for u in QUANTILES)


@query("position_quantile", W(_POSIDX) + f""", t AS (SELECT chromosome, n, u,
   CASE WHEN u <= 0 THEN 0 ELSE least(CAST(floor(u * n) AS BIGINT), n - 1) END AS j,
   CASE WHEN u <= 0 OR CAST(floor(u * n) AS BIGINT) >= n - 1 THEN 0.0 ELSE u * n - CAST(floor(u * n) AS BIGINT) END AS f
   FROM (SELECT DISTINCT chromosome, n FROM idx), unnest([{_QLIST}]) AS q(u)),
  p AS (SELECT t.chromosome, t.u, t.f,
     max(i.position) FILTER (WHERE t.j BETWEEN i.first_idx AND i.first_idx + i.n_at - 1) AS p0,
     max(i.position) FILTER (WHERE least(t.j + 1, t.n - 1) BETWEEN i.first_idx AND i.first_idx + i.n_at - 1) AS p1
     FROM t JOIN idx i ON t.chromosome = i.chromosome GROUP BY ALL)
  SELECT chromosome, u, round(p0 + f * (p1 - p0), 4) AS position FROM p""")
def q_quantile(spark, d):
    return P.position_quantile(load_snps(spark, d), QUANTILES)
