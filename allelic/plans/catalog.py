"""Registered queries: one per SURVEY section 2 operator.

Each query reads the driver's tables from ``sf_dir`` (``events`` through
the FIXTURES mapping, or a TPC-H table), runs the library operator over the
whole table and returns a lazy DataFrame.  ``ORACLE`` holds the DuckDB SQL
that computes the same columns independently (brute force where the Spark
plan is clever: gene lookup, trailing frames, top-k).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.functions import genotype as G
from allelic.operators import genes as GEN
from allelic.plans import sqlparts as S
from allelic.sources import codec as C
from allelic.sources.fixture import nest_snp, snps_from_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Event-time widths for the sparse test stream (10,000 events over 30
# days at sf 0.01); the 6:3:1 ratio of the 60/30/10 s defaults is kept.
LONG_S, MID_S, SHORT_S = 6 * 3600, 3 * 3600, 3600
HOUR_US = 3600 * 1_000_000
QUANTILES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Declared schema of the driver's ``events`` table: an explicit schema skips
# footer-based schema inference at planning time.
EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


def load_snps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return snps_from_events(events)


def hour_batch(df: DataFrame) -> DataFrame:
    """Hourly event-time micro-batches (a batch id for batch-mode runs)."""
    return df.withColumn("batch", F.window("ts", "1 hour").start)


W = S.with_snps

# ----------------------------------------------------------------------------
# Scans, codecs, routing (S3, S8, S9) and predicates
# ----------------------------------------------------------------------------


@query("filter_valid_snps", W() + "SELECT snp_id, chromosome, position, genotype FROM snps WHERE has_snp")
def q_filter_valid(spark, d):
    n = nest_snp(load_snps(spark, d))
    return (n.filter(G.has_snp_data("snp_data"))
            .select("snp_id", "snp_data.chromosome", "snp_data.position", "snp_data.genotype"))


@query("filter_completion_tokens", W() + "SELECT snp_id, family_id FROM snps WHERE NOT has_snp")
def q_tokens(spark, d):
    n = nest_snp(load_snps(spark, d))
    return n.filter(G.is_completion_token("message_type")).select("snp_id", "family_id")


@query("flatten_snp", W() + """SELECT snp_id, family_id, member_type, person_id,
  CASE WHEN has_snp THEN chromosome END AS chromosome, CASE WHEN has_snp THEN position END AS position,
  CASE WHEN has_snp THEN genotype END AS genotype FROM snps""")
def q_flatten(spark, d):
    return C.flatten_snp(nest_snp(load_snps(spark, d))).select(
        "snp_id", "family_id", "member_type", "person_id", "chromosome", "position", "genotype")


@query("parse_snp_json", W() + """SELECT snp_id, family_id, member_type, person_id, gender,
  CASE WHEN has_snp THEN chromosome END AS chromosome, CASE WHEN has_snp THEN position END AS position,
  CASE WHEN has_snp THEN genotype END AS genotype,
  CASE WHEN NOT has_snp THEN 'FAMILY_COMPLETE' END AS message_type, ts FROM snps""")
def q_parse_json(spark, d):
    msgs = C.encode_snp_json(C.to_message(nest_snp(load_snps(spark, d))), key_col="snp_id")
    parsed = C.parse_snp_json(msgs)
    return C.flatten_snp(parsed).select(
        F.col("key").cast("long").alias("snp_id"), "family_id", "member_type", "person_id", "gender",
        "chromosome", "position", "genotype", "message_type",
        F.to_timestamp_ntz(F.col("timestamp")).alias("ts"))


@query("route_by_member", W() + """SELECT snp_id, CASE WHEN NOT has_snp THEN 'children'
  WHEN member_type = 'father' THEN 'fathers' WHEN member_type = 'mother' THEN 'mothers'
  WHEN member_type = 'child' THEN 'children' END AS topic FROM snps
  WHERE NOT has_snp OR member_type IN ('father', 'mother', 'child')""")
def q_route(spark, d):
    return C.route_by_member(load_snps(spark, d)).select("snp_id", "topic")


@query("normalize_chromosome", W() + f"SELECT snp_id, chromosome, {S.norm_chrom('chromosome')} AS chromosome_norm FROM snps")
def q_norm(spark, d):
    return load_snps(spark, d).select(
        "snp_id", "chromosome", G.normalize_chromosome("chromosome").alias("chromosome_norm"))


@query("classify_genotype", W() + f"SELECT snp_id, genotype, {S.classify('genotype')} AS genotype_class FROM snps WHERE has_snp")
def q_classify(spark, d):
    return load_snps(spark, d).filter("has_snp").select(
        "snp_id", "genotype", G.classify_genotype("genotype").alias("genotype_class"))


@query("genotype_orientation", W() + f"SELECT snp_id, gt_num, {S.orientation_vcf('gt_num')} AS orientation FROM snps WHERE has_snp")
def q_orient(spark, d):
    return load_snps(spark, d).filter("has_snp").select(
        "snp_id", "gt_num", G.genotype_orientation("gt_num").alias("orientation"))


@query("zygosity", W() + """SELECT snp_id, genotype, CASE WHEN genotype IS NULL OR length(genotype) <> 2 THEN NULL
  WHEN substr(genotype,1,1) = substr(genotype,2,1) THEN 'homozygous' ELSE 'heterozygous' END AS zygosity
  FROM snps WHERE has_snp""")
def q_zyg(spark, d):
    return load_snps(spark, d).filter("has_snp").select(
        "snp_id", "genotype", G.zygosity("genotype").alias("zygosity"))


@query("genetic_record", W(*S.annotated_cte()) + f"""SELECT snp_id, 'SNP' AS variant_type, gene,
  {S.bucket('genotype', '0/0')} AS record_genotype, chromosome AS record_chromosome,
  coalesce(position, 0) AS record_position, 99 AS quality FROM ann""")
def q_record(spark, d):
    r = GEN.genetic_record(load_snps(spark, d).filter("has_snp"))
    return r.select("snp_id", "variant_type", "gene", "record_genotype", "record_chromosome",
                    "record_position", "quality")


@query("person_key", W() + """SELECT snp_id, person_id,
  CASE member_type WHEN 'father' THEN family_id || '_F' WHEN 'mother' THEN family_id || '_M'
   ELSE family_id || '_C' || regexp_extract(person_id, '_C([0-9]+)$', 1) END AS rebuilt_key,
  member_type AS role, regexp_extract(person_id, '^(.*)_(F|M|C[0-9]+)$', 1) AS family_of
  FROM snps WHERE person_id IS NOT NULL""")
def q_person_key(spark, d):
    s = load_snps(spark, d).filter(F.col("person_id").isNotNull())
    return s.select(
        "snp_id", "person_id",
        G.person_key("family_id", "member_type", G.child_number("person_id")).alias("rebuilt_key"),
        G.person_role("person_id").alias("role"), G.family_of("person_id").alias("family_of"))


@query("variant_type", W() + "SELECT snp_id, 'SNP' AS variant_type FROM snps WHERE has_snp")
def q_variant_type(spark, d):
    return load_snps(spark, d).filter("has_snp").select("snp_id", G.variant_type().alias("variant_type"))


@query("encode_snp_json", W() + """SELECT snp_id, CAST(to_json(struct_pack(family_id := family_id,
  member_type := member_type, person_id := person_id, gender := gender,
  snp_data := CASE WHEN has_snp THEN struct_pack(chromosome := chromosome, position := position, genotype := genotype) END,
  timestamp := strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
  message_type := CASE WHEN NOT has_snp THEN 'FAMILY_COMPLETE' END)) AS VARCHAR) AS value FROM snps""")
def q_encode(spark, d):
    enc = C.encode_snp_json(C.to_message(nest_snp(load_snps(spark, d))), key_col="snp_id")
    return enc.select(F.col("key").cast("long").alias("snp_id"), "value")
