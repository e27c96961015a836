"""Readers, JSON codec and topic routing.

All of it is per-row projection: ``from_json``/``to_json`` are native
expressions, so parsing runs inside whole-stage codegen on the executors
that read the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allelic.schemas import GENOME_CSV_SCHEMA, MEMBER_TOPICS, MESSAGE_SCHEMA

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


# --- S1 -----------------------------------------------------------------------
def read_genome(spark: SparkSession, path: str, *, rsid_only: bool = False) -> DataFrame:
    """Genome CSV(s) with header (``# rsid``, chromosome, position,
    genotype); every column read as text, ``position`` cast to int, and
    the source file name as ``genome``.  ``rsid_only`` keeps dbSNP ids."""
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .schema(GENOME_CSV_SCHEMA).csv(path))
    df = raw.select(
        F.col("`# rsid`").alias("rsid"), "chromosome",
        F.col("position").try_cast("int").alias("position"), "genotype",
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("genome"))
    if rsid_only:
        df = df.filter(F.col("rsid").startswith("rs"))
    return df


# --- S2 / S10 -------------------------------------------------------------------
def read_snp_stream(spark: SparkSession, source: str, fmt: str = "kafka", *,
                    topics: str | None = None, max_per_trigger: int | None = None,
                    schema: T.StructType | None = None, options: dict | None = None,
                    fail_on_data_loss: bool = True) -> DataFrame:
    """Streaming DataFrame of raw messages with a string ``value``.

    ``fmt='kafka'``: ``source`` is the bootstrap servers, ``topics`` the
    comma-separated subscription (all member topics in one query);
    ``maxOffsetsPerTrigger`` caps a batch; offsets that are gone fail the query
    unless ``fail_on_data_loss`` is False.  The connector jar is not part of
    this environment, so this branch is untested here.
    ``fmt='text'``/``'json'``: a folder of files, one message per line;
    ``maxFilesPerTrigger`` caps a batch.  ``fmt='parquet'``: a folder of
    already-flattened rows with ``schema``.
    """
    r = spark.readStream
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if fmt == "kafka":
        r = (r.format("kafka").option("kafka.bootstrap.servers", source)
             .option("subscribe", topics or ",".join(MEMBER_TOPICS.values()))
             .option("startingOffsets", "latest").option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return r.load().select(F.col("key").cast("string").alias("key"),
                               F.col("value").cast("string").alias("value"), "topic")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    if fmt in ("text", "json"):
        return r.format("text").load(source).select(
            F.lit(None).cast("string").alias("key"), F.col("value"),
            F.lit(None).cast("string").alias("topic"))
    if fmt == "parquet":
        return r.schema(schema).parquet(source)
    raise ValueError(f"unsupported stream format {fmt!r}")


# --- S3 / S4 ----------------------------------------------------------------------
def parse_snp_json(df: DataFrame, schema: T.StructType = MESSAGE_SCHEMA,
                   value_col: str = "value") -> DataFrame:
    """JSON text -> message fields (PERMISSIVE: text that is not JSON keeps
    all fields NULL and lands in ``_corrupt_record``)."""
    data = F.from_json(F.col(value_col).cast("string"), schema,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    keep = [c for c in df.columns if c != value_col]
    return df.select(*keep, data.alias("_m")).select(*keep, "_m.*")


def stamp_ingest_time(df: DataFrame) -> DataFrame:
    """Processing time of the micro-batch (constant within one batch)."""
    return df.withColumn("processed_at", F.current_timestamp())


def flatten_snp(df: DataFrame) -> DataFrame:
    """``snp_data.*`` as top-level columns (nested-column pruning
    applies when the source is Parquet)."""
    rest = [c for c in df.columns if c != "snp_data"]
    return df.select(*rest, F.col("snp_data.chromosome").alias("chromosome"),
                     F.col("snp_data.position").alias("position"),
                     F.col("snp_data.genotype").alias("genotype"))


def message_kind(df: DataFrame) -> DataFrame:
    """Classify parsed messages: ``snp``, ``token`` or ``corrupt``.  A token
    needs ``message_type='FAMILY_COMPLETE'``; a corrupt line is never
    taken for a finished family."""
    kind = (F.when(F.col("_corrupt_record").isNotNull(), "corrupt")
            .when(F.col("message_type") == "FAMILY_COMPLETE", "token")
            .when(F.col("snp_data").isNotNull(), "snp").otherwise("corrupt"))
    return df.withColumn("kind", kind)


# --- S8 / S9 ----------------------------------------------------------------------
def to_message(nested: DataFrame) -> DataFrame:
    """Nested SNP rows -> wire message columns (ISO event-time text)."""
    return nested.select(
        "snp_id", "family_id", "member_type", "person_id", "gender",
        "snp_data", F.date_format("ts", ISO_TS).alias("timestamp"), "message_type")


def encode_snp_json(df: DataFrame, key_col: str | None = None, include_nulls: bool = True) -> DataFrame:
    """Row -> UTF-8 JSON ``value`` (and a string ``key`` when given).  Every
    field is written, NULL as ``null``, as the producer's messages do."""
    cols = [c for c in df.columns if c != key_col]
    opts = {"ignoreNullFields": "false" if include_nulls else "true"}
    out = [F.to_json(F.struct(*cols), opts).alias("value")]
    if key_col:
        out.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*out)


def route_by_member(df: DataFrame) -> DataFrame:
    """Topic per row: father -> fathers, mother -> mothers, child ->
    children; completion tokens go to children; other rows are dropped."""
    m = F.col("member_type")
    topic = (F.when(~F.col("has_snp"), F.lit(MEMBER_TOPICS["child"]))
             .when(m == "father", MEMBER_TOPICS["father"])
             .when(m == "mother", MEMBER_TOPICS["mother"])
             .when(m == "child", MEMBER_TOPICS["child"]))
    return df.withColumn("topic", topic).filter(F.col("topic").isNotNull())


def publish_messages(df: DataFrame, target: str, fmt: str = "kafka", *,
                     key_col: str | None = None, mode: str = "append") -> None:
    """S9 sink: route rows to their member topic and write them as JSON
    messages.  ``fmt='kafka'`` writes to the brokers in ``target`` (the
    Kafka sink reads the per-row ``topic`` column; untested here, the jar
    is absent); ``fmt='text'`` writes one folder per topic under
    ``target``.  ``df`` has the nested message columns plus ``has_snp``."""
    routed = route_by_member(df)
    msg_cols = [c for c in routed.columns if c not in ("topic", "has_snp")]
    enc = routed.select("topic", *([F.col(key_col).cast("string").alias("key")] if key_col else []),
                        F.to_json(F.struct(*[c for c in msg_cols if c != key_col]),
                                  {"ignoreNullFields": "false"}).alias("value"))
    if fmt == "kafka":
        enc.write.format("kafka").option("kafka.bootstrap.servers", target).mode(mode).save()
    elif fmt == "text":
        enc.select("topic", "value").write.mode(mode).partitionBy("topic").text(target)
    else:
        raise ValueError(f"unsupported sink format {fmt!r}")
