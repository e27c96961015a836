"""Readers, JSON codec, routing."""
import os
import tempfile

from pyspark.sql import functions as F

from allelic.sources import codec as C
from allelic.streaming.runner import messages_to_snps


def test_corrupt_json_is_not_a_family_completion(spark):
    lines = ['garbage', '{"family_id": "F1", "message_type": "FAMILY_COMPLETE", "total_members": 5, '
             '"snps_per_member": {"father": 3, "mother": 2, "children": [1, 2]}, "timestamp": "2024-01-01T00:00:00"}',
             '{"family_id": "F1", "member_type": "child", "person_id": "F1_C1", '
             '"snp_data": {"chromosome": "chr7", "position": 55000001, "genotype": "AG"}, "timestamp": "2024-01-01T00:00:01"}',
             '{"family_id": "F2"}']
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    kinds = [r.kind for r in C.message_kind(C.parse_snp_json(raw)).collect()]
    assert kinds == ["corrupt", "token", "snp", "corrupt"]
    tok = C.parse_snp_json(raw).filter(F.col("message_type") == "FAMILY_COMPLETE").first()
    assert tok.total_members == 5 and tok.snps_per_member.children == [1, 2]
    snps = messages_to_snps(raw).collect()
    assert [r.has_snp for r in snps] == [False, False, True, False]
    assert snps[2].chromosome == "chr7" and snps[2].position == 55000001


def test_json_round_trip(spark, snps01):
    from allelic.sources.fixture import nest_snp
    nested = nest_snp(snps01)
    enc = C.encode_snp_json(C.to_message(nested), key_col="snp_id")
    back = C.flatten_snp(C.parse_snp_json(enc)).select(
        F.col("key").cast("long").alias("snp_id"), "chromosome", "position", "genotype")
    ref = C.flatten_snp(nested).select("snp_id", "chromosome", "position", "genotype")
    assert back.exceptAll(ref).count() == 0 and ref.exceptAll(back).count() == 0


def test_route_by_member(spark, snps01):
    r = {x.topic: x["count"] for x in C.route_by_member(snps01).groupBy("topic").count().collect()}
    assert sum(r.values()) == 10000 and set(r) == {"fathers", "mothers", "children"}
    assert r["children"] == 5949 + 104 and r["fathers"] == 2004


def test_read_genome_csv(spark):
    d = tempfile.mkdtemp(prefix="allelic-csv-")
    with open(os.path.join(d, "father.csv"), "w") as f:
        f.write("# rsid,chromosome,position,genotype\nrs1,1,100,AG\ni99,X,abc,--\nrs3,MT,7,CC\n")
    df = C.read_genome(spark, d)
    rows = sorted((r.rsid, r.chromosome, r.position, r.genotype, r.genome) for r in df.collect())
    assert rows == [("i99", "X", None, "--", "father"), ("rs1", "1", 100, "AG", "father"),
                    ("rs3", "MT", 7, "CC", "father")]
    assert C.read_genome(spark, d, rsid_only=True).count() == 2


def test_publish_messages_by_topic(spark, snps01):
    from allelic.sources.fixture import nest_snp
    d = tempfile.mkdtemp(prefix="allelic-pub-")
    msgs = C.to_message(nest_snp(snps01)).join(snps01.select("snp_id", "has_snp"), "snp_id")
    C.publish_messages(msgs, d, fmt="text", key_col="snp_id")
    back = spark.read.text(d)
    counts = {r.topic: r["count"] for r in back.groupBy("topic").count().collect()}
    assert counts == {"fathers": 2004, "mothers": 1943, "children": 5949 + 104}
    kinds = C.message_kind(C.parse_snp_json(back.filter(F.col("topic") == "children")))
    assert kinds.filter(F.col("kind") == "token").count() == 104


def test_stamp_ingest_time_is_constant_per_query(spark):
    df = C.stamp_ingest_time(spark.range(1000))
    assert df.select("processed_at").distinct().count() == 1
