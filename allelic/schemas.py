"""Schemas of the wire messages and tables, and the fixed gene table."""

from __future__ import annotations

from pyspark.sql import types as T

# --- M1: one SNP message per person x variant (JSON on the wire) -----------
SNP_DATA_TYPE = T.StructType([
    T.StructField("chromosome", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("genotype", T.StringType()),
])

SNPS_PER_MEMBER_TYPE = T.StructType([
    T.StructField("father", T.IntegerType()),
    T.StructField("mother", T.IntegerType()),
    T.StructField("children", T.ArrayType(T.IntegerType())),
])

# One schema parses both message kinds: SNP rows carry ``snp_data``;
# family-completion tokens (M2) carry ``message_type='FAMILY_COMPLETE'``
# and the token fields.  Text that is not JSON lands in _corrupt_record.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("family_id", T.StringType()),
    T.StructField("member_type", T.StringType()),
    T.StructField("person_id", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("date_created", T.StringType()),
    T.StructField("total_snps", T.IntegerType()),
    T.StructField("snp_data", SNP_DATA_TYPE),
    T.StructField("timestamp", T.StringType()),
    T.StructField("message_type", T.StringType()),
    T.StructField("total_members", T.IntegerType()),
    T.StructField("num_children", T.IntegerType()),
    T.StructField("generation_start_time", T.DoubleType()),
    T.StructField("generation_end_time", T.DoubleType()),
    T.StructField("generation_duration_secs", T.DoubleType()),
    T.StructField("snps_per_member", SNPS_PER_MEMBER_TYPE),
    T.StructField("_corrupt_record", T.StringType()),
])

# --- M3: genome CSV, one file per person ------------------------------------
# Every column is read as text (the header literally contains "# rsid");
# position is cast after reading.
GENOME_CSV_SCHEMA = T.StructType([
    T.StructField("# rsid", T.StringType()),
    T.StructField("chromosome", T.StringType()),
    T.StructField("position", T.StringType()),
    T.StructField("genotype", T.StringType()),
])

# --- flattened SNP view used by every operator (FIXTURES section 3) ---------
SNPS_COLUMNS = ["snp_id", "ts", "family_id", "member_type", "person_id",
                "gender", "has_snp", "chromosome", "position", "genotype",
                "gt_num"]

MEMBER_TYPES = ("father", "mother", "child")

# Topic of each member type on the message bus (plural), fixed values.
MEMBER_TOPICS = {"father": "fathers", "mother": "mothers", "child": "children"}

FAMILY_COMPLETE = "FAMILY_COMPLETE"

# --- M5: gene reference table -----------------------------------------------
# Gene name, chromosome, inclusive start, inclusive end, in the
# reference's list order.  List order is the priority: where intervals
# overlap, the earlier gene wins.  Chromosomes are written as text so every
# gene can match (the reference typed six of them as integers, which could
# never equal its text probe; ``strict_types=True`` reproduces that).
GENES = [
    ("BRCA1", "17", 43000000, 43500000),
    ("BRCA2", "13", 32800000, 33400000),
    ("TP53", "17", 7000000, 7600000),
    ("EGFR", "7", 55000000, 56500000),
    ("KRAS", "12", 25200000, 25400000),
    ("BRAF", "7", 140700000, 140900000),
    ("FMR1", "X", 153000000, 153500000),
    ("AR", "X", 66700000, 67000000),
    ("DMD", "X", 48700000, 48800000),
    ("SRY", "Y", 2650000, 2800000),
    ("TSPY", "Y", 9500000, 10500000),
    ("DAZ", "Y", 23500000, 24500000),
    ("RBMY", "Y", 22000000, 22500000),
    ("USP9Y", "Y", 12500000, 13000000),
    ("ZFY", "Y", 2850000, 3000000),
    ("MT-ND1", "MT", 3307, 4262),
    ("MT-ND2", "MT", 4470, 5511),
    ("MT-CO1", "MT", 5904, 7445),
    ("MT-CO2", "MT", 7586, 8269),
    ("MT-ATP8", "MT", 8366, 8572),
    ("MT-ATP6", "MT", 8527, 9207),
    ("MT-CO3", "MT", 9207, 9990),
    ("MT-ND3", "MT", 10059, 10404),
    ("MT-ND4", "MT", 10760, 12137),
    ("MT-ND5", "MT", 12337, 14148),
    ("MT-CYB", "MT", 14747, 15887),
    ("MT-ND6", "MT", 14149, 14673),
    ("MT-RNR1", "MT", 648, 1601),
    ("MT-RNR2", "MT", 1671, 3229),
]

# Genes whose chromosome the reference typed as an integer (never matched).
INT_TYPED_GENES = ("BRCA1", "BRCA2", "TP53", "EGFR", "KRAS", "BRAF")

GENE_SCHEMA = T.StructType([
    T.StructField("priority", T.IntegerType(), False),
    T.StructField("gene", T.StringType(), False),
    T.StructField("chromosome", T.StringType(), False),
    T.StructField("start", T.IntegerType(), False),
    T.StructField("end", T.IntegerType(), False),
])


def gene_rows(strict_types: bool = False) -> list[tuple]:
    """Gene table rows with their list-order priority."""
    return [(i, g, c, s, e) for i, (g, c, s, e) in enumerate(GENES)
            if not (strict_types and g in INT_TYPED_GENES)]
