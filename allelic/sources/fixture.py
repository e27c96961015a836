"""Stand-in SNP input built from the driver's ``events`` table.

There is no genome data among the test tables, so FIXTURES section 3 fixes
a deterministic mapping from ``events`` to rows of the flattened SNP schema.
This module only produces rows in that schema; it does none of any
operator's work.  Every operator must be right on any data of the schema.

The mapping is a pure per-row projection (no shuffle), so it streams at
scan speed and keeps the ``events`` scan's column pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# FIXTURES section 3 (Spark flavour), as three projection stages.  Written
# as SQL expression text: one JVM-side parse per stage instead of hundreds
# of py4j Column calls, and the text stays comparable with the DuckDB form.
_STAGE_E = [
    "event_id AS e", "ts", "user_id AS u", "CAST(FLOOR(value*100) AS BIGINT) AS v",
    "CAST(get_json_object(props,'$.k') AS BIGINT) AS k",
]
_STAGE_B = [
    "*", "CAST(FLOOR(u/5.0) AS BIGINT) AS fam", "u % 5 AS slot",
    "CAST((e*7 + k) % 25 AS INT) AS ci", "CAST((e*31 + v) % 17 AS INT) AS gi",
]
_FAM = "CONCAT('FAM_', LPAD(CAST(fam AS VARCHAR(32)), 6, '0'))"
_STAGE_S = [
    "e AS snp_id", "ts",
    f"{_FAM} AS family_id",
    "CASE slot WHEN 0 THEN 'father' WHEN 1 THEN 'mother' ELSE 'child' END AS member_type",
    f"CASE WHEN e % 211 = 5 THEN NULL ELSE CONCAT({_FAM}, CASE slot WHEN 0 THEN '_F' WHEN 1 THEN '_M' "
    "ELSE CONCAT('_C', CAST(slot-1 AS VARCHAR(32))) END) END AS person_id",
    "CASE slot WHEN 1 THEN 'Female' ELSE 'Male' END AS gender",
    "CASE WHEN e % 97 = 0 THEN FALSE ELSE TRUE END AS has_snp",
    "CASE WHEN e % 97 = 0 OR e % 331 = 7 THEN NULL WHEN ci = 22 THEN 'X' WHEN ci = 23 THEN 'Y' "
    "WHEN ci = 24 THEN 'MT' WHEN e % 13 = 0 THEN CONCAT('chr', CAST(ci+1 AS VARCHAR(32))) "
    "ELSE CAST(ci+1 AS VARCHAR(32)) END AS chromosome",
    "CASE WHEN e % 97 = 0 OR e % 401 = 9 THEN NULL WHEN ci = 24 THEN CAST(1 + v % 16569 AS INT) "
    "ELSE CAST((k*5 + e % 5)*500000 + (e % 2)*200000 AS INT) END AS position",
    "CASE WHEN e % 97 = 0 THEN NULL WHEN gi < 2 THEN 'AA' WHEN gi = 2 THEN 'CC' WHEN gi = 3 THEN 'GG' "
    "WHEN gi = 4 THEN 'TT' WHEN gi IN (5,6) THEN 'AG' WHEN gi IN (7,8) THEN 'CT' WHEN gi = 9 THEN 'AC' "
    "WHEN gi = 10 THEN 'GT' WHEN gi = 11 THEN 'aa' WHEN gi = 12 THEN 'Aa' WHEN gi = 13 THEN '--' "
    "WHEN gi = 14 THEN 'A' WHEN gi = 15 THEN '' ELSE NULL END AS genotype",
    "CASE WHEN e % 97 = 0 THEN NULL WHEN gi < 6 THEN '0/0' WHEN gi < 11 THEN '0/1' WHEN gi < 14 THEN '1/1' "
    "WHEN gi = 14 THEN '1/2' WHEN gi = 15 THEN 'Unknown' ELSE 'AG' END AS gt_num",
]


def snps_from_events(events: DataFrame) -> DataFrame:
    """FIXTURES section 3: ``events`` -> ``snps`` (one row per event)."""
    return events.selectExpr(*_STAGE_E).selectExpr(*_STAGE_B).selectExpr(*_STAGE_S)


def nest_snp(snps: DataFrame) -> DataFrame:
    """Nested message form: ``snp_data`` struct, NULL for token rows."""
    snp_data = F.when(F.col("has_snp"),
                      F.struct("chromosome", "position", "genotype"))
    return snps.select(
        "snp_id", "ts", "family_id", "member_type", "person_id", "gender",
        snp_data.alias("snp_data"),
        F.when(~F.col("has_snp"), F.lit("FAMILY_COMPLETE")).alias("message_type"),
    )


# DuckDB text of the same mapping, for oracle SQL (FIXTURES section 3 with
# the DuckDB tokens filled in).
SNPS_DUCKDB_SQL = """
WITH e AS (SELECT event_id AS e, ts, user_id AS u, CAST(FLOOR(value*100) AS BIGINT) AS v,
                  CAST(json_extract_string(props,'$.k') AS BIGINT) AS k FROM events),
b AS (SELECT *, CAST(FLOOR(u/5.0) AS BIGINT) AS fam, u % 5 AS slot,
             CAST((e*7 + k) % 25 AS INT) AS ci, CAST((e*31 + v) % 17 AS INT) AS gi FROM e)
SELECT e AS snp_id, ts,
 CONCAT('FAM_', LPAD(CAST(fam AS VARCHAR), 6, '0')) AS family_id,
 CASE slot WHEN 0 THEN 'father' WHEN 1 THEN 'mother' ELSE 'child' END AS member_type,
 CASE WHEN e % 211 = 5 THEN NULL ELSE CONCAT('FAM_', LPAD(CAST(fam AS VARCHAR), 6, '0'),
   CASE slot WHEN 0 THEN '_F' WHEN 1 THEN '_M' ELSE CONCAT('_C', CAST(slot-1 AS VARCHAR)) END) END AS person_id,
 CASE slot WHEN 1 THEN 'Female' ELSE 'Male' END AS gender,
 CASE WHEN e % 97 = 0 THEN FALSE ELSE TRUE END AS has_snp,
 CASE WHEN e % 97 = 0 OR e % 331 = 7 THEN NULL WHEN ci = 22 THEN 'X' WHEN ci = 23 THEN 'Y'
      WHEN ci = 24 THEN 'MT' WHEN e % 13 = 0 THEN CONCAT('chr', CAST(ci+1 AS VARCHAR))
      ELSE CAST(ci+1 AS VARCHAR) END AS chromosome,
 CASE WHEN e % 97 = 0 OR e % 401 = 9 THEN NULL WHEN ci = 24 THEN CAST(1 + v % 16569 AS INT)
      ELSE CAST((k*5 + e % 5)*500000 + (e % 2)*200000 AS INT) END AS position,
 CASE WHEN e % 97 = 0 THEN NULL WHEN gi < 2 THEN 'AA' WHEN gi = 2 THEN 'CC' WHEN gi = 3 THEN 'GG'
      WHEN gi = 4 THEN 'TT' WHEN gi IN (5,6) THEN 'AG' WHEN gi IN (7,8) THEN 'CT' WHEN gi = 9 THEN 'AC'
      WHEN gi = 10 THEN 'GT' WHEN gi = 11 THEN 'aa' WHEN gi = 12 THEN 'Aa' WHEN gi = 13 THEN '--'
      WHEN gi = 14 THEN 'A' WHEN gi = 15 THEN '' ELSE NULL END AS genotype,
 CASE WHEN e % 97 = 0 THEN NULL WHEN gi < 6 THEN '0/0' WHEN gi < 11 THEN '0/1' WHEN gi < 14 THEN '1/1'
      WHEN gi = 14 THEN '1/2' WHEN gi = 15 THEN 'Unknown' ELSE 'AG' END AS gt_num
FROM b
"""
