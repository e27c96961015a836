"""Scalar Column expressions.

All are native Catalyst expressions: they stay inside whole-stage codegen,
need no Python worker and work unchanged on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P4 -----------------------------------------------------------------------
def normalize_chromosome(c: ColumnOrName) -> Column:
    """NULL stays NULL; otherwise upper-case and delete every ``CHR``."""
    return F.replace(F.upper(_c(c)), F.lit("CHR"), F.lit(""))


# --- P6 / P7 / P13 ------------------------------------------------------------
def variant_type() -> Column:
    """Every record is a single-nucleotide variant."""
    return F.lit("SNP")


def bucket(c: ColumnOrName, label: str) -> Column:
    """NULL or empty text -> ``label`` (applied before grouping)."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(label))


def default_genotype(c: ColumnOrName) -> Column:
    """NULL or empty genotype -> ``'0/0'``."""
    return bucket(c, "0/0")


# --- P9 -----------------------------------------------------------------------
def classify_genotype(c: ColumnOrName) -> Column:
    """Letter genotypes: invalid / dominant / recessive / heterozygous.

    NULL, empty or length != 2 -> invalid.  Two equal characters: an
    upper-case letter -> dominant, anything else (lower case, ``-``,
    digits) -> recessive.  Two different characters -> heterozygous.
    """
    g = _c(c)
    a, b = F.substring(g, 1, 1), F.substring(g, 2, 1)
    is_upper = (a == F.upper(a)) & (a != F.lower(a))
    return (F.when(g.isNull() | (F.length(g) != 2), "invalid")
            .when(a == b, F.when(is_upper, "dominant").otherwise("recessive"))
            .otherwise("heterozygous"))


# --- P10 ----------------------------------------------------------------------
def genotype_orientation(c: ColumnOrName) -> Column:
    """VCF-style genotypes (``0/1``): recessive / dominant / heterozygous.

    ``'Unknown'``, NULL, not exactly two ``/``-separated parts, or a part
    that is not an integer -> NULL.  (0,0) recessive, (1,1) dominant,
    any other pair heterozygous.
    """
    g = _c(c)
    parts = F.split(g, "/")
    a = F.try_element_at(parts, F.lit(1)).try_cast("int")
    b = F.try_element_at(parts, F.lit(2)).try_cast("int")
    ok = (g.isNotNull() & (g != "Unknown") & (F.size(parts) == 2)
          & a.isNotNull() & b.isNotNull())
    return (F.when(~ok, F.lit(None).cast("string"))
            .when((a == 0) & (b == 0), "recessive")
            .when((a == 1) & (b == 1), "dominant")
            .otherwise("heterozygous"))


# --- P11 ----------------------------------------------------------------------
def zygosity(c: ColumnOrName) -> Column:
    """Length-2 genotypes only: equal characters -> homozygous, else
    heterozygous (case-sensitive; ``--`` is homozygous).  Other -> NULL."""
    g = _c(c)
    return (F.when(g.isNull() | (F.length(g) != 2), F.lit(None).cast("string"))
            .when(F.substring(g, 1, 1) == F.substring(g, 2, 1), "homozygous")
            .otherwise("heterozygous"))


def is_het(c: ColumnOrName) -> Column:
    """1 for a heterozygous length-2 genotype, 0 for homozygous, NULL else."""
    z = zygosity(c)
    return F.when(z == "heterozygous", 1).when(z == "homozygous", 0)


# --- P14 / P15 / P16 ------------------------------------------------------------
def rate_level(pct: ColumnOrName) -> Column:
    """Rate in percent: > 5 high, > 2 medium, else low."""
    p = _c(pct)
    return F.when(p > 5, "high").when(p > 2, "medium").otherwise("low")


def trend_direction(change_pct: ColumnOrName) -> Column:
    """Change in percent: > 5 up, < -5 down, else stable."""
    p = _c(change_pct)
    return F.when(p > 5, "up").when(p < -5, "down").otherwise("stable")


def hotspot_label(chrom: ColumnOrName, pos: ColumnOrName) -> Column:
    """``Chr{chromosome}:{position}``."""
    return F.concat(F.lit("Chr"), _c(chrom).cast("string"), F.lit(":"),
                    _c(pos).cast("string"))


# --- P17 / P18 ------------------------------------------------------------------
def is_rsid(c: ColumnOrName) -> Column:
    """Identifier starts with ``rs`` (dbSNP reference id)."""
    return _c(c).startswith("rs")


def person_key(family: ColumnOrName, member: ColumnOrName,
               child_no: ColumnOrName | None = None) -> Column:
    """``{family}_F``, ``{family}_M`` or ``{family}_C{n}``."""
    m = _c(member)
    n = F.lit(1) if child_no is None else _c(child_no)
    suffix = (F.when(m == "father", F.lit("_F")).when(m == "mother", F.lit("_M"))
              .when(m == "child", F.concat(F.lit("_C"), n.cast("string"))))
    return F.concat(_c(family), suffix)


def person_role(person_id: ColumnOrName) -> Column:
    """Inverse of :func:`person_key`: member type from the id suffix."""
    suf = F.regexp_extract(_c(person_id), r"_(F|M|C[0-9]+)$", 1)
    return (F.when(suf == "F", "father").when(suf == "M", "mother")
            .when(suf.startswith("C"), "child"))


def child_number(person_id: ColumnOrName) -> Column:
    """Child number from a ``_C{n}`` suffix, else NULL."""
    n = F.regexp_extract(_c(person_id), r"_C([0-9]+)$", 1)
    return F.when(n != "", n.cast("int"))


def family_of(person_id: ColumnOrName) -> Column:
    """Family id from a person key."""
    return F.regexp_extract(_c(person_id), r"^(.*)_(F|M|C[0-9]+)$", 1)


# --- P1 / P2 / P3 (row predicates on the nested message form) ------------------
def has_snp_data(snp_col: ColumnOrName = "snp_data") -> Column:
    return _c(snp_col).isNotNull()


def is_completion_token(message_type: ColumnOrName = "message_type") -> Column:
    return _c(message_type) == "FAMILY_COMPLETE"


def pct(part: ColumnOrName, whole: ColumnOrName, digits: int = 2, *, share_first: bool = False) -> Column:
    """Percentage as double, NULL when whole = 0: ``round(100 * part /
    whole)``, or ``round(part / whole * 100)`` with ``share_first`` (the
    two orders can differ in the last bit, so each metric uses the one the
    reference uses)."""
    w = _c(whole).cast("double")
    p = _c(part).cast("double")
    v = (p / w) * F.lit(100.0) if share_first else F.lit(100.0) * p / w
    return F.round(F.when(w != 0, v), digits)


def ratio(part: ColumnOrName, whole: ColumnOrName, digits: int = 4) -> Column:
    """``round(part / whole, digits)`` as double, NULL when whole = 0."""
    w = _c(whole).cast("double")
    return F.round(F.when(w != 0, _c(part).cast("double") / w), digits)
