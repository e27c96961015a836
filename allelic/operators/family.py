"""Family-level statistics, trios and relatedness.

Per-family outputs are always built in two hash-aggregation steps:
rows -> (family, person) counts -> family.  Trio and relatedness operators
join the calls of a family and locus row by row; how many there may be is
checked (``MOST_MEMBERS``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelic.functions.genotype import normalize_chromosome
from allelic.operators.metrics import epoch_us

MEMBER = "member_type"


def _person_counts(df: DataFrame) -> DataFrame:
    persons = df.filter(F.col("person_id").isNotNull() & F.col("family_id").isNotNull())
    return persons.groupBy("family_id", "person_id", MEMBER, "gender").agg(
        F.count_if(F.col("has_snp")).alias("snps"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


# --- A16 -------------------------------------------------------------------------
def family_stats(df: DataFrame, member_type: str | None = None) -> DataFrame:
    """Per family: members (person x member-type rows), unique persons,
    avg / max / min SNPs per person, sorted distinct genders, and the total
    number of families (scalar subquery)."""
    src = df if member_type is None else df.filter(F.col(MEMBER) == member_type)
    p = _person_counts(src)
    fam = p.groupBy("family_id").agg(
        F.count(F.lit(1)).alias("members_count"),
        F.count_distinct("person_id").alias("unique_persons"),
        F.round(F.avg("snps"), 4).alias("avg_snps"),
        F.max("snps").alias("max_snps"),
        F.min("snps").alias("min_snps"),
        F.array_sort(F.collect_set("gender")).alias("genders"))
    # the total reads the same family table; its exchange is reused
    total = fam.select(F.count(F.lit(1))).scalar()
    return fam.withColumn("total_families", total)


# --- A17 -------------------------------------------------------------------------
def family_completion_summary(df: DataFrame) -> DataFrame:
    """The family-completion token rebuilt from the SNP rows: members,
    children, total SNPs, SNPs of the father, the mother and each child
    (ordered by person id), first and last event time and the duration."""
    p = _person_counts(df)
    child = F.col(MEMBER) == "child"
    fam = p.groupBy("family_id").agg(
        F.count(F.lit(1)).alias("total_members"),
        F.count_if(child).alias("num_children"),
        F.sum("snps").cast("long").alias("total_snps"),
        F.sum(F.when(F.col(MEMBER) == "father", F.col("snps"))).cast("long").alias("father_snps"),
        F.sum(F.when(F.col(MEMBER) == "mother", F.col("snps"))).cast("long").alias("mother_snps"),
        F.sort_array(F.collect_list(F.when(child, F.struct("person_id", "snps")))).alias("_kids"),
        F.min("first_ts").alias("generation_start"),
        F.max("last_ts").alias("generation_end"))
    return fam.select(
        "family_id", "total_members", "num_children", "total_snps", "father_snps", "mother_snps",
        F.transform("_kids", lambda s: s["snps"]).alias("children_snps"),
        "generation_start", "generation_end",
        ((F.unix_micros(F.col("generation_end").cast("timestamp"))
          - F.unix_micros(F.col("generation_start").cast("timestamp"))) / 1e6)
        .alias("generation_duration_secs"))


def check_tokens(tokens: DataFrame, snps: DataFrame) -> DataFrame:
    """Completion tokens against the family's rows (A17): per token the stated
    and the counted members, children and SNPs, and whether they agree.  A
    family without rows counts none; a field the token lacks agrees with none.
    ``tokens``: family_id, total_members, num_children, snps_per_member."""
    summary = family_completion_summary(snps.filter(F.col("has_snp")))
    counted = summary.select(F.col("family_id").alias("_f"), "total_members", "num_children", "total_snps")
    return tokens_agree(stated_tokens(tokens).join(counted, F.col("family_id") == F.col("_f"), "left").drop("_f"))


def stated_tokens(tokens: DataFrame, *keep: str) -> DataFrame:
    """What a family's token states: members, children and SNPs."""
    return tokens.select(
        "family_id", *keep, F.col("total_members").cast("long").alias("stated_members"),
        F.col("num_children").cast("long").alias("stated_children"),
        (F.col("snps_per_member.father") + F.col("snps_per_member.mother")
         + F.aggregate("snps_per_member.children", F.lit(0), lambda a, x: a + x)).cast("long").alias("stated_snps"))


def tokens_agree(x: DataFrame) -> DataFrame:
    """``agrees`` for what tokens state against what was counted; no rows count 0."""
    x = x.fillna(0, ["total_members", "num_children", "total_snps"])
    agree = ((F.col("stated_members") == F.col("total_members")) & (F.col("stated_children") == F.col("num_children"))
             & (F.col("stated_snps") == F.col("total_snps")))
    return x.withColumn("agrees", F.coalesce(agree, F.lit(False)))


# --- A18 -------------------------------------------------------------------------
def ingest_statistics(df: DataFrame) -> DataFrame:
    """Families, SNPs sent and SNPs per family (divisor at least 1)."""
    a = df.agg(F.count_distinct("family_id").alias("families"),
               F.count_if(F.col("has_snp")).alias("total_snps"))
    return a.withColumn("avg_snps_per_family",
                        F.round(F.col("total_snps").cast("double")
                                / F.greatest(F.col("families"), F.lit(1)).cast("double"), 2))


# --- J2 / D1 / D2 -----------------------------------------------------------------
#: Calls of one family and locus (of a trio: fathers', mothers', children's each) that are paired, unless the caller allows more.
MOST_MEMBERS = 1000


def _bounded(calls: DataFrame, most_members: int) -> DataFrame:
    """Calls with a family and a locus; an error if a family has more calls at
    a locus than ``most_members``.  Trios and pairs grow with the square of a
    family, so an id that stands for "unknown" must be taken out by the
    caller, who alone can tell, and is not paired in silence.

    The calls are counted where they lie for the join on (family_id, locus),
    in its partitions and order."""
    known = calls.filter(F.col("family_id").isNotNull() & F.col("locus").isNotNull())
    n = F.count(F.lit(1)).over(Window.partitionBy("family_id", "locus"))
    message = F.concat(F.lit("family "), F.col("family_id").cast("string"), F.lit(" has "), n.cast("string"),
                       F.lit(f" calls at a locus, more than most_members = {most_members}"))
    return (known.withColumn("_checked", F.when(n > most_members, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
            .filter("_checked").drop("_checked"))


def trio_join(calls: DataFrame, *, most_members: int = MOST_MEMBERS) -> DataFrame:
    """Child call with a father's and a mother's call at the same
    (family_id, locus); children without both parents' calls are dropped, and
    two fathers give two rows (inner-join semantics).  ``calls``: family_id,
    person_id, member_type, locus, genotype with one call per person and locus.

    Two equi joins on (family_id, locus): the calls of a locus are rows all
    the way, and a family with many loci is as many keys."""
    def of(member: str) -> DataFrame:
        return _bounded(calls.filter(F.col(MEMBER) == member), most_members).select(
            "family_id", "locus", F.col("person_id").alias(f"{member}_id"), F.col("genotype").alias(f"{member}_gt"))
    return of("child").join(of("father"), ["family_id", "locus"]).join(of("mother"), ["family_id", "locus"])


def _alleles_in(allele: Column, gt: Column) -> Column:
    return (allele == F.substring(gt, 1, 1)) | (allele == F.substring(gt, 2, 1))


def mendel_consistent(child_gt: Column, father_gt: Column, mother_gt: Column) -> Column:
    """Child ``ab`` is consistent iff (a from father and b from mother) or
    (b from father and a from mother)."""
    a, b = F.substring(child_gt, 1, 1), F.substring(child_gt, 2, 1)
    return ((_alleles_in(a, father_gt) & _alleles_in(b, mother_gt))
            | (_alleles_in(b, father_gt) & _alleles_in(a, mother_gt)))


def mendelian_consistency(calls: DataFrame, *, most_members: int = MOST_MEMBERS) -> DataFrame:
    """Per family, trios (child x locus with both parents), consistent
    trios and their share."""
    t = trio_join(calls, most_members=most_members).withColumn(
        "_ok", mendel_consistent(F.col("child_gt"), F.col("father_gt"), F.col("mother_gt")))
    a = t.groupBy("family_id").agg(F.count(F.lit(1)).alias("trios"),
                                   F.count_if("_ok").alias("consistent"))
    return a.withColumn("consistent_share",
                        F.round(F.col("consistent").cast("double") / F.col("trios").cast("double"), 4))


def ibs_shared(g1: Column, g2: Column) -> Column:
    """Alleles shared identical by state by two 2-letter genotypes: 2 when
    they are the same unordered pair, 1 when they share one allele, else 0."""
    a1, b1 = F.substring(g1, 1, 1), F.substring(g1, 2, 1)
    a2, b2 = F.substring(g2, 1, 1), F.substring(g2, 2, 1)
    same = ((a1 == a2) & (b1 == b2)) | ((a1 == b2) & (b1 == a2))
    one = (a1 == a2) | (a1 == b2) | (b1 == a2) | (b1 == b2)
    return F.when(same, 2).when(one, 1).otherwise(0)


def genetic_similarity(calls: DataFrame, *, most_members: int = MOST_MEMBERS) -> DataFrame:
    """Identity-by-state similarity of the pairs of each family
    (father-mother, father-child, mother-child, siblings with the smaller
    person id first): the mean of shared alleles / 2 over the loci both
    persons have.

    The calls meet themselves in one equi join on (family_id, locus), whose
    two sides are the same exchange; the pairs of a locus go into the partial
    sums of their persons at once."""
    role = F.when(F.col(MEMBER) == "father", 0).when(F.col(MEMBER) == "mother", 1).when(F.col(MEMBER) == "child", 2)
    def side(x: DataFrame, name: str) -> DataFrame:
        return x.select("family_id", "locus", "person_id", "genotype", role.alias("role")).alias(name)
    a, b = side(_bounded(calls, most_members), "a"), side(calls, "b")
    siblings = (F.col("a.role") == 2) & (F.col("b.role") == 2) & (F.col("a.person_id") < F.col("b.person_id"))
    pairs = a.join(b, (F.col("a.family_id") == F.col("b.family_id")) & (F.col("a.locus") == F.col("b.locus"))
                   & ((F.col("a.role") < F.col("b.role")) | siblings))
    relation = (F.when(F.col("a.role") == 2, "siblings").when(F.col("a.role") == 1, "mother-child")
                .when(F.col("b.role") == 1, "father-mother").otherwise("father-child"))
    shared = ibs_shared(F.col("a.genotype"), F.col("b.genotype"))
    return (pairs.groupBy(F.col("a.family_id").alias("family_id"), relation.alias("relation"),
                          F.col("a.person_id").alias("person_a"), F.col("b.person_id").alias("person_b"))
            .agg(F.count(F.lit(1)).alias("loci"), F.round(F.avg(shared / 2.0), 4).alias("similarity")))


def locus_key() -> Column:
    """Normalised chromosome and position; NULL when either is NULL."""
    return F.when(F.col("chromosome").isNotNull() & F.col("position").isNotNull(),
                  F.concat(normalize_chromosome("chromosome"), F.lit(":"), F.col("position").cast("string")))


#: Behind all ids, which have 64 bits, and all times, counted in microseconds.
_BEHIND = Decimal(2 ** 64)
#: Two-letter genotypes in order, one a space apart; a genotype's code is its place here.
_GENOTYPES = " ".join(a + b for a in "ACGT" for b in "ACGT")


def genotype_calls(snps: DataFrame, locus: Column | None = None) -> DataFrame:
    """One call per (family, person, locus): the genotype of the first SNP
    row (smallest ``snp_id``; rows without an id by time, rows without a time
    last; equals by the smaller genotype) among 2-letter A/C/G/T genotypes.
    Rows without a family, person or locus make no call.  ``locus`` (text):
    by default ``locus_key()``.

    Order and genotype are one number whose minimum a hash aggregate keeps:
    the id, behind all ids the time, behind all times nothing, above the
    genotype's place in a list."""
    text = F.coalesce((locus_key() if locus is None else locus).cast("string"), F.lit(""))
    v = snps.filter(F.col("has_snp") & F.col("person_id").isNotNull() & F.col("family_id").isNotNull())
    place = [F.lit(_BEHIND * 2)]
    if "ts" in v.columns:
        place.insert(0, epoch_us("ts").cast("decimal(20,0)") + F.lit(_BEHIND))
    if "snp_id" in v.columns:
        place.insert(0, F.col("snp_id").cast("long").cast("decimal(20,0)"))
    # other genotypes have no code, so they are never the first
    place_of = F.instr(F.lit(_GENOTYPES), F.col("genotype"))
    code = F.when((F.length("genotype") == 2) & (place_of % 3 == 1), place_of)
    first = F.min((F.coalesce(*place).cast("decimal(22,0)") * 1000 + code).cast("decimal(38,0)"))
    # one test on the result, where it costs a look at a group, instead of two on each raw row
    call = F.when(F.col("locus") != "", F.substring(
        F.lit(_GENOTYPES), F.pmod(F.col("_first"), F.lit(1000)).cast("int"), F.lit(2)))
    return (v.groupBy("family_id", "person_id", MEMBER, text.alias("locus")).agg(first.alias("_first"))
            .select("family_id", "person_id", MEMBER, "locus", call.alias("genotype")).filter(F.col("genotype").isNotNull()))
