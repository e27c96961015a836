"""Gene annotation: a left-outer equi + range join.

Semantics: a SNP belongs to the first gene, in gene-table order, whose
chromosome equals the SNP's normalised chromosome and whose inclusive
interval holds the position.  No hit -> ``Chr{chromosome}``; NULL
chromosome or position -> ``Unknown``.

Plan.  The "first gene wins" rule is resolved once on the small side: the
gene intervals are cut into disjoint elementary segments, each labelled
with its highest-priority covering gene.  With disjoint segments a SNP
matches at most one row, so the big side needs no post-join de-duplication
(no shuffle of the SNPs at all).  Segments are exploded into fixed-width
position bins, and the SNP side joins on ``(chromosome, bin)`` as an equi
key with the interval test as a residual condition.  That keeps every
probe to the few segments of one bin instead of all genes of a chromosome.

The annotation table is broadcast only when its row count is known to be
at most ``broadcast_limit``; otherwise the same join runs as a shuffle
join on ``(chromosome, bin)`` and AQE handles skewed bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.functions.genotype import default_genotype, normalize_chromosome, variant_type
from allelic.operators.ranks import numbered_rows
from allelic.schemas import gene_rows

DEFAULT_BIN = 1_000_000


def _values(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small constant table as an inline ``VALUES`` relation: planned as a
    LocalTableScan (no Python round trip, no RDD slices, no shuffle)."""
    names = [c.split()[0] for c in ddl.split(",")]
    types = [c.split()[1] for c in ddl.split(",")]

    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v} AS {t})"
    body = ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def gene_table(spark: SparkSession, strict_types: bool = False) -> DataFrame:
    """The fixed 29-gene table as a DataFrame (priority = list order)."""
    return _values(spark, gene_rows(strict_types),
                   "priority int, gene string, chromosome string, start int, end int")


def local_segments(rows: list[tuple]) -> list[tuple]:
    """Disjoint labelled segments of a small, fixed gene list (priority,
    gene, chromosome, start, end): the same cut as :func:`disjoint_segments`,
    derived once from the constant instead of by four small Spark stages."""
    by_chrom: dict[str, list[tuple]] = {}
    for pri, gene, chrom, start, end in rows:
        by_chrom.setdefault(chrom.upper().replace("CHR", ""), []).append((pri, gene, start, end))
    out = []
    for chrom, genes in by_chrom.items():
        bounds = sorted({b for _, _, s, e in genes for b in (s, e + 1)})
        for lo, nxt in zip(bounds, bounds[1:]):
            hi = nxt - 1
            cover = [(p, g) for p, g, s, e in genes if s <= lo and hi <= e]
            if cover:
                out.append((chrom, lo, hi, min(cover)[1]))
    return out


#: Levels of the tree over the elementary segments of a chromosome (2**32 leaves).
LEVELS = 32


def disjoint_segments(genes: DataFrame) -> DataFrame:
    """Cut gene intervals into disjoint labelled segments.

    Input columns: priority, gene, chromosome, start, end (inclusive).
    Output: chromosome, lo, hi (inclusive), gene.  The interval boundaries of
    a chromosome (starts and ends + 1), numbered by a range sort, number its
    elementary segments, so no task holds a chromosome.  An
    interval is at most two nodes per level of the binary tree over these
    numbers; every node keeps its first gene, and a segment takes the first
    gene of its ancestors.  All joins are equi joins and the rows grow with
    the logarithm of the intervals, however many of them overlap.
    """
    g = genes.select(normalize_chromosome("chromosome").alias("chromosome"), "priority", "gene",
                     F.col("start").cast("long").alias("lo"), (F.col("end").cast("long") + 1).alias("end"))
    g = g.filter(F.col("lo") < F.col("end"))
    bounds = (g.select("chromosome", F.col("lo").alias("b"))
              .unionByName(g.select("chromosome", F.col("end").alias("b"))).distinct())
    numbered = numbered_rows(bounds, ["chromosome"], ["b"])
    following = numbered.select(F.col("chromosome").alias("_c"), (F.col("_i") - 1).alias("_before"), (F.col("b") - 1).alias("hi"))
    cuts = (numbered.join(following, (F.col("chromosome") == F.col("_c")) & (F.col("_i") == F.col("_before")), "left")
            .select("chromosome", "b", F.col("_i").alias("i"), "hi", F.ceil(F.log2("_n")).cast("int").alias("height")))
    at = cuts.select(F.col("chromosome").alias("_c"), F.col("b").alias("_b"), F.col("i").alias("first"))
    to = cuts.select(F.col("chromosome").alias("_d"), F.col("b").alias("_e"), F.col("i").alias("past"))
    spans = (g.join(at, (F.col("chromosome") == F.col("_c")) & (F.col("lo") == F.col("_b")))
             .join(to, (F.col("chromosome") == F.col("_d")) & (F.col("end") == F.col("_e"))))

    def level_nodes(k):
        size = F.pow(F.lit(2.0), k).cast("long")
        left, right = F.ceil(F.col("first") / size), F.floor(F.col("past") / size)
        return F.filter(F.array(F.when((left < right) & (left % 2 == 1), F.struct(k.alias("k"), left.alias("n"))),
                                F.when((left < right) & (right % 2 == 1), F.struct(k.alias("k"), (right - 1).alias("n")))),
                        lambda x: x.isNotNull())
    levels = F.sequence(F.lit(0), F.lit(LEVELS))
    nodes = (spans.withColumn("x", F.explode(F.flatten(F.transform(levels, level_nodes))))
             .groupBy(F.col("chromosome").alias("_c"), F.col("x.k").alias("_k"), F.col("x.n").alias("_n"))
             .agg(F.min(F.struct("priority", "gene")).alias("best")))
    above = F.transform(F.sequence(F.lit(0), F.col("height")), lambda k: F.struct(k.alias("k"), F.floor(F.col("i") / F.pow(F.lit(2.0), k).cast("long")).alias("n")))
    segments = cuts.filter(F.col("hi").isNotNull()).withColumn("x", F.explode(above))
    return (segments.join(nodes, (F.col("chromosome") == F.col("_c")) & (F.col("x.k") == F.col("_k")) & (F.col("x.n") == F.col("_n")))
            .groupBy("chromosome", F.col("b").alias("lo"), "hi").agg(F.min("best").alias("best"))
            .select("chromosome", "lo", "hi", F.col("best.gene").alias("gene")))


def _binned(segments: DataFrame, bin_size: int) -> DataFrame:
    return segments.select(
        F.col("chromosome").alias("_g_chrom"),
        F.explode(F.sequence(F.floor(F.col("lo") / bin_size),
                             F.floor(F.col("hi") / bin_size))).alias("_g_bin"),
        F.col("lo").alias("_g_lo"), F.col("hi").alias("_g_hi"),
        F.col("gene").alias("_g_gene"))


def annotate_gene(df: DataFrame, genes: DataFrame | list | None = None, *,
                  chrom: str = "chromosome", pos: str = "position",
                  out: str = "gene", strict_types: bool = False,
                  bin_size: int = DEFAULT_BIN) -> DataFrame:
    """Add column ``out`` with the gene name of (chrom, pos).

    ``genes``: None -> the fixed table; a list of (gene, chromosome, start,
    end) tuples in priority order; or a DataFrame with columns priority,
    gene, chromosome, start, end.  Only the fixed table is broadcast; other
    annotations are joined by bin, and adaptive execution broadcasts them if
    their measured size allows it.
    """
    spark = df.sparkSession
    if genes is None:
        segs = _values(spark, local_segments(gene_rows(strict_types)), "chromosome string, lo bigint, hi bigint, gene string")
        seg = F.broadcast(_binned(segs, bin_size))
    else:
        if isinstance(genes, list):
            genes = spark.createDataFrame([(i, *r) for i, r in enumerate(genes)],
                                          "priority int, gene string, chromosome string, start long, end long")
        seg = _binned(disjoint_segments(genes), bin_size)

    c_norm = normalize_chromosome(chrom)
    probe = df.withColumn("_chrom_n", c_norm).withColumn(
        "_bin", F.floor(F.col(pos) / bin_size))
    joined = probe.join(
        seg,
        (F.col("_chrom_n") == F.col("_g_chrom")) & (F.col("_bin") == F.col("_g_bin"))
        & (F.col(pos) >= F.col("_g_lo")) & (F.col(pos) <= F.col("_g_hi")),
        "left")
    gene = (F.when(F.col("_chrom_n").isNull() | F.col(pos).isNull(), F.lit("Unknown"))
            .when(F.col("_g_gene").isNotNull(), F.col("_g_gene"))
            .otherwise(F.concat(F.lit("Chr"), F.col("_chrom_n"))))
    return joined.withColumn(out, gene).drop(
        "_chrom_n", "_bin", "_g_chrom", "_g_bin", "_g_lo", "_g_hi", "_g_gene")


def genetic_record(df: DataFrame, *, genotype: str = "genotype",
                   chrom: str = "chromosome", pos: str = "position",
                   strict_types: bool = False) -> DataFrame:
    """The per-SNP genetic record (P8): variant_type, gene, genotype,
    chromosome (raw text, NULL kept), position (NULL -> 0), quality 99."""
    ann = annotate_gene(df, chrom=chrom, pos=pos, out="_gene", strict_types=strict_types)
    return ann.select(
        "*",
        variant_type().alias("variant_type"),
        F.col("_gene").alias("gene"),
        default_genotype(genotype).alias("record_genotype"),
        F.col(chrom).cast("string").alias("record_chromosome"),
        F.coalesce(F.col(pos), F.lit(0)).alias("record_position"),
        F.lit(99).alias("quality"),
    ).drop("_gene")


def apply_record_defaults(rec: DataFrame) -> DataFrame:
    """Absent record fields -> SNP, Unknown, Unknown, 0, 0, 0."""
    def d(c: str, v) -> Column:
        return F.coalesce(F.col(c), F.lit(v)).alias(c)
    return rec.select(d("variant_type", "SNP"), d("gene", "Unknown"),
                      d("genotype", "Unknown"), d("chromosome", "0"),
                      d("position", 0), d("quality", 0))
