"""DuckDB SQL fragments shared by the oracle queries."""

from __future__ import annotations

from allelic.schemas import GENES
from allelic.sources.fixture import SNPS_DUCKDB_SQL


def with_snps(*ctes: str) -> str:
    """``WITH snps AS (...), <ctes>`` prefix."""
    parts = [f"snps AS ({SNPS_DUCKDB_SQL})", *ctes]
    return "WITH " + ",\n".join(parts) + "\n"


def pct(a: str, b: str, digits: int = 2, share_first: bool = False) -> str:
    if share_first:
        return (f"round(CASE WHEN CAST({b} AS DOUBLE) <> 0 THEN (CAST({a} AS DOUBLE)"
                f" / CAST({b} AS DOUBLE)) * 100.0 END, {digits})")
    return (f"round(CASE WHEN CAST({b} AS DOUBLE) <> 0 THEN 100.0 * CAST({a} AS DOUBLE)"
            f" / CAST({b} AS DOUBLE) END, {digits})")


def ratio(a: str, b: str, digits: int = 4) -> str:
    return (f"round(CASE WHEN CAST({b} AS DOUBLE) <> 0 THEN CAST({a} AS DOUBLE)"
            f" / CAST({b} AS DOUBLE) END, {digits})")


def bucket(c: str, label: str) -> str:
    return f"coalesce(nullif({c}, ''), '{label}')"


def norm_chrom(c: str) -> str:
    return f"replace(upper({c}), 'CHR', '')"


def is_het(g: str) -> str:
    return (f"CASE WHEN length({g}) = 2 THEN CASE WHEN substr({g},1,1) = substr({g},2,1)"
            f" THEN 0 ELSE 1 END END")


def classify(g: str) -> str:
    a, b = f"substr({g},1,1)", f"substr({g},2,1)"
    return (f"CASE WHEN {g} IS NULL OR length({g}) <> 2 THEN 'invalid' "
            f"WHEN {a} = {b} THEN CASE WHEN {a} = upper({a}) AND {a} <> lower({a}) "
            f"THEN 'dominant' ELSE 'recessive' END ELSE 'heterozygous' END")


def orientation_vcf(g: str) -> str:
    p = f"string_split({g}, '/')"
    a, b = f"TRY_CAST({p}[1] AS INTEGER)", f"TRY_CAST({p}[2] AS INTEGER)"
    ok = f"({g} IS NOT NULL AND {g} <> 'Unknown' AND len({p}) = 2 AND {a} IS NOT NULL AND {b} IS NOT NULL)"
    return (f"CASE WHEN NOT {ok} THEN NULL WHEN {a} = 0 AND {b} = 0 THEN 'recessive' "
            f"WHEN {a} = 1 AND {b} = 1 THEN 'dominant' ELSE 'heterozygous' END")


def orientation(style: str) -> str:
    if style == "letters":
        c = classify("genotype")
        return f"CASE WHEN {c} <> 'invalid' THEN {c} END"
    return orientation_vcf("gt_num")


def genes_cte(name: str = "genes") -> str:
    rows = ",\n  ".join(f"({i}, '{g}', '{c}', {s}, {e})" for i, (g, c, s, e) in enumerate(GENES))
    return f"{name}(priority, gene, gchrom, gstart, gend) AS (VALUES\n  {rows})"


def annotated_cte(name: str = "ann", src: str = "snps", where: str = "has_snp") -> list[str]:
    """CTEs giving ``{name}``: every column of ``src`` plus ``gene``
    (brute-force first-match over the gene list)."""
    return [
        genes_cte(),
        f"_s AS (SELECT *, {norm_chrom('chromosome')} AS _cn FROM {src} WHERE {where})",
        "_m AS (SELECT _s.snp_id, arg_min(g.gene, g.priority) AS _gene FROM _s JOIN genes g "
        "ON _s._cn = g.gchrom AND _s.position BETWEEN g.gstart AND g.gend GROUP BY _s.snp_id)",
        f"{name} AS (SELECT _s.* EXCLUDE (_cn), CASE WHEN _s._cn IS NULL OR _s.position IS NULL "
        "THEN 'Unknown' WHEN _m._gene IS NOT NULL THEN _m._gene ELSE 'Chr' || _s._cn END AS gene "
        "FROM _s LEFT JOIN _m USING (snp_id))",
    ]


def window_start(width_us: int, ts: str = "ts") -> str:
    return f"make_timestamp((epoch_us({ts}) // {width_us}) * {width_us})"


def rate_cte(seconds: list[int], name: str = "rates", by: list[str] | None = None) -> str:
    """Per distinct (by, ts): n_at and n_{w}s trailing counts."""
    by = by or []
    byc = "".join(f"{b}, " for b in by)
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    frames = ", ".join(
        f"CAST(sum(n_at) OVER ({part}ORDER BY epoch_us(ts) RANGE BETWEEN {s * 1_000_000 - 1} "
        f"PRECEDING AND CURRENT ROW) AS BIGINT) AS n_{s}s" for s in seconds)
    return (f"{name} AS (SELECT {byc}ts, n_at, {frames} FROM "
            f"(SELECT {byc}ts, count(*) AS n_at FROM snps WHERE has_snp GROUP BY ALL))")
