"""The first or last row of each key in two hash phases.

``min_by`` over rows keeps strings in its buffer, for which Spark sorts every
raw row.  Here a hash aggregate finds the extreme of a fixed-width column per
key, and a join lets only the rows through that reach it; the ties among those
are ranked by their content.  With few keys the extremes are broadcast by
their measured size and no raw row is shuffled; with many the rows are
shuffled once, and a hot key's rows have gone before the ranking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sortable(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    """Columns that have an order."""
    return [c for c, t in df.dtypes if c not in without and not t.startswith(("map", "variant")) and "map<" not in t]


def fixed_width(df: DataFrame, col: str) -> bool:
    """Whether a hash aggregate can hold the column's extreme."""
    t = dict(df.dtypes)[col]
    return t in ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date") or t.startswith(("timestamp", "decimal"))


def extremes(leads: Sequence[Column], largest: bool = False) -> list[Column]:
    """Aggregates ``_lead_0`` ...: of each lead the least (largest) value,
    counting rows only in which every lead before it is NULL."""
    out, open_ = [], F.lit(True)
    for i, lead in enumerate(leads):
        out.append((F.max if largest else F.min)(F.when(open_, lead)).alias(f"_lead_{i}"))
        open_ = open_ & lead.isNull()
    return out


def reaches(leads: Sequence[Column]) -> Column:
    """Whether a row reaches its key's extremes: rows with a value of an
    earlier lead come before those without."""
    hit = F.lit(True)
    for i in reversed(range(len(leads))):
        best = F.col(f"_lead_{i}")
        hit = F.when(best.isNotNull(), F.coalesce(leads[i] == best, F.lit(False))).otherwise(hit)
    return hit


def same_keys(keys: Sequence[str], prefix: str = "_key_") -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)]


def renamed(keys: Sequence[str], prefix: str = "_key_") -> list[Column]:
    return [F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)]


def first_rows(df: DataFrame, keys: Sequence[str], leads: Sequence[str], *, largest: bool = False,
               ties: Sequence[Column] | None = None) -> DataFrame:
    """One whole row per key: the one with the least (largest) first lead,
    rows in which it is NULL by the next lead, ties by ``ties`` (default: all
    columns, in the same direction).  NULL is a key of its own."""
    keys = list(keys)
    lead = [F.col(c) for c in leads if fixed_width(df, c)] if all(fixed_width(df, c) for c in leads) else []
    kept = df
    if lead:
        best = df.groupBy(*keys).agg(*extremes(lead, largest)).select(*renamed(keys), *[f"_lead_{i}" for i in range(len(lead))])
        kept = df.join(best, same_keys(keys) + [reaches(lead)], "inner").select(*df.columns)
    way = (lambda c: F.desc_nulls_last(c)) if largest else (lambda c: F.asc_nulls_last(c))
    order = [way(c) for c in leads] + (list(ties) if ties is not None else [way(c) for c in sortable(df, [*keys, *leads])])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return kept.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
