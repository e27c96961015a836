"""Mixing sources to target weights by weighted fair queueing, in DataFrame
operations only.

Every source is a queue of its documents in a hashed order, read up to
``epochs`` times.  A queue entry's virtual start and finish are the words its
source has served before and after it, divided by the source's weight.  The
starts and finishes of all entries are sorted by virtual time over ranges.
Between two of them every entry in service gives words at its weight, so with
A the sum of the weights started less those finished, and C the same sum of
the words before each, the words served by virtual time v are v * A - C.  The
sums per range find the range in which they reach the budget, running sums in
that range alone find the virtual time of the cut.  Entries that finish before
it are taken whole, the one a source is serving there in part, later ones not;
so each source meets its target to the word, though no target is read.

All prefix sums are taken in two levels, over ranges of a sort whose last key
is a row number: neither a hot source nor a hot id is one task's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelic.llm.common import SPACE, stored, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1"
_BEFORE = Window.unboundedPreceding


def words(text: str) -> Column:
    """Number of maximal runs of characters other than ASCII white space."""
    return F.regexp_count(text_or_empty(text), F.lit(f"[^{SPACE}]+")).cast("long")


#: monotonically_increasing_id is the partition number above this many bits of the row's place in it.
_PLACE_BITS = 33


def _in_ranges(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` sorted by ``order`` over ranges and stored, with ``_place`` (rising
    along the order) and ``_range`` (number of the range)."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return (stored(rows.withColumn("_place", F.monotonically_increasing_id()), name)
            .withColumn("_range", F.shiftright("_place", _PLACE_BITS)))


def _sums_before(rows: DataFrame, by: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` of ``_in_ranges`` with the sum of each column over the earlier
    rows of the same ``by``: those of earlier ranges, from one row a range and
    group, and those of its own range."""
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(_BEFORE, -1)
    within = Window.partitionBy(*by, "_range").orderBy("_place").rowsBetween(_BEFORE, -1)
    ranges = rows.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_in_{n}") for n, c in sums.items()])
    ranges = ranges.select(*[F.col(k).alias(f"_of_{i}") for i, k in enumerate(by)], F.col("_range").alias("_of"),
                           *[F.coalesce(F.sum(f"_in_{n}").over(earlier), F.lit(0)).alias(f"_to_{n}") for n in sums])
    on = [F.col(k) == F.col(f"_of_{i}") for i, k in enumerate(by)] + [F.col("_range") == F.col("_of")]
    return (rows.withColumns({f"_own_{n}": F.coalesce(F.sum(c).over(within), F.lit(0)) for n, c in sums.items()})
            .join(ranges, on)
            .select(*rows.columns, *[(F.col(f"_to_{n}") + F.col(f"_own_{n}")).alias(n) for n in sums]))


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   epochs: int = EPOCHS) -> DataFrame:
    """One row per source: source, rank, source_size, weight, target.

    Sources in code point order, null last, take the weights in turn.  The
    budget is ``share`` of all sizes; a target stops at ``epochs`` times the
    source's size, and the excess goes to the others by weight.  With the
    sources in order of cap / weight, the common level is the largest of
    (budget - caps before) / (weights from here on).
    """
    by_source = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    ranked = (_sums_before(_in_ranges(by_source, [F.col("source").asc_nulls_last()], "by-name"), [], {"ahead": F.lit(1)})
              .withColumn("rank", F.col("ahead") + 1)
              .withColumn("weight", F.element_at(turn, (F.col("ahead") % len(weights) + 1).cast("int")))
              .withColumn("cap", F.col("source_size") * epochs)
              .select("source", "rank", "source_size", "weight", "cap"))
    filled = _sums_before(_in_ranges(ranked, [F.col("cap") / F.col("weight"), F.col("rank")], "by-ratio"), [],
                          {"caps_before": F.col("cap"), "weights_before": F.col("weight")})
    filled = stored(filled.drop("_place", "_range"), "levels")
    weights_left = filled.select(F.sum("weight")).scalar() - F.col("weights_before")
    level = filled.select(F.max((_budget(by_source, share) - F.col("caps_before")) / weights_left)).scalar()
    return filled.select("source", "rank", "source_size", "weight",
                         F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


def _budget(sized: DataFrame, share: float) -> Column:
    size = "source_size" if "source_size" in sized.columns else "size"
    return sized.select(F.sum(size) * F.lit(float(share))).scalar()


def cut_time(events: DataFrame, budget: Column) -> DataFrame:
    """One row, ``cut``: the virtual time at which the words served reach the
    budget; null if they never do.  ``events``: rows of ``_in_ranges`` in order
    of ``time``, with ``rate`` (the weight, negative at a finish) and ``work``
    (time * rate, in whole words).  Only the rows of the range that holds the
    cut are summed one by one."""
    to_here = Window.orderBy("_range").rowsBetween(_BEFORE, 0)
    ranges = (events.groupBy("_range").agg(F.sum("rate").alias("r"), F.sum("work").alias("w"), F.max("time").alias("until"))
              .withColumn("rates", F.sum("r").over(to_here)).withColumn("works", F.sum("w").over(to_here)))
    reached = ranges.filter(F.col("until") * F.col("rates") - F.col("works") >= budget)
    first = reached.agg(F.min("_range").alias("_range"))
    here = (ranges.select(F.col("_range"), (F.col("rates") - F.col("r")).alias("rates_before"),
                          (F.col("works") - F.col("w")).alias("works_before")).join(first, "_range"))
    run = Window.partitionBy("_range").orderBy("_place").rowsBetween(_BEFORE, -1)
    at = (events.join(here, "_range")
          .withColumn("rates", F.col("rates_before") + F.coalesce(F.sum("rate").over(run), F.lit(0)))
          .withColumn("works", F.col("works_before") + F.coalesce(F.sum("work").over(run), F.lit(0)))
          .filter((F.col("rates") > 0) & (F.col("time") * F.col("rates") - F.col("works") >= budget)))
    return at.agg(F.min_by((budget + F.col("works")) / F.col("rates"), "_place").alias("cut"))


def fair_queue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", weights: Sequence[int] = WEIGHTS,
               share: float = SHARE, epochs: int = EPOCHS, seed: str = SEED,
               row_col: str | None = None) -> DataFrame:
    """The queue: ``epochs`` entries per input row, sorted by virtual finish.

    Columns: id, source, size, source_size, target, row (unique per input
    row: ``row_col``, or numbers given here), epoch, start and finish (virtual
    times), taken (words of the entry inside the budget; 0 after the cut).
    Null and empty texts have size 0 and take nothing.  Null sources are one
    source, the last.  Null ids hash as the empty text; rows that repeat an id
    are neighbours in the queue, each an entry of its own.  Other columns of
    ``docs`` are not read.
    """
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    number = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    sized = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                               words(text_col).alias("size"), shuffled.alias("h"), number.alias("row")), "sizes")
    targets = source_targets(sized, weights, share, epochs)
    placed = sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    order = [F.col("rank"), F.col("h"), F.col("id").asc_nulls_last(), F.col("size"), F.col("row")]
    rows = _sums_before(_in_ranges(placed, order, "placed"), ["rank"], {"first": F.col("size")})
    entries = (rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
               .withColumn("served", F.col("first") + F.col("epoch") * F.col("source_size")))
    held = ["id", "source", "size", "source_size", "target", "row", "epoch"]
    begun, done = F.col("served"), F.col("served") + F.col("size")
    rate = F.when(F.col("size") > 0, F.col("weight").cast("long")).otherwise(F.lit(0))
    work = F.when(F.col("size") > 0, F.lit(1)).otherwise(F.lit(0))
    events = (entries.withColumn("e", F.explode(F.array(
        F.struct(F.lit(0).alias("ends"), (begun / F.col("weight")).alias("time"), rate.alias("rate"), (begun * work).alias("work")),
        F.struct(F.lit(1).alias("ends"), (done / F.col("weight")).alias("time"), (-rate).alias("rate"), (-done * work).alias("work")))))
        .filter((F.col("e.ends") == 1) | (F.col("size") > 0))
        .select(*[F.when(F.col("e.ends") == 1, F.col(c)).alias(c) for c in held], "weight", "rank", "served", "e.*"))
    queue = _in_ranges(events, [F.col(c) for c in ("time", "rank", "served", "ends", "row")], "queue")
    cut = cut_time(queue, _budget(sized, share)).scalar()
    reached = F.coalesce(cut * F.col("weight"), F.lit(float("inf")))
    limit = F.floor(F.least(reached, (F.col("source_size") * epochs).cast("double")) + 0.5)
    return (queue.filter(F.col("ends") == 1)
            .select(*held, (F.col("served") / F.col("weight")).alias("start"), F.col("time").alias("finish"),
                    F.least(F.col("size"), F.greatest(limit - F.col("served"), F.lit(0))).cast("long").alias("taken")))


def mix_digest(docs: DataFrame) -> DataFrame:
    """One row per document with the words that the mix takes of it."""
    queue = fair_queue(docs)
    return (queue.groupBy("row").agg(
        F.first("id").alias("doc_id"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum("taken").alias("taken")).drop("row"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixed documents, whole: a row for each entry of which the budget
    holds at least half, so that a document comes 0 to ``EPOCHS`` times.
    Documents without words cost nothing and come once.  The documents are
    stored with a number per row, by which they meet their entries; null ids
    and rows that repeat an id are documents of their own.
    """
    rows = stored(docs.withColumn("_llm_row", F.monotonically_increasing_id()), "numbered")
    copies = (fair_queue(rows, row_col="_llm_row").groupBy("row").agg(
        F.first("size").alias("_llm_size"),
        F.sum(((F.col("taken") * 2 >= F.col("size")) & (F.col("taken") > 0)).cast("int")).alias("_llm_n"))
        .select(F.col("row").alias("_llm_row"),
                F.when(F.col("_llm_size") == 0, 1).otherwise(F.col("_llm_n")).cast("int").alias("_llm_n"))
        .filter(F.col("_llm_n") > 0))
    return (rows.join(copies, "_llm_row")
            .withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), F.col("_llm_n"))))
            .select(*docs.columns))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM src),
levels AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
             - CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
            / CAST(sum(weight) OVER (ORDER BY cap / weight, rank
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS here
  FROM weighted),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), max(here) OVER () * weight) AS target
  FROM levels),
served AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id, s.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(least(size, greatest(CAST(floor(target + 0.5) AS BIGINT) - before, 0))
          + least(size, greatest(CAST(floor(target + 0.5) AS BIGINT) - before - source_size, 0)) AS BIGINT) AS taken
FROM served
"""
