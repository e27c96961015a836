"""SimHash near-duplicates through pivot distance tables.

Fingerprints: each bit is the majority over the hashes of a text's word
shingles.  All distinct fingerprints at ``MOST_BITS`` or fewer differing bits
are linked, exactly:

* Of ``BLOCKS`` blocks of bits, ``MOST_BITS`` differing bits leave at least
  ``BLOCKS - MOST_BITS`` blocks equal, so linked fingerprints share some such
  choice of blocks; each fingerprint goes to one group per choice.
* In a group, the Hamming distances of each fingerprint to ``PIVOTS`` reference
  fingerprints are computed once.  By the triangle inequality linked
  fingerprints differ by ``MOST_BITS`` at most in every coordinate: the group
  is sorted by the first, only neighbours in it are paired, pairs with a
  larger difference in any coordinate are discarded, and the survivors'
  distances are verified on the fingerprints.
* A group gives a spanning star per component, not its pairs.  Groups of more
  than ``CHUNK`` fingerprints are dealt into chunks, and every pair of chunks
  is a group of its own, so no link is lost and no task holds a large group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelic.llm.common import stored
from allelic.llm.graph import components

SHINGLE, MOST_BITS, BLOCKS, PIVOTS, PIVOT_SEED, HASH_SEED = 3, 3, 5, 32, 64, 42
CHUNK = 8192
#: A group may have this many rows of the hot table before it is joined rather than broadcast.
BROADCAST_ROWS = 10_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_hash = partial(xxhash.xxh64_intdigest, seed=HASH_SEED)


def fingerprint(text: bytes) -> int:
    """The text's fingerprint as a signed 64-bit number; no words: 0."""
    words = text.translate(_LOWER).split()
    n = max(len(words) - SHINGLE + 1, min(len(words), 1))
    if n == 0:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else [b" ".join(words)]
    hashes = np.fromiter(map(_hash, shingles), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        ones += np.unpackbits(hashes[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp) of every row; null texts count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or b"") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], names=["id", "text_hash", "fp"])

    text = F.col(text_col).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        run, "id long, text_hash long, fp long")


def _masks() -> list[int]:
    """Bits of every choice of blocks that may be left equal."""
    edges = [round(i * 64 / BLOCKS) for i in range(BLOCKS + 1)]
    blocks = [sum(1 << b for b in range(x, y)) for x, y in zip(edges, edges[1:], strict=False)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(c)) for c in combinations(blocks, BLOCKS - MOST_BITS)]


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances to the reference fingerprints, a column for each."""
    pivots = np.random.default_rng(PIVOT_SEED).integers(0, 2 ** 64, PIVOTS, dtype=np.uint64)
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def _near(fps: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) are linked."""
    alive = np.arange(len(i))
    for k in range(1, PIVOTS):
        alive = alive[np.abs(table[i[alive], k] - table[j[alive], k]) <= MOST_BITS]
        if k in (1, 3, 7) and not len(alive):
            break
    ok = np.zeros(len(i), bool)
    ok[alive] = np.bitwise_count(fps[i[alive]] ^ fps[j[alive]]) <= MOST_BITS
    return ok


def _join(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unites the pairs' components; roots stay fully resolved."""
    while len(i):
        a, b = roots[i], roots[j]
        open_ = a != b
        if not open_.any():
            return
        i, j = i[open_], j[open_]
        np.minimum.at(roots, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
        while (after := roots[roots]).tobytes() != roots.tobytes():
            roots[:] = after


def _stars(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, its component's first one) within equal keys.

    Rows come sorted by key.  Step s compares every row with the s-th after it
    for as long as the first coordinates are near enough."""
    table = pivot_table(fps)
    order = np.lexsort((table[:, 0], keys))
    keys, fps, table = keys[order], fps[order], table[order]
    roots = np.arange(len(fps))
    first = table[:, 0].astype(np.int16)
    rows, step = np.arange(len(fps)), 1
    while len(rows := rows[rows + step < len(fps)]):
        rows = rows[(keys[rows] == keys[rows + step]) & (first[rows + step] - first[rows] <= MOST_BITS)]
        for at in range(0, len(rows), 1 << 16):
            i = rows[at:at + (1 << 16)]
            ok = _near(fps, table, i, i + step)
            _join(roots, i[ok], i[ok] + step)
        step += 1
    linked = np.flatnonzero(roots != np.arange(len(fps)))
    return fps[linked], fps[roots[linked]]


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints ``fp`` (distinct) at
    ``MOST_BITS`` or fewer differing bits, directly or through others."""
    choices = F.array(*[F.struct(F.lit(i).alias("c"), F.lit(m).alias("m")) for i, m in enumerate(_masks())])
    placed = (fps.withColumn("x", F.explode(choices))
              .select("fp", F.xxhash64("x.c", F.col("fp").bitwiseAND(F.col("x.m"))).alias("key")))
    hot = stored(placed.groupBy("key").count().where(F.col("count") > CHUNK)
                 .select(F.col("key").alias("hot_key"), F.ceil(F.col("count") / CHUNK).alias("chunks")), "hot")
    small = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    marked = placed.join(small, F.col("key") == F.col("hot_key"), "left")
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.col("chunks"))
    # chunk x meets every chunk y in the group (min, max)
    meets = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1),
                        lambda y: F.xxhash64("key", F.least(chunk, y), F.greatest(chunk, y)))
    dealt = marked.select("fp", F.explode(F.when(F.col("chunks").isNull(), F.array("key")).otherwise(meets)).alias("key"))
    grouped = dealt.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_keys, left_fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def edges(keys, values):
            same = np.flatnonzero(np.diff(keys) == 0)
            rows = np.union1d(same, same + 1)  # rows alone in their group go
            a, b = _stars(keys[rows], values[rows])
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate([left_keys, batch.column(1).to_numpy(zero_copy_only=False)])
            values = np.concatenate([left_fps, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(keys):
                continue
            whole = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
            left_keys, left_fps = keys[whole:], values[whole:]
            yield edges(keys[:whole], values[:whole])
        yield edges(left_keys, left_fps)

    return grouped.mapInArrow(run, "a long, b long")


def _classified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, fp, text_hash and root (the least fingerprint of the component) of every row."""
    marks = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = stored(marks.select("fp").distinct(), "distinct")
    roots = components(links(distinct))
    linked = marks.join(roots, F.col("fp") == F.col("node"), "left")
    return stored(linked.select("id", "fp", "text_hash", F.coalesce("root", "fp").alias("root")), "classes")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fp (signed), component_id, the smallest
    id of any row whose fingerprint is reachable over links.

    Texts without words (null, empty, white space) have fingerprint 0 and are
    linked like any other.  Null ids take part with their fingerprints; they
    are a component_id only if all ids of the component are null.
    """
    classes = _classified(docs, id_col, text_col)
    # a table of its own, so that adaptive execution can split a large component's part of the join
    least = stored(classes.groupBy(F.col("root").alias("of")).agg(F.min("id").alias("component_id")), "least")
    return (classes.join(least, F.col("root") == F.col("of"))
            .select(F.col("id").alias("doc_id"), "fp", "component_id"))


def near_digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    return near_groups(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with all columns: that with the smallest id
    (null ids last); of rows that repeat the id, one."""
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("best")
    kept = (_classified(docs, "doc_id", "text").groupBy("root").agg(best)
            .select(F.coalesce("best.id", F.lit(0)).alias("_llm_kid"), F.col("best.none").alias("_llm_knone"),
                    F.col("best.text_hash").alias("_llm_khash")).distinct())
    rows = docs.withColumns({"_llm_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_llm_none": F.col("doc_id").isNull(),
                             "_llm_hash": F.xxhash64(F.col("text").cast("binary"))})
    key = ["_llm_id", "_llm_none", "_llm_hash"]
    found = rows.join(kept, [F.col("_llm_id") == F.col("_llm_kid"), F.col("_llm_none") == F.col("_llm_knone"),
                             F.col("_llm_hash") == F.col("_llm_khash")], "left_semi")
    first = F.row_number().over(Window.partitionBy(*key).orderBy("text"))
    return found.withColumn("_llm_at", first).where("_llm_at = 1").select(*docs.columns)
