"""Quality classifier: a factorisation machine.

A text is a sparse vector of hashed words (relative counts), statistics of
its structure and the table's n_chars.  The machine adds to a linear model
the interactions of all pairs of features through vectors of rank ``RANK``;
the sum over pairs is half of (square of sum - sum of squares) per factor, so
a score takes time linear in the text's features.

It is fitted on a bounded hashed sample of labelled rows, whose features come
to the driver; scoring goes over all rows where they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.llm.common import crc_remainder

#: Rows of the fitting sample at most; features of hashed words; rank of the interactions.
SAMPLE, BUCKETS, RANK = 6000, 2 ** 16, 8
EPOCHS, BATCH, RATE, DECAY, SEED = 8, 128, 0.05, 1e-5, 11
#: Rows remembered by rest of crc32(doc_id) / FOLDS: HELD_OUT is never learnt from.
FOLDS, HELD_OUT = 3, 1
REMEMBERED = 150_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_KINDS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "line": [10],
          "space": [32, 9, 11, 12, 13], "stop": [33, 46, 63], "symbol": [c for c in range(33, 127) if not chr(c).isalnum() and c not in (33, 44, 46, 63)],
          "bang": [33], "high": range(128, 256)}
_KIND = np.zeros((256, len(_KINDS)))
for _k, _codes in enumerate(_KINDS.values()):
    _KIND[list(_codes), _k] = 1
STATISTICS = 22
FEATURES = BUCKETS + STATISTICS


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % BUCKETS
        if len(self) < REMEMBERED:
            self[word] = bucket
        return bucket


_buckets = _Buckets()


def statistics(text: bytes, words: list[bytes], distinct: int, n_chars: int | None) -> np.ndarray:
    """Structure and metadata features, each about 0 to 1."""
    size, n = max(len(text), 1), max(len(words), 1)
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _KIND / size
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = [x[-1] for x in lines]
    letters = kinds[0] + kinds[1] + kinds[8]
    rest = [np.log1p(len(text)) / 12, np.log1p(len(words)) / 10, min(len(text) / n / 16, 2.0), distinct / n,
            len(set(lines)) / max(len(lines), 1), min(len(lines) / n * 5, 2.0),
            sum(e in b".!?:;\"" for e in ends) / max(len(ends), 1), kinds[0] / max(letters, 1e-9),
            min(kinds[6] * 10, 2.0), min(kinds[7] * 10, 2.0), min(max(map(len, words), default=0) / 64, 2.0),
            float(not words), np.log1p(max(n_chars or 0, 0)) / 12]
    return np.concatenate([kinds, rest])


def features(texts: list[bytes], n_chars: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CSR arrays (row starts, feature, value) of a batch of texts."""
    starts, cols, vals = [0], [], []
    for text, size in zip(texts, n_chars, strict=True):
        words = text.translate(_LOWER).split()
        ids, counts = np.unique(np.fromiter(map(_buckets.__getitem__, words), np.int32, len(words)), return_counts=True)
        cols += [ids, np.arange(BUCKETS, FEATURES, dtype=np.int32)]
        vals += [counts / np.sqrt(max(np.dot(counts, counts), 1)), statistics(text, words, len(ids), size)]
        starts.append(starts[-1] + len(ids) + STATISTICS)
    if not cols:
        return np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0)
    return np.array(starts), np.concatenate(cols), np.concatenate(vals)


@dataclass
class Machine:
    """Bias, linear weights and factors; ``scores`` is linear in the features."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, starts, cols, vals) -> tuple[np.ndarray, np.ndarray]:
        at = starts[:-1]  # no row is without features
        vx = self.factors[cols] * vals[:, None]
        sums = np.add.reduceat(vx, at, axis=0)
        squares = np.add.reduceat(vx * vx, at, axis=0)
        return self.bias + np.add.reduceat(self.linear[cols] * vals, at) + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def scores(self, starts, cols, vals) -> np.ndarray:
        if len(starts) == 1:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.raw(starts, cols, vals)[0], -35, 35)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """Adaptive gradient steps on the logistic loss over shuffled batches.
    Without rows every score is 0.5."""
    rng = np.random.default_rng(SEED)
    m = Machine(0.0, np.zeros(FEATURES), rng.normal(0, 0.05, (FEATURES, RANK)))
    if not rows:
        m.factors[:] = 0
        return m
    share = np.clip(labels.mean(), 0.01, 0.99)
    m.bias = float(np.log(share / (1 - share)))
    seen_bias, seen_linear, seen_factors = 1e-6, np.full(FEATURES, 1e-6), np.full((FEATURES, RANK), 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for b in range(0, len(order), BATCH):
            batch = order[b:b + BATCH]
            sizes = [len(rows[i][0]) for i in batch]
            starts = np.concatenate([[0], np.cumsum(sizes)])
            cols, vals = (np.concatenate([rows[i][k] for i in batch]) for k in (0, 1))
            raw, sums = m.raw(starts, cols, vals)
            slope = (1 / (1 + np.exp(-np.clip(raw, -35, 35))) - labels[batch]) / len(batch)
            each = np.repeat(slope, sizes) * vals
            used, at = np.unique(cols, return_inverse=True)
            g_linear = np.bincount(at, each, len(used)) + DECAY * m.linear[used]
            own = each[:, None] * (np.repeat(sums, sizes, axis=0) - m.factors[cols] * vals[:, None])
            g_factors = np.stack([np.bincount(at, own[:, k], len(used)) for k in range(RANK)], 1) + DECAY * m.factors[used]
            seen_bias += slope.sum() ** 2
            seen_linear[used] += g_linear ** 2
            seen_factors[used] += g_factors ** 2
            m.bias -= RATE * slope.sum() / np.sqrt(seen_bias)
            m.linear[used] -= RATE * g_linear / np.sqrt(seen_linear[used])
            m.factors[used] -= RATE * g_factors / np.sqrt(seen_factors[used])
    return m


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine fitted on at most ``SAMPLE`` labelled ids outside the held
    out fold, those with the smallest hashes.  An id that repeats is learnt
    from once, by its row with the smallest hash of the inputs; the copies
    stay on the executors."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()
                           & (crc_remainder("doc_id", FOLDS) != HELD_OUT))
              .groupBy("doc_id").agg(F.max("quality").alias("_quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    sample = (docs.select("doc_id", *_inputs(docs)).join(F.broadcast(chosen), "doc_id")
              .withColumn("_hash", F.xxhash64("text", "n_chars")))
    least = sample.groupBy("doc_id").agg(F.min("_hash").alias("_hash"))  # SAMPLE rows at most
    sample = sample.join(F.broadcast(least), ["doc_id", "_hash"]).select("doc_id", "text", "n_chars", "_quality")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # rows of one id that are left are copies: one a task is enough
        for batch in batches:
            first = [i not in seen and not seen.add(i) for i in batch.column(0).to_pylist()]
            ids, texts, sizes, quality = (c.to_pylist() for c in batch.filter(pa.array(first, pa.bool_())).columns)
            cols, vals = [], []
            for text, size in zip(texts, sizes, strict=True):
                _, c, v = features([text], [size])
                cols.append(c.astype(np.int32).tobytes())
                vals.append(v.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(quality, pa.int32()), pa.array(cols, pa.binary()), pa.array(vals, pa.binary())],
                                             names=["doc_id", "quality", "cols", "vals"])

    found = sample.select(F.col("doc_id").cast("long"), "text", "n_chars", F.col("_quality").cast("int")).mapInArrow(
        extract, "doc_id long, quality int, cols binary, vals binary").groupBy("doc_id").agg(
        F.min(F.struct("quality", "cols", "vals")).alias("row")).select("doc_id", "row.*").toArrow().to_pylist()
    found = sorted(found, key=lambda r: r["doc_id"])
    rows = [(np.frombuffer(r["cols"], np.int32), np.frombuffer(r["vals"], np.float32).astype(float)) for r in found]
    return fit(rows, np.array([min(max(r["quality"], 0), 1) for r in found], float))


def _inputs(docs: DataFrame) -> list:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return [F.coalesce("text", F.lit("")).cast("binary").alias("text"), n_chars.alias("n_chars")]


def with_scores(docs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (machine.bias, machine.linear.astype(np.float32), machine.factors.astype(np.float32)))  # 2.4 MB, whatever the input

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Machine(*shared.value)
        for batch in batches:
            texts, sizes = batch.column(0), batch.column(1)
            found = []
            for at in range(0, batch.num_rows, 64):
                found.append(own.scores(*features(texts.slice(at, 64).to_pylist(), sizes.slice(at, 64).to_pylist())))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(np.concatenate([np.zeros(0), *found]), pa.float64())],
                                             names=[*keep, "_llm_score"])

    rows = docs.select(*[x.alias(f"_llm_{i}") for i, x in enumerate(_inputs(docs))], *[F.col(c) for c in keep])
    schema = rows.drop("_llm_0", "_llm_1").schema.add("_llm_score", "double")
    return rows.mapInArrow(score, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts are scored by their statistics, all zero but for the
    mark of a text without words.  Null ids never match a label; their fold is
    that of the empty text.  Labels that repeat an id count once, the larger
    one; label rows with nulls are not learnt from.  Without any label every
    score is 0.5.
    """
    scored = with_scores(docs.select("doc_id", *[c for c in ("text", "n_chars") if c in docs.columns]),
                         train(docs, labels), ["doc_id"])
    return scored.select("doc_id", (crc_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
                         F.col("_llm_score").alias("score"), (F.col("_llm_score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is 0.5 or more, with all columns."""
    return with_scores(docs, train(docs, labels), docs.columns).where("_llm_score >= 0.5").drop("_llm_score")
