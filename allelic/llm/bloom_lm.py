"""Language-model scores from a log-frequency Bloom filter.

Units: texts are cut into units of some MB, stored with their rows, so that
every pass sees the same units.

Counting: tasks count the words and word pairs of a unit; words go on as
(word, count), n-grams as sorted arrays of distinct 48-bit hashes with counts
(0 for those of held-out texts alone), dealt by hash range.  A range's task
sums them and sets the bits of its own segment of the filter.  An n-gram of
count c is quantised to the level 1 + floor(log_BASE(c)) and entered once per
level up to its own, so that its level is read back by probing levels until
one is absent.

A segment's bits follow its own entries, so every level of every n-gram is
held whatever the input's size, and no process ever holds the whole filter:
the range's task also probes its segment for the hashes of each unit, and a
byte for each, its level, goes back to the unit in the order of the hashes.

Scoring: the model's probability of a word is its pair's count over the first
word's count, smoothed by the word's own probability, all counts being those
of the levels read from the filter.  The exact unigram base score takes the counts of words with
over 1/``HEAVY`` of all tokens, fewer than ``HEAVY`` words, from a broadcast,
and those of all other words from a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allelic.llm.common import crc_remainder, stored

FOLDS, HELD_OUT = 7, 2
#: Words that have over 1/HEAVY of the tokens, and this many bytes at most, are scored from a broadcast.
HEAVY, MOST_LENGTH = 500_000, 64
#: Quantisation base, probes per level, bits per entry of a segment.
BASE, PROBES, ENTRY_BITS = 2.0, 5, 32
#: Training tokens in a hash range.
RANGE_TOKENS = 1 << 20
#: Weight of a word's own probability against its pair's, in tokens.
PRIOR = 4.0

#: The end token, which also stands before a text; no word has white space in it.
END = b"\n"
#: Bytes of text that are taken apart together.
SLICE_BYTES = 12 * 1024 * 1024
_SALT = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of an n-gram's hash.  Equal hashes of different n-grams are far rarer than the filter's own errors.
KEY_BYTES = 6
_KEPT = np.uint64((1 << 64) - (1 << (64 - 8 * KEY_BYTES)))


@dataclass
class Tokens:
    """The tokens of some texts: distinct ones (the end token is the last),
    each token's number in them, and where each text begins and ends."""

    distinct: pa.Array
    which: np.ndarray
    offsets: np.ndarray

    def hashes(self) -> np.ndarray:
        """Hashes of the distinct tokens."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.distinct.to_pylist()), np.uint64, len(self.distinct))

    def counts(self) -> np.ndarray:
        return np.bincount(self.which, minlength=len(self.distinct))


def tokens(texts: pa.Array) -> Tokens:
    """Lower-case words (A-Z alone are lowered) and the end token of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    word = coded.indices.to_numpy()
    at = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
    real = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(bool)[word] if len(word) else np.zeros(0, bool)
    at = np.concatenate([[0], np.cumsum(real)])[at]  # splitting leaves empty strings at a text's ends
    word = word[real]
    offsets = at + np.arange(len(at))
    which = np.full(len(word) + len(texts), len(coded.dictionary), np.int64)
    which[np.arange(len(word)) + np.repeat(np.arange(len(texts)), np.diff(at))] = word
    distinct = pa.concat_arrays([pc.cast(coded.dictionary, pa.binary()), pa.array([END], pa.binary())])
    return Tokens(distinct, which, offsets)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``SLICE_BYTES`` of text, one row at least."""
    size = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        before = size[begin - 1] if begin else 0
        end = max(int(np.searchsorted(size, before + SLICE_BYTES, side="right")), begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


def mixed(x: np.ndarray) -> np.ndarray:
    """Bit mixer of 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def end_hash() -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(END))


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; a text's first follows the end token."""
    return mixed(np.concatenate([[end_hash()], h[:-1]]) * _SALT + h) & _KEPT


def single_hashes(h: np.ndarray) -> np.ndarray:
    """Hash of each token as an n-gram of its own."""
    return mixed(h ^ _SALT) & _KEPT


def packed(keys: np.ndarray) -> bytes:
    """Keys without the low bytes that hashes of n-grams have as 0."""
    return np.ascontiguousarray(keys, "<u8").view(np.uint8).reshape(-1, 8)[:, 8 - KEY_BYTES:].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    out[:, 8 - KEY_BYTES:] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return out.view("<u8").ravel()


def packed_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and the differences, in as many bytes as the largest needs."""
    steps = np.diff(keys) >> np.uint64(64 - 8 * KEY_BYTES)
    width = max((int(steps.max(initial=0)).bit_length() + 7) // 8, 1)
    return bytes([width]) + packed(keys[:1]) + np.ascontiguousarray(steps, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked_sorted(data: bytes) -> np.ndarray:
    width, begin = data[0], 1 + KEY_BYTES
    steps = np.zeros(((len(data) - begin) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(data, np.uint8, offset=begin).reshape(-1, width)
    steps = np.concatenate([[np.uint64(0)], np.cumsum(steps.view("<u8").ravel())]).astype(np.uint64)
    return unpacked(data[1:begin]) + (steps << np.uint64(64 - 8 * KEY_BYTES))


def summed(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts (1 each if None)."""
    k = np.concatenate(keys)
    if not len(k):
        return k, np.zeros(0, np.int64)
    if counts is None:
        k.sort()
    else:
        order = np.argsort(k)
        k, n = k[order], np.concatenate(counts)[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[starts], np.diff(np.append(starts, len(k))) if counts is None else np.add.reduceat(n, starts)


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised log frequency, from 1."""
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def level_count(level: np.ndarray) -> np.ndarray:
    """A count for each level: the middle of its range, 0 for level 0."""
    return np.where(level > 0, (BASE ** (level - 1) + np.maximum(BASE ** level - 1, 1)) / 2, 0.0)


class Filter:
    """A log-frequency Bloom filter in segments of 64-bit words, one for each
    range of hashes."""

    def __init__(self, segments: int, words: int, bits: np.ndarray):
        self.segments, self.words, self.bits = segments, words, bits

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Levels of the keys, read by probing until one is absent."""
        out = np.zeros(len(keys), np.int64)
        first, alive, level = segment_of(keys, self.segments) * self.words, np.arange(len(keys)), 1
        while len(alive):
            for k in range(PROBES):
                at = bit_of(keys[alive], level, k, self.words)
                word = self.bits[first[alive] + (at >> 6)]
                alive = alive[(word >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1]
            out[alive] = level
            level += 1
        return out


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """Range of a key; larger keys are in later ranges."""
    return ((keys >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def bit_of(keys: np.ndarray, level: int, probe: int, words: int) -> np.ndarray:
    """Place of a level's probe within its segment."""
    h = mixed(keys ^ np.uint64((int(_SALT) * (level * PROBES + probe + 1)) % 2 ** 64))
    return ((h >> np.uint64(32)) * np.uint64(words * 64) >> np.uint64(32)).astype(np.int64)


def segment_bits(keys: np.ndarray, counts: np.ndarray, words: int) -> np.ndarray:
    """Bits of a segment that holds all levels of the keys; ``segment_words`` has room for them."""
    level = levels(counts)
    on = np.zeros(words * 64, bool)
    for at in range(1, int(level.max(initial=0)) + 1):
        keys, level = keys[level >= at], level[level >= at]
        for k in range(PROBES):
            on[bit_of(keys, at, k, words)] = True
    return np.packbits(on, bitorder="little").view("<u8")


def segment_words(counts: np.ndarray) -> int:
    """64-bit words of a segment in which all levels of the counts have room."""
    return int(levels(counts).sum()) * ENTRY_BITS // 64 + 1


def ranges(n_tokens: int) -> int:
    """Hash ranges for so many training tokens."""
    return max(-(-n_tokens // RANGE_TOKENS), 1)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), (crc_remainder(id_col, FOLDS) == HELD_OUT).alias("held_out"),
                       F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) over the texts of ``train``."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for batch in batches for x in slices(batch, 0)):
            own = tokens(part.column(0))
            n = own.counts()
            some = pa.array(n > 0)
            yield pa.RecordBatch.from_arrays([own.distinct.filter(some), pa.array(n[n > 0], pa.int64())], schema=schema)

    return train.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def in_units(rows: DataFrame) -> DataFrame:
    """The rows with a number ``row``, and ``unit``, the first row of the
    slice of about ``SLICE_BYTES`` of text that a row is in."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part in (x for batch in batches for x in slices(batch, 2)):
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.arange(row, row + part.num_rows), pa.int64()), pa.array(np.full(part.num_rows, row), pa.int64())],
                names=["id", "held_out", "text", "row", "unit"])
            row += part.num_rows

    return rows.mapInArrow(cut, T.StructType([*rows.schema.fields, T.StructField("row", T.LongType()), T.StructField("unit", T.LongType())]))


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches (unit, row, ...) that are of one unit each; a unit
    that lies in several batches gives several pieces."""
    for batch in batches:
        unit = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]])).tolist() if len(unit) else []
        for i, j in zip(starts, [*starts[1:], len(unit)], strict=False):
            yield batch.slice(i, j - i)


def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, rows): each piece's rows as compressed Arrow data, for the shuffle."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    for part in pieces(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema, options=options) as out:
            out.write_batch(part)
        yield pa.RecordBatch.from_arrays([part.column(0).slice(0, 1), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["unit", "rows"])


#: Kinds of n-grams.
PAIR, SINGLE = 0, 1


def answers(units: DataFrame, n_tokens: int) -> DataFrame:
    """(unit, piece, kind, segment, levels): a byte for each distinct n-gram
    of a piece in a hash range, in the order of the hashes: its level in the
    filter of all words and word pairs of the texts that are not held out.
    A piece is known by its first row."""
    segments = ranges(n_tokens)
    schema = pa.schema([("segment", pa.int32()), ("unit", pa.int64()), ("piece", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            unit, piece = part.column(0)[0].as_py(), part.column(1)[0].as_py()
            own = tokens(part.column(3))
            h = own.hashes()
            learnt = np.repeat(~part.column(2).to_numpy(zero_copy_only=False), np.diff(own.offsets))
            k = pair_hashes(h[own.which]) | learnt  # the low bits of hashes are 0
            k.sort()
            starts = np.flatnonzero(np.concatenate([[True], k[1:] >> np.uint64(16) != k[:-1] >> np.uint64(16)]))
            pairs = k[starts] & _KEPT, np.add.reduceat((k & np.uint64(1)).astype(np.int64), starts)
            used = own.counts() > 0
            singles = summed([single_hashes(h[used])], [np.bincount(own.which[learnt], minlength=len(h))[used]])
            for kind, (k, n) in ((PAIR, pairs), (SINGLE, singles)):
                of = segment_of(k, segments)
                starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])).tolist()
                ends = [*starts[1:], len(k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[starts].tolist(), pa.int32()), *(pa.array([x] * len(starts), t) for x, t in ((unit, pa.int64()), (piece, pa.int64()), (kind, pa.int32()))),
                     pa.array([packed_sorted(k[i:j]) for i, j in zip(starts, ends, strict=True)], pa.binary()),
                     pa.array([n[i:j].astype("<u4").tobytes() for i, j in zip(starts, ends, strict=True)], pa.binary())], schema=schema)

    def answer(table: pa.Table) -> pa.Table:
        k = [unpacked_sorted(x) for x in table.column("keys").to_pylist()]
        n = [np.frombuffer(x, "<u4").astype(np.int64) for x in table.column("counts").to_pylist()]
        keys, counts = summed(k, n)
        keys, counts = keys[counts > 0], counts[counts > 0]
        words = segment_words(counts)
        found = Filter(1, words, segment_bits(keys, counts, words)).level(np.concatenate(k)).astype(np.uint8)
        ends = np.cumsum([len(x) for x in k])
        return pa.table({**{c: table.column(c) for c in ("unit", "piece", "kind", "segment")},
                         "levels": pa.array([found[e - len(x):e].tobytes() for e, x in zip(ends, k, strict=True)], pa.binary())})

    return (units.select("unit", "row", "held_out", "text")
            .mapInArrow(gather, "segment int, unit long, piece long, kind int, keys binary, counts binary")
            .groupBy("segment").applyInArrow(answer, "unit long, piece long, kind int, segment int, levels binary"))


def model_scores(own: Tokens, pair_levels: np.ndarray, single_levels: np.ndarray, n: int, v: int) -> np.ndarray:
    """Sums, by text, of the log10 probabilities of its tokens, from the
    levels of the distinct pairs and single tokens in the order of their hashes."""
    if not len(own.which):
        return np.zeros(0)
    h = own.hashes()
    used = own.counts() > 0
    single = np.zeros(len(h))
    single[used] = level_count(single_levels.astype(np.int64))[np.unique(single_hashes(h[used]), return_inverse=True)[1]]
    here = single[own.which]  # the end token is the last
    before = np.concatenate([single[-1:], here[:-1]])  # what stands before a text's first token is an end token
    pairs = level_count(pair_levels.astype(np.int64))[np.unique(pair_hashes(h[own.which]), return_inverse=True)[1]]
    alone = (np.minimum(here, n) + 1) / (n + v + 1)
    return np.add.reduceat(np.log10((np.minimum(pairs, before) + PRIOR * alone) / (before + PRIOR)), own.offsets[:-1])


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    Null and empty texts are the end token alone.  Null ids count as the empty
    text for the fold.  Rows that repeat are counted and scored each.  Without
    any training text both counts are zero and every score is defined by the
    smoothing alone.
    """
    units = stored(in_units(_rows(docs, id_col, text_col)), "units", "zstd")
    counts = stored(word_counts(units.where(~F.col("held_out"))), "words")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(total["n"]), int(total["v"])
    context = docs.sparkSession.sparkContext
    # fewer than HEAVY words of MOST_LENGTH bytes at most
    frequent = (F.col("c") * HEAVY > F.lit(n)) & (F.octet_length("word") <= MOST_LENGTH)
    heavy = context.broadcast({bytes(r["word"]): float(np.log10(r["c"] + 1)) for r in counts.where(frequent).toLocalIterator()})

    def score(packets: pa.Table, replies: pa.Table) -> pa.Table:
        rows = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in packets.column("rows").to_pylist()]).sort_by("row")
        replies = replies.sort_by([(c, "ascending") for c in ("piece", "kind", "segment")])
        known, row = heavy.value, rows.column("row").to_numpy()
        piece, kind = replies.column("piece").to_numpy(), replies.column("kind").to_numpy()
        found = []
        firsts = np.unique(piece)
        at = np.searchsorted(row, firsts).tolist()
        for first, i, j in zip(firsts, at, [*at[1:], len(row)], strict=True):
            part = rows.slice(i, j - i)
            own = tokens(part.column("text").combine_chunks())
            pairs, singles = (np.frombuffer(b"".join(replies.column("levels").filter(pa.array((piece == first) & (kind == k))).to_pylist()), np.uint8)
                              for k in (PAIR, SINGLE))
            begin, words = own.offsets[:-1], own.distinct.to_pylist()
            logs = np.fromiter((known.get(w, -1.0) for w in words), float, len(words))[own.which]
            rare = logs < 0
            ends = np.concatenate([[0], np.cumsum(rare)])[own.offsets]
            found.append(pa.table(
                [part.column("id"), part.column("held_out"), part.column("row"), pa.array(np.diff(own.offsets), pa.int64()),
                 pa.array(np.add.reduceat((~rare).astype(np.int64), begin), pa.int64()),
                 pa.array(np.add.reduceat(np.maximum(logs, 0), begin), pa.float64()),
                 pa.array(model_scores(own, pairs, singles, n, v), pa.float64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), own.distinct.take(pa.array(own.which[rare])))],
                names=["id", "held_out", "row", "n_tokens", "n_heavy", "heavy_logs", "score", "rare"]))
        return pa.concat_tables(found)

    schema = T.StructType([units.schema[c] for c in ("id", "held_out", "row")]
                          + [T.StructField("n_tokens", T.LongType()), T.StructField("n_heavy", T.LongType()),
                             T.StructField("heavy_logs", T.DoubleType()), T.StructField("score", T.DoubleType()),
                             T.StructField("rare", T.ArrayType(T.BinaryType()))])
    texts = units.select("unit", "row", "id", "held_out", "text").mapInArrow(carried, "unit long, rows binary")
    scored = stored(texts.groupBy("unit").cogroup(answers(units, n).groupBy("unit")).applyInArrow(score, schema), "scored")
    others = (scored.select("row", F.explode("rare").alias("word")).join(counts, "word")
              .groupBy("row").agg(F.count(F.lit(1)).alias("n_rare"), F.sum(F.log10(F.col("c") + 1)).alias("rare_logs"))
              .withColumnRenamed("row", "of"))
    each = float(np.log10(n + v + 1))
    return (scored.drop("rare").join(others, F.col("row") == F.col("of"), "left").select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens",
        (F.col("n_heavy") + F.coalesce("n_rare", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("heavy_logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        "score"))
