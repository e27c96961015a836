"""Documents packed into sequences of a fixed room, by patterns of lengths.

Spark encodes the texts and writes one narrow row per piece; the task that
writes a piece numbers it among its task's pieces of the same length.  The
histogram of lengths, at most ``room`` rows, goes to the driver, where
``pattern_packing.plan`` decides how many sequences of which contents there
are.  A piece's place follows from its number among all of its length: the
pieces of earlier tasks (a prefix sum over one row per task and length) plus
its own number.  The plan is a table of runs, "pieces ``first`` and following
of length ``l`` stand in sequences ``base`` and following", whose size does not
depend on the number of pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelic.llm.common import stored
from allelic.llm.pattern_packing import plan
from allelic.llm.token_store import valid_text

ROOM, END_ID = 1024, 2
#: Distinct words whose ids a Python worker remembers; bytes of text encoded together.
REMEMBERED, SLICE_BYTES = 300_000, 8 * 1024 * 1024
#: Stands between words while a slice is split; a text that holds it is encoded whole.
APART = "\x01"
#: Where the pre-tokenizer always begins a piece: at a space before a letter or a visible ASCII character, and at ASCII
#: punctuation (but ' < > |, which contractions and special tokens have) after a letter or digit.
_SPACE, _MARK = r"()( [!-~\p{L}])", r"([\p{L}\p{N}])([!-&(-/:;=?@\[-`{}~])"
_PARTED = r"\1" + APART + r"\2"
_PLAIN = re.compile(r" ?[!-~À-ɏ]+")
_encoders: dict[str, WordEncoder] = {}
_SHIFT = 48


class WordEncoder:
    """Ids of texts, word by word.

    A byte-level pre-tokenizer without a normalizer begins a piece at every
    space before a letter or visible character and between a letter or digit
    and punctuation, and looks no further back, so the ids of a text are those
    of its parts between such places.  Words are the distinct parts between
    spaces; each distinct part of them is encoded once.  Tokenizers of any
    other form get whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        before = spec.get("pre_tokenizer") or {}
        self.by_word = (
            spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and spec.get("truncation") is None and spec.get("padding") is None
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                        for t in spec.get("added_tokens", ())))
        ids = self._ids(["\n", "a\n b", "a\n,"])
        lone = len(ids[0]) == 1 and all((x == ids[0][0]).sum() == 1 for x in ids)
        self.line = ids[0][0] if self.by_word and lone else None
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of parts: those of visible characters as lines of one text, a
        line's end being one id of its own, the others one by one."""
        plain, other = [], []
        for p in parts:
            (plain if self.line is not None and _PLAIN.fullmatch(p) else other).append(p)
        for at in range(0, len(plain), 1024):
            some = plain[at:at + 1024]
            ids = self._ids(["\n".join(some)])[0]
            cuts = np.flatnonzero(ids == self.line)
            if len(cuts) != len(some) - 1:
                other += some
                continue
            raw = ids.tobytes()
            for p, i, j in zip(some, [-1, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                yield p, raw[4 * i + 4:4 * j]
        for p, ids in zip(other, self._ids(other), strict=True):
            yield p, ids.tobytes()

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts one after the other, and their numbers."""
        names = parts.to_pylist()
        found = list(map(self.known.get, names))
        if None in found:
            new = dict(self._new([p for p, x in zip(names, found, strict=True) if x is None]))
            if len(self.known) < REMEMBERED:
                self.known.update(new)
            found = [new[p] if x is None else x for p, x in zip(names, found, strict=True)]
        return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4

    def _split(self, texts: pa.Array, boundary: str, inner) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers of texts that are cut at ``boundary``;
        ``inner`` gives those of the distinct pieces."""
        cut = pc.split_pattern(pc.replace_substring_regex(texts, boundary, _PARTED), APART)
        coded = cut.flatten().dictionary_encode()
        flat, sizes = inner(coded.dictionary)
        ids, size = _gather(flat, sizes, coded.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(size)])[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        return ids, np.diff(ends)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and where each begins, with
        the end."""
        if not self.by_word or pc.any(pc.match_substring(texts, APART)).as_py():
            found = self._ids(texts.to_pylist())
            ids, sizes = np.concatenate([np.zeros(0, "<u4"), *found]), np.array([len(x) for x in found], np.int64)
        else:
            ids, sizes = self._split(texts, _SPACE, lambda words: self._split(words, _MARK, self._parts))
        return ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _gather(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``which`` of ``flat`` one after the other, and their sizes."""
    size = sizes[which]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 2 ** 31 else np.int64
    places = np.repeat(((np.cumsum(sizes) - sizes)[which] - (ends - size)).astype(kind), size)
    places += np.arange(total, dtype=kind)
    return flat[places], size


def word_encoder(path: str) -> WordEncoder:
    """The worker's own encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


_PIECES = pa.schema([("part", pa.int32()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()),
                     ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _cut(keys: np.ndarray, ids: np.ndarray, begins: np.ndarray, room: int, end_id: int, numbers: np.ndarray) -> pa.RecordBatch:
    """The pieces of some documents.  ``numbers`` counts the task's pieces by length."""
    total = np.diff(begins) + 1
    n = -(-total // room)
    doc = np.repeat(np.arange(len(total)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = total - room * (n - 1)
    length = np.where(piece == 0, first[doc], room)
    start = np.where(piece == 0, 0, first[doc] + room * (piece - 1))
    raw, end = ids.astype("<u4").tobytes(), np.array([end_id], "<u4").tobytes()
    low = (begins[doc] + start) * 4
    last = piece == n[doc] - 1
    crc = [zlib.crc32(raw[a:a + 4 * (s - z)] + (end if z else b"")) for a, s, z in
           zip(low.tolist(), length.tolist(), last.tolist(), strict=True)]
    order = np.argsort(length, kind="stable")
    lengths, at, number = np.unique(length[order], return_index=True, return_counts=True)
    nth = np.empty(len(length), np.int64)
    nth[order] = np.arange(len(length)) - np.repeat(at, number) + np.repeat(numbers[lengths], number)
    numbers[lengths] += number
    part = np.full(len(doc), TaskContext.get().partitionId(), np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(part), pa.array(nth), keys.take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
         pa.array(crc, pa.int64())], schema=_PIECES)


def pieces(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", *,
           room: int = ROOM, end_id: int = END_ID) -> DataFrame:
    """A written table with one row per piece: doc_id, piece, start, length,
    ids_crc32; part and nth number the pieces of a length within a task.

    A document's ids, with the end id, are cut into pieces of ``room``; what
    is over comes first.  Null and empty texts are the end id alone.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, numbers = word_encoder(path), np.zeros(room + 1, np.int64)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            begin = 0
            while begin < len(texts):
                before = ends[begin - 1] if begin else 0
                end = max(int(np.searchsorted(ends, before + SLICE_BYTES, side="right")), begin + 1)
                ids, begins = encoder.encode(texts.slice(begin, end - begin))
                yield _cut(keys.slice(begin, end - begin), ids, begins, room, end_id, numbers)
                begin = end

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), valid_text(text_col).alias("text"))
    return stored(rows.mapInArrow(run, "part int, nth long, doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")


def runs(groups: list[tuple[int, tuple[tuple[int, int], ...]]]) -> np.ndarray:
    """The plan by length: rows (length and first number as one key, base
    sequence, times in a sequence, offset), in order of the key."""
    base, numbered, out = 0, {}, []
    for number, held in groups:
        offset = 0
        for length, times in held:
            first = numbered.get(length, 0)
            out.append((length << _SHIFT | first, base, times, offset))
            numbered[length] = first + number * times
            offset += length * times
        base += number
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, room: int = ROOM) -> DataFrame:
    """The pieces with sequence_id and offset: as few sequences as the plan
    finds, none over ``room``, offsets without gaps."""
    histogram = [(r["length"], r["count"]) for r in pieces.groupBy("length").count().collect()]  # room rows at most
    table = runs(plan(histogram, room))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("part").alias("_part"), F.col("length").alias("_length"),
                      F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long").alias("_before")))
    numbered = (pieces.join(before, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length")))
                .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("nth")).alias("nth")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, base, times, offset = table.T
        for batch in batches:
            length, nth = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            run = np.searchsorted(keys, length << _SHIFT | nth, side="right") - 1
            at = nth - (keys[run] & ((1 << _SHIFT) - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(base[run] + at // times[run]), pa.array(offset[run] + at % times[run] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, tokenizer))
