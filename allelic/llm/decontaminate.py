"""Benchmark decontamination with an FM-index per shard of the documents.

A shard is a run of documents whose words become symbols: the benchmark's
words have numbers, all other words and the documents' ends are separators,
across which no phrase reaches.  Over the shard's suffix array the index keeps
the last column (BWT) as a wavelet matrix with rank directories, and sampled
suffix positions.  All benchmark windows are searched backwards at once by
ranks; occurrences are located by stepping to a sampled position, and the
spans they cover are merged per document.

The benchmark is dealt into blocks of bounded size, files that every task
reads one after the other; neither it nor the documents pass the driver.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allelic.llm.common import fresh_folder, stored
from allelic.llm.files import open_read, open_write, own_name

WINDOW = 10
#: Words of a shard; characters of the benchmark in a block; text positions from sample to sample.
SHARD, BLOCK_CHARS, SAMPLED = 1 << 19, 32 * 1024 * 1024, 16
#: Occurrences located at once.
LOCATE = 1 << 18

#: A-Z to lower case; every other ASCII character that is no digit or letter to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Phrases:
    """A block's windows as rows of symbols, and the items of each."""

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple, set[str]] = {}
        for item, words in items:
            symbols = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for at in range(max(len(symbols) - WINDOW + 1, min(len(symbols), 1))):
                windows.setdefault(tuple(symbols[at:at + WINDOW]), set()).add(item)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.symbols = np.zeros((len(windows), WINDOW), np.int64)
        for row, w in zip(self.symbols, windows, strict=True):
            row[:len(w)] = w
        self.items = [sorted(x) for x in windows.values()]

    def encode(self, words: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a text that ends in 0, each 0 being smaller
    than all other symbols and than any later 0.  Prefix doubling; only the
    positions whose order is still open are sorted again."""
    n = len(text)
    key = np.where(text == 0, np.cumsum(text == 0) - 1, text + n)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    group = np.flatnonzero(new)[np.cumsum(new) - 1]  # place of its group's first member
    rank = np.empty(n, np.int64)
    rank[order] = group
    alone = new & np.concatenate([new[1:], [True]])
    open_at, step = np.flatnonzero(~alone), 1
    while len(open_at):
        who = order[open_at]
        key = rank[who] * n + rank[who + step]
        by = np.argsort(key, kind="stable")
        who, key = who[by], key[by]
        order[open_at] = who  # groups keep their places, so the places stay in order
        new = np.concatenate([[True], key[1:] != key[:-1]])
        group = open_at[np.flatnonzero(new)[np.cumsum(new) - 1]]
        rank[who] = group
        alone = new & np.concatenate([new[1:], [True]])
        open_at, step = open_at[~alone], step * 2
    return order


class _Bits:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(len(bits) // 64 * 64 + 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """A sequence of symbols with ``occ(c, i)``: how often c stands before i."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, _Bits, int]] = []
        for shift in reversed(range(max(int(largest).bit_length(), 1))):
            ones = (symbols >> shift) & 1 == 1
            self.levels.append((shift, _Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def _down(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((c >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def occ(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(c, at) - self._down(c, np.zeros_like(at))


class FMIndex:
    def __init__(self, text: np.ndarray, largest: int):
        """``text``: symbols 1 to ``largest``, and 0 as separator and at the end."""
        order = suffix_array(text)
        self.last = text[order - 1]
        self.wavelet = Wavelet(self.last, largest)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))])
        # a position behind a separator cannot be stepped over, so it is sampled too
        kept = (order % SAMPLED == 0) | (self.last == 0)
        self.kept = _Bits(kept)
        self.places = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, from, to): the suffix ranges of the phrases that occur."""
        which = np.arange(len(phrases))
        c = phrases[which, lengths - 1]
        low, high = self.first[c], self.first[c + 1]
        for back in range(2, WINDOW + 1):
            which, low, high = (x[low < high] for x in (which, low, high))
            on = lengths[which] >= back
            c = phrases[which[on], lengths[which[on]] - back]
            low[on] = self.first[c] + self.wavelet.occ(c, low[on])
            high[on] = self.first[c] + self.wavelet.occ(c, high[on])
        found = low < high
        return which[found], low[found], high[found]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix array rows."""
        out, steps, left = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        while len(left):
            known = self.kept.get(rows)
            out[left[known]] = self.places[self.kept.rank(rows[known])] + steps
            rows, left = rows[~known], left[~known]
            c = self.last[rows]
            rows = self.first[c] + self.wavelet.occ(c, rows)
            steps += 1
        return out


def search_shard(pieces: list[tuple[int, int, list[bytes]]], phrases: Phrases) -> list[np.ndarray]:
    """Occurrences of the phrases in pieces (document, number of the first
    word, words): arrays of document, first word and phrase."""
    none = [np.zeros(0, np.int64)] * 3
    if not pieces or not phrases.items:
        return none
    symbols = np.concatenate([x for _, _, words in pieces for x in (phrases.encode(words), [0])])
    kept = (symbols > 0) | np.concatenate([[True], symbols[:-1] > 0])  # one of each run of separators
    kept[-1] = True
    places = np.flatnonzero(kept)
    index = FMIndex(symbols[kept], len(phrases.vocabulary))
    which, low, high = index.search(phrases.symbols, phrases.lengths)
    sizes = high - low
    begins = np.cumsum([0] + [len(words) + 1 for _, _, words in pieces])
    docs = np.array([d for d, _, _ in pieces])
    shifts = np.array([s for _, s, _ in pieces])
    ends, out = np.cumsum(sizes), []
    for at in range(0, int(sizes.sum()), LOCATE):
        nth = np.arange(at, min(at + LOCATE, int(sizes.sum())))
        of = np.searchsorted(ends, nth, side="right")
        place = places[index.locate(high[of] - (ends[of] - nth))]
        piece = np.searchsorted(begins, place, side="right") - 1
        out.append([docs[piece], place - begins[piece] + shifts[piece], which[of]])
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else none


def write_phrases(benchmark: DataFrame, folder: str, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The benchmark's items as block files; one row (path) per file.  A block
    ends beyond ``BLOCK_CHARS`` bytes of text."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, size, paths = [], 0, []

        def flush():
            paths.append(own_name(folder, "phrases", ".json.zst"))
            with open_write(paths[-1]) as out:
                out.write(zstandard.compress(json.dumps(items).encode()))

        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if words := words_of(text):
                    items.append([item, [w.decode("utf-8", "surrogateescape") for w in words]])
                    size += len(text)
                if size > BLOCK_CHARS:
                    flush()
                    items, size = [], 0
        if items:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("binary").alias("text"))
    return stored(rows.mapInArrow(write, "path string"), "phrases")


def read_phrases(path: str) -> Phrases:
    with open_read(path) as source:
        items = json.loads(zstandard.decompress(source.read()))
    return Phrases([(i, [w.encode("utf-8", "surrogateescape") for w in words]) for i, words in items])


def _shards(texts: list[bytes | None]) -> Iterator[tuple[list[tuple[int, int, list[bytes]]], list[int]]]:
    """Pieces of about ``SHARD`` words; a longer text is cut into pieces that
    overlap by a window less a word.  With each shard the numbers of words of
    the texts that begin in it."""
    pieces, counts, size = [], [], 0
    for at, text in enumerate(texts):
        words = words_of(text)
        counts.append(len(words))
        if len(words) <= SHARD:
            pieces.append((at, 0, words))
        for begin in range(0, len(words), SHARD) if len(words) > SHARD else ():
            yield [(at, begin, words[begin:begin + SHARD + WINDOW - 1])], []
        size += min(len(words), SHARD)
        if size >= SHARD:
            yield pieces, counts
            pieces, counts, size = [], [], 0
    yield pieces, counts


def find_hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with _llm_words (number of words),
    _llm_spans (merged hit spans, word numbers, end exclusive) and _llm_items
    (items with occurring windows, sorted as strings).

    Null texts have no words.  Items without words have no window; null item
    ids are the empty string; items that repeat an id count once.
    """
    folder = fresh_folder(docs.sparkSession, "phrases")
    paths = [r["path"] for r in write_phrases(benchmark, folder).collect()]  # one per 32 MB of benchmark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = read_phrases(paths[0]) if len(paths) == 1 else None
        for batch in batches:
            counts: list[int] = []
            covers, pairs = [], []
            for pieces, new in _shards(batch.column(0).to_pylist()):
                counts += new
                for path in paths:
                    phrases = only or read_phrases(path)
                    doc, word, which = search_shard(pieces, phrases)
                    covers.append(np.stack([doc, word, word + phrases.lengths[which]], 1))
                    seen = np.unique(np.stack([doc, which], 1), axis=0)
                    pairs += [(int(d), item) for d, w in seen for item in phrases.items[w]]
            spans: list[list[list[int]]] = [[] for _ in counts]
            items: list[set[str]] = [set() for _ in counts]
            cover = np.unique(np.concatenate(covers), axis=0) if covers else np.zeros((0, 3), np.int64)
            for d, begin, end in cover.tolist():
                if spans[d] and begin <= spans[d][-1][1]:
                    spans[d][-1][1] = max(end, spans[d][-1][1])
                else:
                    spans[d].append([begin, end])
            for d, item in pairs:
                items[d].add(item)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                names=[*keep, "_llm_words", "_llm_spans", "_llm_items"])

    rows = docs.select(F.col(text_col).cast("binary").alias("_llm_text"), *[F.col(c) for c in keep])
    schema = (rows.drop("_llm_text").schema.add("_llm_words", "long").add("_llm_spans", T.ArrayType(T.ArrayType(T.LongType())))
              .add("_llm_items", T.ArrayType(T.StringType())))
    return rows.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    hit = F.aggregate("_llm_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return (find_hits(docs, benchmark, ["doc_id"])
            .select("doc_id", F.col("_llm_words").alias("n_words"), hit.alias("n_hit"),
                    F.size("_llm_items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "_llm_items"), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any hit word, with all columns."""
    found = find_hits(docs, benchmark, docs.columns)
    return found.where(F.size("_llm_spans") == 0).select(*docs.columns)


ORACLE = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + 10], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(greatest(len(w) - 9, least(len(w), 1)))) AS i FROM item)),
doc AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)),
sizes AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT rid, i, n, array_to_string(w[i + 1 : i + n], ' ') AS phrase
  FROM (SELECT rid, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM doc, sizes)),
occ AS (SELECT rid, i, win.n AS n, item FROM place JOIN win ON place.n = win.n AND place.phrase = win.phrase),
hit AS (
  SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM occ) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM occ GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
