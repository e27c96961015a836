"""Token-id files: documents in ascending id order, each compressed on its
own with a shared zstandard dictionary.

A file is: magic, bytes per token id, SHA-256 of the dictionary, the
documents' frames, then a compressed index (document ids, token counts, frame
offsets) and its place.  The dictionary lies beside the files under its hash.
One document is read by one index look-up and one range read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelic.llm.common import fresh_folder, stored
from allelic.llm.files import open_read, open_write, own_name, read_range

MAGIC = b"TOKIDS1\n"
END_ID = 1
LEVEL = 3
#: The dictionary is fitted on about so many documents (never more than twice), of each so many ids at most.
SAMPLE_DOCS, SAMPLE_IDS = 1024, 4096
DICTIONARY_BYTES = 64 * 1024
#: Characters of the text by which rows that repeat an id are ordered.
LEAD = 32
#: Distinct pieces whose ids a Python worker remembers, bytes of text encoded together.
REMEMBERED, SLICE_BYTES = 300_000, 12 * 1024 * 1024

#: Sets pieces apart for the tokenizer.
APART = "\x01"
#: Punctuation but ' < > |, a piece that begins and ends in an ASCII letter or digit, punctuation.
_WRAPPED = r"(?s)^(?P<a>[!-&(-/:;=?@\[-`{}~]*)(?P<c>[0-9A-Za-z](?:.*[0-9A-Za-z])?)(?P<z>[!-&(-/:;=?@\[-`{}~]*)$"

_LETTERS = re.compile("[a-zà-öø-ÿ]+")
_HEAD, _TAIL = "<8sB32s", "<QQ8s"
_encoders: dict[str, Encoder] = {}


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``which`` of ``flat`` one after the other, and their sizes."""
    size = sizes[which]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 2 ** 31 else np.int64
    places = np.repeat((starts[which] - (ends - size)).astype(kind), size)
    places += np.arange(total, dtype=kind)
    return flat[places], size


#: The one normaliser and pre-tokenizer whose texts may be encoded word by word; fixed values of the tokenizer's format.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def by_words(path: str) -> bool:
    """Whether the tokenizer file normalises and splits in the form that ``Encoder`` knows."""
    with open(path, encoding="utf-8") as file:
        form = json.load(file)
    return form.get("normalizer") == _NORMALIZER and form.get("pre_tokenizer") == _PRE_TOKENIZER


class Encoder:
    """Ids of texts, word by word; of tokenizers of another form, text by text.

    The tokenizer drops white space and never merges across it, so the ids of
    a text are those of its words.  Of a word, ASCII punctuation around
    letters or digits is a piece of its own, and ASCII letters have the ids of
    their lower case.  So each distinct piece of some texts is encoded once,
    if it wasn't met before; the tokenizer gets the new pieces in one text, set
    apart by a control character that is one token.  Pieces of lower-case
    letters need no normalising or splitting, so they go to the same model
    without these steps.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 2 ** 16 else "<u4")
        self.by_words = by_words(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.apart = self._ids(APART)
        if any(self._ids(w).tobytes() != self._ids(w, self.plain).tobytes() for w in ("the", "straße", "éàñ", APART)):
            self.plain = self.tokenizer
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str, tokenizer=None) -> np.ndarray:
        return np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        found = {}
        groups: dict[bool, list[str]] = {True: [], False: []}
        for p in pieces if len(self.apart) == 1 else ():
            if APART not in p:
                groups[_LETTERS.fullmatch(p) is not None].append(p)
        for plain, part in ((k, g[at:at + 512]) for k, g in groups.items() for at in range(0, len(g), 512)):
            ids = self._ids(f" {APART} ".join(part), self.plain if plain else None)
            cuts = np.flatnonzero(ids == self.apart[0])
            if len(cuts) == len(part) - 1:
                size, raw = self.dtype.itemsize, ids.tobytes()
                for p, i, j in zip(part, [-1, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                    found[p] = raw[(i + 1) * size:j * size]
        return found | {p: self._ids(p).tobytes() for p in pieces if p not in found}

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        ids = list(map(self.known.get, pieces))
        if None in ids:
            new = self._new([p for p, x in zip(pieces, ids, strict=True) if x is None])
            if len(self.known) < REMEMBERED:
                self.known.update(new)
            ids = [new[p] if x is None else x for p, x in zip(pieces, ids, strict=True)]
        return ids

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and their numbers."""
        cut = pc.extract_regex(words, _WRAPPED)
        apart = pc.and_(cut.is_valid(), pc.invert(pc.match_substring(words, "<|")))
        three = [pc.if_else(apart, x, y) for x, y in
                 ((cut.field("a"), ""), (pc.ascii_lower(cut.field("c")), words), (cut.field("z"), ""))]
        coded = pa.concat_arrays([pc.cast(x, pa.string()) for x in three]).dictionary_encode()
        found = self._pieces(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(found), self.dtype)
        order = coded.indices.to_numpy().reshape(3, -1).T.ravel()
        ids, size = _gather(flat, np.cumsum(sizes) - sizes, sizes, order)
        return ids, size.reshape(-1, 3).sum(axis=1)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Serialized ids of each text and the end id."""
        if not self.by_words:
            coded = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            return [np.array([*x.ids, END_ID], self.dtype).tobytes() for x in coded]
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        flat, sizes = self._words(coded.dictionary)
        ids, size = _gather(flat, np.cumsum(sizes) - sizes, sizes, coded.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(size)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        raw, width = ids.tobytes(), self.dtype.itemsize
        end = np.array([END_ID], self.dtype).tobytes()
        return [raw[i * width:j * width] + end for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def encode_batch(self, texts: pa.Array) -> Iterator[tuple[int, bytes]]:
        """(row, ids) of each text, some ``SLICE_BYTES`` of text at a time."""
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < len(texts):
            before = size[begin - 1] if begin else 0
            end = max(int(np.searchsorted(size, before + SLICE_BYTES, side="right")), begin + 1)
            yield from enumerate(self.encode(texts.slice(begin, end - begin)), begin)
            begin = end


def encoder(path: str) -> Encoder:
    """The worker's own encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def valid_text(text_col: str) -> Column:
    """The text, null as empty, bytes that are no UTF-8 replaced."""
    return F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit("")))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def train_dictionary(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A zstandard dictionary fitted on the serialized ids of a hashed sample
    of documents.  Too few samples to train on: their ids themselves; none:
    no dictionary, which is the empty one."""
    every = max(1, docs.count() // SAMPLE_DOCS)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(tokenizer)
        for batch in batches:
            ids = [x[:SAMPLE_IDS * one.dtype.itemsize] for _, x in one.encode_batch(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    rows = (docs.select(valid_text(text_col).alias("t"), F.xxhash64(id_col, text_col).alias("h"))
            .where(F.pmod("h", F.lit(every)) == 0).orderBy("h").select("t").limit(2 * SAMPLE_DOCS)
            .mapInArrow(sample, "ids binary").collect())
    samples = sorted(bytes(r["ids"]) for r in rows)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files; returns one row per file: part (in order of ids),
    path, dictionary (its path), n_docs, n_tokens.

    Null and empty texts are the end id alone.  Null ids come last.  Rows that
    repeat an id follow one another in order of their texts' first ``LEAD``
    characters, then of a hash of the text; ranges are cut among them, too, so
    one id or one text is no single task or file.
    """
    tokenizer = tokenizer or default_tokenizer()
    data = train_dictionary(docs, tokenizer, id_col, text_col)
    digest = hashlib.sha256(data).digest()
    dictionary = f"{folder}/dictionary-{digest.hex()}.zdict"
    with open_write(dictionary) as out:
        out.write(data)
    order = [F.col("id").asc_nulls_last(), F.substring("text", 1, LEAD), F.xxhash64("text"), F.col("row")]
    ranged = (docs.select(F.col(id_col).cast("long").alias("id"), valid_text(text_col).alias("text"),
                          F.monotonically_increasing_id().alias("row"))
              .repartitionByRange(*order).sortWithinPartitions(*order))
    manifest = pa.schema([("part", pa.int32()), ("path", pa.string()), ("dictionary", pa.string()),
                          ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(tokenizer)
        with open_read(dictionary) as source:
            squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(source.read()))
        out, path, at = None, "", struct.calcsize(_HEAD)
        ids, counts, offsets = [], [], []
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for row, tokens in one.encode_batch(batch.column(1)):
                if out is None:
                    path = own_name(folder, "tokens", ".tok")
                    out = open_write(path)
                    out.write(struct.pack(_HEAD, MAGIC, one.dtype.itemsize, digest))
                frame = squeeze.compress(tokens)
                out.write(frame)
                ids.append(keys[row])
                counts.append(len(tokens) // one.dtype.itemsize)
                offsets.append(at)
                at += len(frame)
        if out is not None:
            none = np.array([x is None for x in ids], np.uint8)
            index = zstandard.compress(none.tobytes() + np.array([x or 0 for x in ids], "<i8").tobytes()
                                       + np.array(counts, "<i8").tobytes() + np.array([*offsets, at], "<i8").tobytes())
            out.write(index + struct.pack(_TAIL, at, len(ids), MAGIC))
            out.close()
            yield pa.RecordBatch.from_pylist([{
                "part": TaskContext.get().partitionId(), "path": path, "dictionary": dictionary,
                "n_docs": len(ids), "n_tokens": sum(counts)}], schema=manifest)

    return stored(ranged.mapInArrow(write, "part int, path string, dictionary string, n_docs long, n_tokens long"), "tokens")


class TokenFile:
    """Random access to one file's documents."""

    def __init__(self, path: str, dictionary: str):
        self.source = open_read(path)
        magic, width, digest = struct.unpack(_HEAD, read_range(self.source, 0, struct.calcsize(_HEAD)))
        size, tail_size = self.source.size(), struct.calcsize(_TAIL)
        at, n, tail = struct.unpack(_TAIL, read_range(self.source, size - tail_size, tail_size))
        with open_read(dictionary) as source:
            data = source.read()
        if magic != MAGIC or tail != MAGIC or hashlib.sha256(data).digest() != digest:
            raise ValueError(f"{path}: not a token file, or of another dictionary")
        index = zstandard.decompress(read_range(self.source, at, size - tail_size - at))
        none = np.frombuffer(index, np.uint8, n)
        self.ids = [None if x else int(i) for x, i in zip(none, np.frombuffer(index, "<i8", n, n), strict=True)]
        self.counts = np.frombuffer(index, "<i8", n, 9 * n)
        self.offsets = np.frombuffer(index, "<i8", n + 1, 17 * n)
        self.dtype = np.dtype(f"<u{width}")
        self.expand = zstandard.ZstdDecompressor(dict_data=_dictionary(data))

    def document(self, i: int) -> np.ndarray:
        """Token ids of the i-th document of the file."""
        begin, end = int(self.offsets[i]), int(self.offsets[i + 1])
        return np.frombuffer(self.expand.decompress(read_range(self.source, begin, end - begin)), self.dtype)


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as 32-bit integers)."""
    # one small row per file; the running sum orders nothing larger
    files = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, dictionary, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file = TokenFile(path, dictionary)
                found = []
                for i, doc_id in enumerate(file.ids):
                    ids = file.document(i)
                    if len(ids) != file.counts[i]:
                        raise ValueError(f"{path}: document {i} has {len(ids)} ids, its index {file.counts[i]}")
                    found.append({"doc_id": doc_id, "start": start, "n_tokens": len(ids),
                                  "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())})
                    start += len(ids)
                    if len(found) == 10_000:
                        yield pa.RecordBatch.from_pylist(found, schema=schema)
                        found = []
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    return (files.select("path", "dictionary", "before").repartitionByRange("before")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the documents' token files and reads every document back."""
    return read_tokens(write_tokens(docs, fresh_folder(docs.sparkSession, "tokens"), tokenizer))
