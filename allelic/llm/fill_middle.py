"""Fill-in-middle: each text cut in prefix, middle and suffix at the
boundaries of its units, and put in another order behind sentinels.

The code points of a slice of texts are classes of characters; a letter that
begins a run and a letter that goes on with one are two classes, so the units
that begin before a place are a sum of ranks of the classes that begin a unit
(``UNITS``, ``WORDS``).  A wavelet matrix over the classes answers the ranks,
and bisection on that sum finds a cut.  What is cut is the text's bytes; the
place of a code point is a bisection on ranks of the bytes that begin one.

Which texts are cut, where and how follows from a hash of the document id, so
reruns and lost executors give the same rows.  There is no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelic.llm.token_store import valid_text
from allelic.llm.wavelet import BitRanks, WaveletMatrix, bisect_rank

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the texts that are cut, percent of those in suffix-prefix-middle order.
CUT, SPM = 90, 20
SEED = "1"
#: Bytes of text under one wavelet matrix; a longer text has one alone.
SLICE_BYTES = 4 * 1024 * 1024

OTHER, SPACE, DIGIT, MARK, HEAD, TAIL = range(6)
#: Classes that begin a unit: letter runs and every other character; letter runs alone, with what follows them.
UNITS, WORDS = (OTHER, SPACE, DIGIT, MARK, HEAD), (HEAD,)


def _classes() -> np.ndarray:
    of = np.full(256, OTHER, np.uint8)
    for c in range(128):
        of[c] = (HEAD if chr(c).isalpha() else DIGIT if chr(c).isdigit() else SPACE if c == 32 or 9 <= c <= 13
                 else MARK if 32 < c < 127 else OTHER)
    return of


_CLASS = _classes()


class Units:
    """Units of texts that lie one after the other in ``data``; ``begins`` are
    the byte places of the texts, and the end."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, starts: tuple[int, ...] = UNITS):
        lead = (data & 0xC0) != 0x80
        self.lead = BitRanks(lead)
        self.points = self.lead.rank(begins)
        kinds = _CLASS[data[lead]]
        goes_on = np.zeros(len(kinds), bool)
        if len(kinds):
            goes_on[1:] = (kinds[1:] == HEAD) & (kinds[:-1] == HEAD)
            goes_on[self.points[:-1][self.points[:-1] < len(kinds)]] = False
        kinds[goes_on] = TAIL
        self.matrix, self.starts = WaveletMatrix(kinds, 3), starts

    def before(self, at: np.ndarray) -> np.ndarray:
        """Units that begin before each place of the slice."""
        return sum(self.matrix.rank(kind, at) for kind in self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.before(self.points))

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Per text the code points of its first ``units`` units; what stands
        before its first unit goes with that one."""
        begin, end = self.points[:-1], self.points[1:]
        base = self.before(begin)
        size = self.before(end) - base
        found = np.where(units <= 0, begin, end)
        inside = np.flatnonzero((units > 0) & (units < size))
        if len(inside):
            wanted = base[inside] + units[inside] + 1
            found[inside] = bisect_rank(self.before, wanted, begin[inside], end[inside]) - 1
        return found - begin

    def byte(self, points: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Byte place of a code point of each text; its end, if it has no such."""
        place = self.points[text] + points
        out = np.full(len(place), 0, np.int64)
        inside = place < self.matrix.size
        out[inside] = self.lead.select(place[inside])
        return np.where(inside, out, -1)


def _draws(key: object, seed: str) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def _transform(keys: list, texts: pa.Array, cut: int, spm: int, seed: str, starts: tuple[int, ...]) -> list[tuple]:
    """(units, form, prefix, middle, output) of each text of a slice."""
    draws = np.array([_draws(k, seed) for k in keys], np.int64).reshape(-1, 4)
    marked = np.zeros(len(texts), bool)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(texts, sentinel).to_numpy(zero_copy_only=False)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    raw = b"".join(pc.cast(texts, pa.binary()).to_pylist())
    units = Units(np.frombuffer(raw, np.uint8), begins, starts)
    n = units.counts()
    plain = (sizes == 0) | marked | (draws[:, 2] % 100 >= cut)
    one, two = draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)
    first, second = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
    rows = np.arange(len(texts))
    to = [np.where(b < 0, begins[1:], b) for b in (units.byte(first, rows), units.byte(second, rows))]
    out = []
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for i in range(len(texts)):
        if plain[i]:
            out.append((int(n[i]), "plain", None, None, raw[begins[i]:begins[i + 1]]))
            continue
        x, y, z = raw[begins[i]:to[0][i]], raw[to[0][i]:to[1][i]], raw[to[1][i]:begins[i + 1]]
        form = "spm" if draws[i, 3] % 100 < spm else "psm"
        whole = (s + z + p + x + m + y) if form == "spm" else (p + x + s + z + m + y)
        out.append((int(n[i]), form, int(first[i]), int(second[i] - first[i]), whole))
    return out


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, cut: int = CUT, spm: int = SPM,
                   seed: str = SEED, starts: tuple[int, ...] = UNITS) -> DataFrame:
    """One row per document: doc_id, n (its units), form, prefix_chars,
    middle_chars (code points; null if plain), output.

    Null texts are empty ones; empty texts, texts that hold a sentinel and
    ``100 - cut`` percent of the others stay as they are (plain).  Repeated
    ids get the same draws; a null id draws as an empty one.  Bytes that are
    no UTF-8 are replaced.  Other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", pa.large_string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            begin = 0
            while begin < len(ids):
                before = ends[begin - 1] if begin else 0
                end = max(int(np.searchsorted(ends, before + SLICE_BYTES, side="right")), begin + 1)
                found = _transform(ids[begin:end], texts.slice(begin, end - begin), cut, spm, seed, starts)
                columns = [pa.array(ids[begin:end], pa.int64()), *(
                    pa.array(c, t.type) for c, t in zip(list(zip(*found, strict=True))[:4], list(schema)[1:5], strict=True)),
                    pa.array([f[4] for f in found], pa.large_binary()).cast(pa.large_string())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema).cast(
                    pa.schema([*list(schema)[:5], pa.field("output", pa.string())]))
                begin = end

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), valid_text(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"))


def restored(output: Column, form: Column) -> Column:
    """The exact text from an output and its form.  A cut text holds no
    sentinel and a sentinel begins with the one ``<`` it has, so the first
    match of each is the sentinel that was put in."""
    size = len(PREFIX)

    def parts(second: str) -> list[Column]:
        at, end = F.locate(second, output), F.locate(MIDDLE, output)
        return [F.substring(output, F.lit(size + 1), at - size - 1),
                F.substring(output, at + size, end - at - size), F.substr(output, end + size)]
    x, z, y = parts(SUFFIX)
    z2, x2, y2 = parts(PREFIX)
    return (F.when(form == "psm", F.concat(x, y, z)).when(form == "spm", F.concat(x2, y2, z2)).otherwise(output))


def fill_digest(docs: DataFrame) -> DataFrame:
    """The operator's rows with digests of the outputs and of the texts
    rebuilt from them."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def _draw(i: int) -> str:
    return f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)"


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
             {_draw(0)} AS h1, {_draw(1)} AS h2, {_draw(2)} AS h3, {_draw(3)} AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                          OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
             array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""
