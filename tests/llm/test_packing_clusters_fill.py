"""Packing, centroid clustering and fill-in-the-middle against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from allelic.llm import centroids, fill_middle, packing, pattern_packing
from allelic.llm.common import table
from allelic.llm.wavelet import BitRanks, WaveletMatrix
from tests.llm.conftest import SF001, odd_rows

ROWS = [(i, t) for i, t, _ in odd_rows()]


def same(got, expected):
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, expected), key=str)


# --- packing -------------------------------------------------------------------
def plain_pieces(rows, room=1024):
    from tokenizers import Tokenizer
    tokenizer, out = Tokenizer.from_file(packing.default_tokenizer()), []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        cut = len(ids) % room or room
        start = 0
        for n, part in enumerate([ids[:cut], *(ids[a:a + room] for a in range(cut, len(ids), room))]):
            out.append((i, n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
            start += len(part)
    return out


def check_sequences(rows, room=1024):
    """Offsets without gaps, none over the room; the number of sequences."""
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= room
    return len(held)


@pytest.mark.parametrize("which", ["table", "odd"])
def test_packing(spark, odd, which):
    docs = table(spark, SF001, "documents") if which == "table" else odd
    rows = packing.packed_documents(docs).collect()
    same([r[:5] for r in rows], plain_pieces([(r["doc_id"], r["text"]) for r in docs.collect()]))
    least = -(-sum(r["length"] for r in rows) // 1024)
    assert check_sequences(rows) <= least + 2


def test_packing_empty_and_one_key(spark, empty):
    assert packing.packed_documents(empty).count() == 0
    rows = packing.packed_documents(spark.createDataFrame([(7, "the same text")] * 3000, "doc_id long, text string").repartition(4)).collect()
    assert len(rows) == 3000 and {r["doc_id"] for r in rows} == {7}
    assert check_sequences(rows) == -(-3000 // (1024 // rows[0]["length"]))


def test_word_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer
    parts = [" ", "  ", "\n", "\t", " ", "　", "\x0b", "a", "é", "Z", "1", "'s", "'ll", "<|endoftext|>", ".", "--", "日",
             "\U0001f600", "\x00", " the", " \n", "\x01"]
    draw = random.Random(5)
    texts = ["".join(draw.choice(parts[:-1]) for _ in range(draw.randint(0, 40))) for _ in range(3000)] + ["a \x01 b"]
    one, tokenizer = packing.WordEncoder(packing.default_tokenizer()), Tokenizer.from_file(packing.default_tokenizer())
    assert one.by_word
    for part in (texts[:-1], texts):
        ids, begins = one.encode(pa.array(part))
        for i, t in enumerate(part):
            assert ids[begins[i]:begins[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    one, tokenizer = packing.WordEncoder(path), Tokenizer.from_file(path)
    assert not one.by_word
    ids, begins = one.encode(pa.array(["Some Words, 'tis", "", "ÀÉ  x"]))
    assert ids.tolist() == [x for t in ("Some Words, 'tis", "", "ÀÉ  x") for x in tokenizer.encode(t, add_special_tokens=False).ids]
    assert begins[0] == 0 and len(begins) == 4


@pytest.mark.parametrize("lengths, room, over", [
    (np.random.default_rng(1).integers(1, 1025, 20_000), 1024, 8), (np.full(1000, 700), 1024, 0), (np.arange(1, 40).repeat(500), 1024, 1),
    (np.array([5, 5, 3, 2]), 8, 0), (np.array([8]), 8, 0), (np.array([600, 424, 424, 300, 300]), 1024, 0)])
def test_plan_places_every_piece(lengths, room, over):
    values, numbers = np.unique(lengths, return_counts=True)
    groups = pattern_packing.plan(list(zip(values.tolist(), numbers.tolist(), strict=True)), room)
    held = defaultdict(int)
    for number, content in groups:
        assert number > 0 and sum(n * t for n, t in content) <= room
        for n, t in content:
            held[n] += number * t
    assert dict(held) == dict(zip(values.tolist(), numbers.tolist(), strict=True))
    alone = (lengths > room // 2).sum()
    least = max(-(-lengths.sum() // room), alone)
    assert sum(n for n, _ in groups) <= least * 1.005 + over


def test_fit_is_the_least_squares_solution():
    rows = pattern_packing.patterns(np.array([200, 300, 324, 400, 424, 500, 524]), 1024)
    assert {tuple(sorted(x for x in r if x)) for r in rows.tolist()} == {
        (200, 324, 500), (200, 300, 524), (200, 400, 424), (300, 300, 424), (300, 324, 400), (500, 524)}
    goal = np.zeros(1025)
    for r, times in zip(rows, (10, 0, 30, 7, 4, 9), strict=True):
        for x in r[r > 0]:
            goal[x] += times
    assert np.allclose(pattern_packing.fit(rows, goal), (10, 0, 30, 7, 4, 9), atol=0.3)
    # more of one length than any pattern can use: nothing negative
    goal[500] += 1000
    assert (pattern_packing.fit(rows, goal) >= 0).all()


# --- centroids -------------------------------------------------------------------
def plain_clusters(rows, k=8, rounds=10, dims=64):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    x = np.array([v for _, v in kept], np.int64)
    first = sorted(range(len(kept)), key=lambda r: (hashlib.sha256(f"3:{'' if kept[r][0] is None else kept[r][0]}".encode()).hexdigest(), kept[r][1]))
    c = x[first[:k]]
    for _ in range(rounds):
        who = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        c = np.array([x[who == j].sum(0) // (who == j).sum() if (who == j).any() else c[j] for j in range(len(c))])
    away = ((x[:, None] - c[None]) ** 2).sum(2)
    who, best = away.argmin(1), away.min(1)
    names = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    return [(kept[r][0], int(who[r]), int(best[r]), int(best[who == who[r]].sum()), int(best.sum()), names[who[r]]) for r in range(len(kept))]


VECTORS = "vec_id long, embedding array<float>, label int, cluster int, distance string, v int, n int"


def test_clusters_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=64) * (1 + i % 3)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(400)]  # a hot vector
    rows += [(5, rows[9][1]), (5, rows[9][1]), (None, rows[4][1]), (None, rows[4][1]), (900, None), (901, []), (902, [1.0] * 63),
             (903, [1.0] * 63 + [None]), (904, [float("nan")] + [0.0] * 63), (905, [float("inf")] + [0.0] * 63), (906, [0.0] * 64)]
    df = spark.createDataFrame([(i, v, 1, 2, "d", 3, 4) for i, v in rows], VECTORS).repartition(3)
    same(centroids.cluster_digest(df).collect(), plain_clusters(rows))
    assert centroids.cluster_digest(df.limit(0)).count() == 0
    few = rows[:3]
    same(centroids.cluster_digest(spark.createDataFrame([(i, v, 1, 2, "d", 3, 4) for i, v in few], VECTORS)).collect(), plain_clusters(few))


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30] + [0.0] * 63, 1, 2, "d", 3, 4)], VECTORS)
    with pytest.raises(Exception, match="too large to cluster, vector 1"):
        centroids.cluster_digest(df)


@pytest.mark.parametrize("k, dims, n, high", [(8, 64, 500, 500), (100, 4, 1000, 30), (50, 2, 1000, 5), (1, 3, 10, 4), (8, 64, 200, 2 ** 27 - 1)])
def test_threshold_walk_is_exact(k, dims, n, high):
    rng = np.random.default_rng(k)
    c, x = rng.integers(-high, high, (k, dims)), rng.integers(-high, high, (n, dims))
    who, best = centroids.CentroidLists(c).nearest(x)
    away = np.stack([((x - y) ** 2).sum(1) for y in c], 1)
    assert (away.argmin(1) == who).all() and (away.min(1) == best).all()


# --- fill in the middle -----------------------------------------------------------
def plain_fill(rows):
    out = []
    for i, text in rows:
        text = text or ""
        units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
        digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h = [int(digest[8 * j:8 * j + 8], 16) for j in range(4)]
        a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        plain = not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
        form = "plain" if plain else "spm" if h[3] % 100 < 20 else "psm"
        whole = {"plain": text, "psm": f"<P>{x}<S>{z}<M>{y}", "spm": f"<S>{z}<P>{x}<M>{y}"}[form]
        out.append((i, len(units), form, None if plain else len(x), None if plain else len(y), whole))
    return out


def test_fill_in_the_middle(spark, odd, empty):
    draw = random.Random(2)
    parts = ["<", "P", ">", "<P", "<S>", "<M", "abc", " ", "é", "日", "\U0001f600", "1", "\n", "\x00", "Z"]
    more = [(1000 + i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 30)))) for i in range(600)]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    expected = plain_fill(ROWS + more)
    same(fill_middle.fill_in_middle(docs).collect(), expected)
    assert {r[2] for r in expected} == {"plain", "psm", "spm"}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    same(fill_middle.fill_digest(docs).collect(), [(*r[:5], sha(r[5]), sha(t)) for r, (_, t) in zip(expected, ROWS + more, strict=True)])
    assert fill_middle.fill_in_middle(odd).count() == len(ROWS) and fill_middle.fill_digest(empty).count() == 0


def test_slices_and_word_cuts(monkeypatch, spark):
    rows = [(i, "Some words, and 12 more. " * (i % 7) + "é" * (i % 3)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    same(fill_middle.fill_in_middle(docs).collect(), plain_fill(rows))
    texts = pa.array([t for _, t in rows])
    whole = fill_middle._transform([i for i, _ in rows], texts, 90, 20, "1", fill_middle.UNITS)
    assert whole == [f for i, t in rows for f in fill_middle._transform([i], pa.array([t]), 90, 20, "1", fill_middle.UNITS)]
    raw = "".join(t for _, t in rows).encode()
    begins = np.concatenate([[0], np.cumsum([len(t.encode()) for _, t in rows])])
    units = fill_middle.Units(np.frombuffer(raw, np.uint8), begins, fill_middle.WORDS)
    assert units.counts().tolist() == [len(re.findall("[A-Za-z]+", t)) for _, t in rows]
    assert units.cut(np.minimum(units.counts(), 2)).tolist()[:3] == [len(rows[0][1]), len("Some words, and 12 "[:12]), 12]


def test_wavelet_ranks():
    rng = np.random.default_rng(0)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 6, n).astype(np.uint8)
        places = np.arange(n + 1)
        matrix = WaveletMatrix(symbols, 3)
        for s in range(6):
            assert matrix.rank(s, places).tolist() == [0, *np.cumsum(symbols == s).tolist()]
        bits = BitRanks(symbols > 2)
        ones = np.flatnonzero(symbols > 2)
        assert bits.ones == len(ones) and bits.select(np.arange(len(ones))).tolist() == ones.tolist()
