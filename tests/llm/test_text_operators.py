"""Operators over documents, against plain versions: the test tables, and
nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from allelic.llm import bloom_lm, decontaminate, exact_dedup, licenses, mixing, personal_data, quality, simhash, token_store
from tests.llm import brute
from tests.llm.conftest import SF001, odd_rows

ROWS = [(i, t) for i, t, _ in odd_rows()]


def same(got, expected):
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, expected), key=str)


def plain_dedup(rows):
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()))
            first = False
    return out


def test_exact_dedup(odd, empty):
    same(exact_dedup.exact_dedup(odd).collect(), plain_dedup(ROWS))
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_splits_hot_texts(spark, monkeypatch):
    rows = [(i, f"copy  of\tone" if i % 3 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (1, 8, 10_000):  # no text is hot, one is, all are
        monkeypatch.setattr(exact_dedup, "HOT_TEXTS", hot)
        same(exact_dedup.exact_dedup(docs).collect(), plain_dedup(rows))


def test_tokens(odd, empty):
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(token_store.default_tokenizer())
    same(token_store.token_round_trip(odd).collect(), brute.tokens(ROWS, one))
    assert token_store.token_round_trip(empty).count() == 0


def test_token_file_gives_single_documents(spark, odd):
    from allelic.llm.common import fresh_folder
    manifest = token_store.write_tokens(odd, fresh_folder(spark, "tokens")).collect()
    one = token_store.encoder(token_store.default_tokenizer())
    texts = defaultdict(set)
    for i, t in ROWS:
        texts[i].update(one.encode(pa.array([t or ""])))
    for row in manifest:
        file = token_store.TokenFile(row["path"], row["dictionary"])
        for at in reversed(range(len(file.ids))):
            assert file.document(at).tobytes() in texts[file.ids[at]]


def test_token_file_checks_its_dictionary(spark, odd, tmp_path):
    from allelic.llm.common import fresh_folder
    row = token_store.write_tokens(odd, fresh_folder(spark, "tokens")).first()
    other = tmp_path / "other.zdict"
    other.write_bytes(b"another dictionary")
    with pytest.raises(ValueError, match="dictionary"):
        token_store.TokenFile(row["path"], str(other))


def test_words_encode_as_whole_texts():
    import random

    from tokenizers import Tokenizer
    one, whole = token_store.encoder(token_store.default_tokenizer()), Tokenizer.from_file(token_store.default_tokenizer())
    rng = random.Random(5)
    alphabet = [*"aZΣς \t\n\x0b\x0c\r\x1c\x85\xa0 é'stll12٣漢.,!?\x01-|<>*", "<|endoftext|>", "<|ENDOFTEXT|>", "'ll", "'S", "́"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    expected = [whole.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert one.encode(pa.array(texts)) == [b"".join(i.to_bytes(2, "little") for i in ids) for ids in expected]


def test_licenses(odd, empty):
    got = licenses.license_scan(odd).collect()
    same([r[:6] for r in got], [(i, *brute.licenses(t)) for i, t in ROWS])
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)
    assert licenses.license_scan(empty).count() == 0


def test_licenses_on_the_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    same([r[:6] for r in licenses.license_scan(docs).collect()], [(i, *brute.licenses(t)) for i, t in rows])


@pytest.mark.parametrize(("text", "labels", "value"), [
    ("MIT", ["mit"], 0.9), ("GPL-2.0-or-later", ["gpl"], 0.3), ("MIT OR GPL-3.0", ["mit", "gpl"], 0.9),
    ("MIT AND GPL-3.0", ["mit", "gpl"], 0.3), ("GPL-2.0 WITH Classpath-exception-2.0", ["gpl"], 0.65),
    ("MIT AND GPL-2.0 OR Apache-2.0", ["mit", "gpl", "apache"], 0.9), ("MIT AND (GPL-2.0 OR Apache-2.0)", ["mit", "gpl", "apache"], 0.9),
    ("(MIT OR GPL-2.0) AND AGPL-3.0", ["mit", "gpl", "agpl"], 0.2), ("MIT OR", ["mit"], 0.9), ("((MIT", ["mit"], 0.9),
    ("", [], None), (") OR", [], None), ("Foo-1.0", ["foo-1.0"], 0.4), ("MIT and then some", ["mit", "then"], 0.4)])
def test_license_expressions(text, labels, value):
    assert licenses.evaluate(text) == (labels, pytest.approx(value) if value is not None else None)


def test_license_tags():
    own = licenses._automaton()
    row = licenses.scan(b"// SPDX-License-Identifier: MIT OR GPL-2.0 WITH Foo-exception\nCC BY cc-by; cc by by", own)
    assert row["labels"] == "cc-by,gpl,mit" and row["n_base"] == 3 and row["score"] == pytest.approx(0.8)


@pytest.mark.parametrize(("text", "labels", "value"), [
    (b"SPDX-License-Identifier: MIT more words. SPDX-License-Identifier: GPL-3.0-only tail", "gpl,mit", 0.3),
    (b"SPDX-License-Identifier: MIT OR SPDX-License-Identifier: CC0-1.0 spdx license identifier AGPL-3.0", "agpl,cc0,mit", 0.2),
    (b"SPDX-License-Identifier:\rSPDX-License-Identifier: MIT\nSPDX-License-Identifier: Apache-2.0 AND\nGPL-2.0", "apache,mit", 0.9)])
def test_every_license_tag_of_a_line(text, labels, value):
    row = licenses.scan(text, licenses._automaton())
    assert row["labels"] == labels and row["score"] == pytest.approx(value)


def test_tokens_of_another_tokenizer(odd):
    """A tokenizer that keeps white space and cases gets whole texts."""
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert token_store.by_words(token_store.default_tokenizer()) and not token_store.by_words(path)
    same(token_store.token_round_trip(odd, path).collect(), brute.tokens(ROWS, Tokenizer.from_file(path)))


@pytest.fixture()
def one_id(spark):
    """One id or none, and one text, on nine tenths of the rows."""
    rows = [(None if i % 3 else 7, "the same words again") if i % 10 else (i, f"text {i}") for i in range(20_000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_exact_dedup_one_id(one_id, monkeypatch):
    kept, real = {}, exact_dedup.stored

    def stored(df, name, *rest):
        kept[name] = real(df, name, *rest)
        return kept[name]
    monkeypatch.setattr(exact_dedup, "stored", stored)
    got = Counter((r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(one_id).collect() if r["group_size"] > 1)
    assert got == {(7, 18_000, True): 1, (7, 18_000, False): 17_999}
    assert kept["runs"].agg(F.max("run_size")).first()[0] < 100
    nobody = one_id.filter("doc_id IS NULL")
    assert Counter(r["kept"] for r in exact_dedup.exact_dedup(nobody).collect()) == {True: 1, False: nobody.count() - 1}


def test_tokens_one_id(one_id):
    from tokenizers import Tokenizer

    from allelic.llm.common import fresh_folder
    manifest = token_store.write_tokens(one_id, fresh_folder(one_id.sparkSession, "tokens"))
    sizes = [r["n_docs"] for r in manifest.collect()]
    assert sum(sizes) == 20_000 and len(sizes) > 4 and max(sizes) < 3 * sum(sizes) / len(sizes)
    got = token_store.read_tokens(manifest).collect()
    whole = Tokenizer.from_file(token_store.default_tokenizer())
    same(got, brute.tokens(one_id.collect(), whole))


def plain_mix(rows):
    sizes = [(i, s, len(brute.TOKEN.findall(t or ""))) for i, t, s in rows]
    source = defaultdict(int)
    for _, s, n in sizes:
        source[s] += n
    order = sorted(source, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, target, free = 1.5 * sum(source.values()), {}, set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= 2 * source[s]}
        for s in full or free:
            target[s] = 2 * source[s] if full else weight[s] * level
        left -= sum(target[s] for s in full)
        free = free - full if full else set()
    return sizes, source, target


def test_mixing(odd, empty):
    sizes, source, target = plain_mix(odd_rows())
    got = mixing.mix_digest(odd).collect()
    same([r[:2] for r in got], [(i, n) for i, _, n in sizes])
    queue = mixing.fair_queue(odd).collect()
    taken = Counter()
    for r in queue:
        taken[r["source"]] += r["taken"]
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == source[r["source"]]
    for s in source:
        assert abs(taken[s] - target[s]) <= 1
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_digest(odd.repartition(5)).collect()), key=str)
    finish = [r["finish"] for r in queue]
    assert finish == sorted(finish)
    assert mixing.mix_digest(empty).count() == 0


def test_mixing_cuts_the_queue_not_the_targets(odd, monkeypatch):
    """With the closed form of the targets off, the queue's cut still meets them."""
    sizes, source, target = plain_mix(odd_rows())
    real = mixing.source_targets
    monkeypatch.setattr(mixing, "source_targets", lambda *a: real(*a).withColumn("target", F.lit(-1.0)))
    taken = Counter()
    for r in mixing.fair_queue(odd).collect():
        assert r["target"] == -1.0
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in source)


@pytest.mark.parametrize("share", [0.3, 1.0, 5.0])
def test_mixing_budgets(odd, share):
    """A small budget, all sources once, and more than the epochs hold."""
    total = sum(n for _, _, n in plain_mix(odd_rows())[0])
    taken = sum(r["taken"] for r in mixing.fair_queue(odd, share=share).collect())
    assert abs(taken - min(share, 2) * total) <= len({s for _, _, s in odd_rows()})


def test_mixing_one_id(spark, monkeypatch):
    """One id, one text and one source on most of the rows: no range holds them."""
    rows = [(7 if i % 10 else None, "a b c d", "hot" if i % 20 else "b") for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    kept, real = {}, mixing._in_ranges

    def ranges(df, order, name):
        kept[name] = real(df, order, name)
        return kept[name]
    monkeypatch.setattr(mixing, "_in_ranges", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = mixing.mix_digest(docs)
        assert got.count() == 20_000
        assert got.agg(F.sum("taken")).first()[0] == pytest.approx(1.5 * 80_000, abs=2)
        for name in ("placed", "queue"):
            sizes = [r["count"] for r in kept[name].groupBy("_range").count().collect()]
            assert len(sizes) > 4 and max(sizes) < 3 * sum(sizes) / len(sizes)
        mixed = mixing.mix_documents(docs)
        assert mixed.columns == docs.columns and 29_900 < mixed.count() < 30_100
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_mixed_documents(odd, empty):
    got = mixing.mix_documents(odd)
    assert got.columns == odd.columns
    times = Counter((r["doc_id"], r["text"], r["source"]) for r in got.collect())
    given = Counter(odd_rows())
    assert all(n <= 2 * given[k] for k, n in times.items())
    # documents without words cost nothing and stay
    assert all(times[k] == n for k, n in given.items() if not (k[1] or "").strip())
    assert mixing.mix_documents(empty).count() == 0


def test_simhash(odd, empty):
    same(simhash.near_digest(odd).collect(), brute.simhash_components(ROWS))
    assert simhash.near_digest(empty).count() == 0


def test_simhash_links_dense_groups(spark, monkeypatch):
    """Fingerprints around a few centres, whole and with groups split in chunks."""
    import random
    rng = random.Random(3)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    expected = {}
    for a in signed:
        expected[a] = {b for b in signed if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3}
    roots = {}
    for a in signed:
        if a not in roots:
            todo, seen = [a], {a}
            while todo:
                for b in expected[todo.pop()] - seen:
                    seen.add(b)
                    todo.append(b)
            roots.update(dict.fromkeys(seen, min(seen)))
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    for chunk in (8192, 5):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        got = {r["node"]: r["root"] for r in simhash.components(simhash.links(table)).collect()}
        assert {x: got.get(x, x) for x in signed} == roots


def test_components_of_long_paths(spark):
    from allelic.llm.graph import components
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}, 201: 200}


def test_keep_one(odd, empty):
    got = simhash.keep_one(odd)
    assert got.columns == odd.columns
    by_component = defaultdict(list)
    fps = {t: simhash.fingerprint((t or "").encode()) for _, t in ROWS}
    for i, f, c in brute.simhash_components(ROWS):
        by_component[c].append((i, f))
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(kept) == len({brute.simhash(t) for _, t in ROWS})  # no two of these fingerprints are near
    assert len({fps[t] for _, t in kept}) == len(kept)
    least = {}
    for i, t in ROWS:
        least[fps[t]] = min(least.get(fps[t], (True, 0)), (i is None, i or 0))
    assert all(least[fps[t]] == (i is None, i or 0) for i, t in kept)
    assert simhash.keep_one(empty).count() == 0


ITEMS = [(1, "one two three four five six seven eight nine ten"), (2, "Three four five, six seven eight nine ten eleven TWELVE"),
         (30, "gamma"), (4, ""), (None, "twice"), (30, "gamma"), (6, None), (7, "not there at all")]


def test_contamination(spark, odd, empty):
    items = spark.createDataFrame([(*x, "i") for x in ITEMS], "item_id long, text string, item string")
    same(decontaminate.contamination(odd, items).collect(), brute.contamination(ROWS, ITEMS))
    none = decontaminate.contamination(odd, items.limit(0)).collect()
    assert not any(r["contaminated"] for r in none) and len(none) == len(ROWS)
    assert decontaminate.contamination(empty, items).count() == 0
    clean = decontaminate.keep_clean(odd, items)
    assert clean.columns == odd.columns
    same([(r["doc_id"], r["text"]) for r in clean.collect()],
         [r for r, x in zip(ROWS, brute.contamination(ROWS, ITEMS), strict=True) if not x[-1]])


def test_contamination_over_blocks_and_pieces(spark, monkeypatch):
    """Small shards, so that texts are cut, and one benchmark block an item."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = brute.contamination(rows, [tuple(r) for r in items.select("item_id", "text").collect()])
    assert any(x[-1] for x in expected)
    phrases = decontaminate.Phrases([(str(r["item_id"]), decontaminate.words_of(r["text"].encode())) for r in items.collect()])
    for size in (64, 1 << 20):
        monkeypatch.setattr(decontaminate, "SHARD", size)
        hits = defaultdict(set)
        for pieces, _ in decontaminate._shards([(t or "").encode() for _, t in rows]):
            for d, w, p in zip(*decontaminate.search_shard(pieces, phrases), strict=True):
                hits[rows[d][0]].update(range(w, w + phrases.lengths[p]))
        assert {x[0]: x[2] for x in expected if x[2]} == {d: len(h) for d, h in hits.items()}
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1)
    same(decontaminate.contamination(docs, items).collect(), expected)


def test_suffix_array_and_ranks():
    import numpy as np
    rng = np.random.default_rng(1)
    for n, symbols in ((1, 1), (50, 2), (400, 3), (300, 40)):
        text = np.append(rng.integers(0, symbols + 1, n), 0)
        text[n // 2:] = np.resize(text[:max(n // 8, 1)], n + 1 - n // 2)  # long repeats
        text[-1] = 0
        zeros = np.cumsum(text == 0)
        key = [[(0, zeros[j]) if text[j] == 0 else (1, text[j]) for j in range(i, next(k for k in range(i, n + 1) if text[k] == 0) + 1)]
               for i in range(n + 1)]
        assert decontaminate.suffix_array(text).tolist() == sorted(range(n + 1), key=lambda i: key[i])
        tree = decontaminate.Wavelet(text, symbols)
        c, at = rng.integers(0, symbols + 1, 200), rng.integers(0, n + 2, 200)
        assert tree.occ(c, at).tolist() == [int((text[:a] == x).sum()) for x, a in zip(c, at, strict=True)]


def test_personal_data(odd, empty):
    got = personal_data.personal_data(odd).collect()
    same([r[:6] for r in got], [(i, *brute.personal(t)[:5]) for i, t in ROWS])
    for r in got:
        assert len(r["spans"].split(",")) >= r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"]
    assert personal_data.personal_data(empty).count() == 0


def test_personal_data_on_hard_texts(spark):
    import random
    rng = random.Random(9)
    pieces = ["a@b.c", "x.y_z@", "@", ".", "-", "1.2.3.4", "300.1.1.1", "001.02.3.255", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "4041894974608795",
              "+1 (456) 555-2186", "+12", "+1" + "0" * 20, " ", "\n", "é", "\U0001f600", "7", "77", "0", "a@b-c.d-e.f,", "%+", "  ", "()", "me@x.com_you@y.org"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    texts += ["a@b.c " * 3000, "1 " * 60_000, "+" + "1(" * 30_000, "1.2.3.4 " * 2000]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    same([r[:6] for r in personal_data.personal_data(docs).collect()], [(i, *brute.personal(t)[:5]) for i, t in rows])


def test_personal_data_is_linear_in_long_runs(spark):
    """Runs on which the plain patterns take the square of the length."""
    texts = ["a" * 300_000 + " @", "1" * 300_000, "a." * 150_000 + "@", "7." * 2 + "1" * 300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert not any(r["spans"] for r in personal_data.personal_data(docs).collect())


def test_personal_data_adds_account_numbers_and_keys(spark):
    """Account numbers whose check digits hold, in one piece or in fours, and keys of known forms."""
    def check_digits(country, rest):
        n = int("".join(str(int(c, 36)) for c in rest + country + "00"))
        return f"{country}{98 - n % 97:02d}{rest}"
    good = [check_digits("DE", "370400440532013000"), check_digits("GB", "WEST12345698765432"), check_digits("NO", "86011117947")]
    bad = "DE" + f"{(int(good[0][2:4]) + 1) % 97:02d}" + good[0][4:]
    fours = " ".join(good[1][i:i + 4] for i in range(0, len(good[1]), 4))
    key = "ghp_" + "a1B2" * 9
    texts = [f"transfer to iban {good[0]} now", f"bank account: {fours}.", f"iban {good[2]}", f"iban {bad}", f"secret token {key} here",
             "AKIA is short", "the model AB12 CDEF and more", f"x{good[0]}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = ("iban", "secret")
    got = {r["doc_id"]: [x for x in r["spans"].split(",") if x.startswith(kinds)] for r in personal_data.personal_data(docs).collect()}

    def at(i, what, kind):
        return [f"{kind}:{texts[i].index(what)}:{texts[i].index(what) + len(what)}"]
    assert got == {0: at(0, good[0], "iban"), 1: at(1, fours, "iban"), 2: at(2, good[2], "iban"), 3: [], 4: at(4, key, "secret"), 5: [], 6: [], 7: []}


def test_added_spans_among_many_base_spans(spark):
    """Several blocks of base spans: added ones among them stay, those inside a base span go."""
    text = " ".join(f"a{i}@b.com (212) 555-{1000 + i}" for i in range(700)) + " call 212-555-0000"
    docs = spark.createDataFrame([(1, text), (2, "x +1 (212) 555-1234 call (212) 555-1234")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in personal_data.personal_data(docs).collect()}
    spans = [x.split(":") for x in got[1]["spans"].split(",")]
    assert got[1]["n_email"] == 700 and sum(k == "phone" for k, _, _ in spans) >= 700
    placed = sorted((int(a), int(b)) for _, a, b in spans)
    assert all(x[1] <= y[0] for x, y in zip(placed, placed[1:], strict=False))
    assert got[2]["spans"].startswith("phone:2:19") and ":5:" not in got[2]["spans"]


def test_personal_data_adds_spans(spark):
    """Wide candidates with good form and cues are added, doubtful ones not."""
    rows = [(i, f"Please call (4{i % 10}2) 555-2{i:03d}, my phone.") for i in range(60)]
    rows += [(1000 + i, f"write mail to joe{i} [at] mail{i} [dot] com") for i in range(60)]
    rows += [(2000 + i, f"order 000-00-0000x{i} of part 11") for i in range(60)]
    rows += [(3000 + i, f"email ann{i}@mail.example.com") for i in range(60)]
    got = {r["doc_id"]: r["spans"] for r in personal_data.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].startswith("phone:12:26") for i in range(60))
    assert all(got[1000 + i].startswith("email:14:") for i in range(60))
    assert not any(got[2000 + i] for i in range(60))
    assert all(got[3000 + i].startswith("email:6:") for i in range(60))


def test_reliabilities_find_the_odd_labeler():
    votes = [("email", (1, 1, -1, 1, 0), 500), ("email", (0, -1, 0, -1, 1), 400), ("email", (1, 1, -1, -1, 1), 50)]
    q = personal_data.reliabilities(votes)
    assert q["email", votes[0][1]] > 0.9 > 0.1 > q["email", votes[1][1]]


def test_quality_learns_and_keeps_the_fold_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    out = [(got[i]["score"], q) for i, q in marks.items() if got[i]["held_out"]]
    good, bad = [s for s, q in out if q], [s for s, q in out if not q]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.97
    assert sum((s >= 0.5) == q for s, q in out) / len(out) > 0.95
    # the held-out labels, and the columns that are no inputs, change nothing
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")), turned).collect()}
    assert again == {i: r["score"] for i, r in got.items()}


def test_quality_learns_once_from_copies(spark, monkeypatch):
    """Very many rows of one labelled id, equal or not, are one row of the sample; no other id is pushed out."""
    monkeypatch.setattr(quality, "SAMPLE", 30)
    learnt = []
    monkeypatch.setattr(quality, "fit", lambda rows, labels: learnt.append((rows, labels.tolist())))
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1][:30]
    rows = [(i, f"text number {i}", 5) for i in ids]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    for copies in ([], [(ids[0], f"text number {ids[0]}", 5)] * 500, [(ids[0], f"other text {k}", None) for k in range(300)]):
        docs = spark.createDataFrame(rows + copies, "doc_id long, text string, n_chars long").repartition(7)
        quality.train(docs, labels)
        assert learnt[-1][1] == [i % 2 for i in ids]
    for (a, x), (b, y) in zip(learnt[0][0], learnt[1][0], strict=True):
        assert (a == b).all() and (x == y).all()


def test_quality_learns_all_features_of_long_texts(spark, monkeypatch):
    learnt = []
    monkeypatch.setattr(quality, "fit", lambda rows, labels: learnt.extend(rows))
    text = " ".join(f"word{i}" for i in range(9000))
    quality.train(spark.createDataFrame([(0, text, 5)], "doc_id long, text string, n_chars long"), spark.createDataFrame([(0, 1)], "doc_id long, quality int"))
    _, cols, _ = quality.features([text.encode()], [5])
    assert len(cols) > 8000 and (learnt[0][0] == cols).all()


def test_quality_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (None, 1, 0), (9, None, 0), (12, 1, 0), (12, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(odd, labels).collect()
    same([r[:1] for r in got], [(i,) for i, _ in ROWS])
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["score"] == 0.5 for r in quality.quality_scores(odd, labels.limit(0)).collect())
    assert quality.keep_good(odd, labels.limit(0)).columns == odd.columns
    assert quality.keep_good(odd, labels.limit(0)).count() == len(ROWS)
    assert quality.quality_scores(empty, labels).count() == 0


def test_machine_equals_the_sum_over_pairs():
    import numpy as np
    rng = np.random.default_rng(2)
    m = quality.Machine(0.3, rng.normal(size=20), rng.normal(size=(20, 4)))
    cols, vals = np.array([1, 4, 7, 2, 9]), rng.normal(size=5)
    raw = m.raw(np.array([0, 3, 5]), cols, vals)[0]
    for at, (a, b) in enumerate(((0, 3), (3, 5))):
        c, x = cols[a:b], vals[a:b]
        pairs = sum(m.factors[c[i]] @ m.factors[c[j]] * x[i] * x[j] for i in range(len(c)) for j in range(i))
        assert raw[at] == pytest.approx(0.3 + m.linear[c] @ x + pairs)


def plain_lm(rows):
    import math
    texts = [(i, brute.TOKEN.findall(brute.lower(t)) + ["\n"], zlib.crc32((b"" if i is None else str(i).encode())) % 7 == 2) for i, t in rows]
    c = Counter(w for _, t, held in texts if not held for w in t)
    n, v = sum(c.values()), len(c)
    return [(i, held, len(t), sum(w in c for w in t), n, pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))) for i, t, held in texts]


@pytest.mark.parametrize("heavy", [500_000, 20])
def test_language_scores(odd, empty, monkeypatch, heavy):
    monkeypatch.setattr(bloom_lm, "HEAVY", heavy)
    got = sorted(map(tuple, bloom_lm.language_scores(odd).collect()), key=lambda r: (str(r[0]), r[2], r[3], r[5]))
    expected = sorted(plain_lm(ROWS), key=lambda r: (str(r[0]), r[2], r[3], r[5].expected))
    assert [r[:6] for r in got] == expected
    assert all(r[6] < 0 for r in got)
    assert bloom_lm.language_scores(empty).count() == 0


def test_filter_reads_back_levels():
    import numpy as np
    keys = bloom_lm.mixed(np.arange(1, 20001, dtype=np.uint64))
    counts = np.resize([1, 1, 1, 2, 3, 5, 100], len(keys))
    segments, words = 4, 40_000
    of = bloom_lm.segment_of(keys, segments)
    bits = np.concatenate([bloom_lm.segment_bits(keys[of == s], counts[of == s], words) for s in range(segments)])
    made = bloom_lm.Filter(segments, words, bits)
    got, true = made.level(keys), bloom_lm.levels(counts)
    assert (got >= true).all() and (got == true).mean() > 0.97  # only ever too high, and rarely
    assert (made.level(bloom_lm.mixed(np.arange(30_000, 60_000, dtype=np.uint64))) == 0).mean() > 0.97


def test_keys_pack_and_unpack():
    import numpy as np
    keys = bloom_lm.single_hashes(np.arange(1000, dtype=np.uint64) * np.uint64(7919))
    assert len(np.unique(keys)) == 1000 and len(bloom_lm.packed(keys)) == 6000
    assert (bloom_lm.unpacked(bloom_lm.packed(keys)) == keys).all() and not len(bloom_lm.unpacked(b""))


def test_segments_hold_all_levels():
    """No n-gram is left out, however unlike the counts are."""
    import numpy as np
    keys = bloom_lm.mixed(np.arange(1, 5001, dtype=np.uint64))
    counts = np.where(np.arange(5000) < 20, 1 << 20, 1 + np.arange(5000) % 3)
    words = bloom_lm.segment_words(counts)
    made = bloom_lm.Filter(1, words, bloom_lm.segment_bits(keys, counts, words))
    assert np.bitwise_count(made.bits).sum() <= words * 64 * 0.25
    assert (made.level(keys) >= bloom_lm.levels(counts)).all()
    assert bloom_lm.ranges(10 ** 14) == -(-10 ** 14 // bloom_lm.RANGE_TOKENS)


def test_model_beats_the_base_on_held_out_texts(spark):
    got = bloom_lm.language_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def exact_lm(rows):
    """Scores from a plain table of counts, read as the middles of their levels."""
    import math
    texts = [(i, [*brute.TOKEN.findall(brute.lower(t)), "\n"], zlib.crc32((b"" if i is None else str(i).encode())) % 7 == 2) for i, t in rows]
    words, pairs = Counter(), Counter()
    for _, t, held in texts:
        if not held:
            words.update(t)
            pairs.update(zip(["\n", *t], t, strict=False))
    n, v = sum(words.values()), len(words)
    middle = lambda c: (2 ** (c.bit_length() - 1) + 2 ** c.bit_length() - 1) / 2 if c else 0.0

    def log(a, b):
        before, alone = middle(words[a]), (min(middle(words[b]), n) + 1) / (n + v + 1)
        return math.log10((min(middle(pairs[a, b]), before) + bloom_lm.PRIOR * alone) / (before + bloom_lm.PRIOR))
    return [(str(i), sum(log(a, b) for a, b in zip(["\n", *t], t, strict=False))) for i, t, _ in texts]


@pytest.mark.parametrize(("tokens", "size"), [(1 << 20, 12 << 20), (2000, 20_000)])
def test_language_model_keeps_rare_pairs(spark, monkeypatch, tokens, size):
    """Every level of every word and pair is scored, in one hash range or many, and in many units;
    under the former bound on the whole filter (MOST_BITS), here a small one, the rare ones were left out."""
    monkeypatch.setattr(bloom_lm, "RANGE_TOKENS", tokens)
    monkeypatch.setattr(bloom_lm, "SLICE_BYTES", size)
    monkeypatch.setattr(bloom_lm, "MOST_BITS", 1 << 12, raising=False)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").repartition(3)
    got = sorted((str(r["doc_id"]), r["score"]) for r in bloom_lm.language_scores(docs).collect())
    expected = sorted(exact_lm([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert [i for i, _ in got] == [i for i, _ in expected]
    wrong = sum(abs(a - b) > 0.005 * abs(b) + 0.5 for (_, a), (_, b) in zip(got, expected, strict=True))
    assert wrong <= len(got) * 0.02  # a false answer of the filter, now and then
    assert sum(a for _, a in got) == pytest.approx(sum(b for _, b in expected), rel=1e-3)


def test_sorted_keys_pack_and_unpack():
    import numpy as np
    keys = np.unique(bloom_lm.single_hashes(np.arange(5000, dtype=np.uint64)))
    for some in (keys, keys[:1], keys[[0, -1]], keys[100:103]):
        assert (bloom_lm.unpacked_sorted(bloom_lm.packed_sorted(some)) == some).all()
    assert len(bloom_lm.packed_sorted(keys)) < len(bloom_lm.packed(keys))
