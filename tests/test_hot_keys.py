"""Numbering, first rows and family pairs when one value, key or family holds
most rows, against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from allelic.operators import family as FAM
from allelic.operators import timeseries as TS
from allelic.operators.firsts import first_rows
from allelic.operators.ranks import numbered_rows, range_sorted
from allelic.operators.topk import chromosome_order


def _none_first(*values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


@pytest.mark.parametrize("kind", ["hot value", "text order", "all equal", "nulls"])
def test_ranges_of_numbered_rows_stay_even(spark, kind):
    n = 8000
    draw = random.Random(1)
    order = {"hot value": lambda i: 5 if i % 10 else draw.randint(0, 100), "all equal": lambda i: 7,
             "text order": lambda i: None, "nulls": lambda i: None if i % 3 else i}[kind]
    rows = [("g" if i % 10 else "h", order(i), f"label {draw.randint(0, 10 ** 9):010d}", i if kind != "all equal" else 1) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, t int, s string, u int").repartition(8)
    by = "s" if kind == "text order" else "t"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in range_sorted(df, list(dict.fromkeys(["g", by, "t", "s", "u"]))).groupBy("_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 4 and max(sizes) <= 2 * n / len(sizes)
    got = sorted((r.g, r._i, r.t, r.s, r.u, r._n) for r in numbered_rows(df, ["g"], [by]).collect())
    expected = []
    for g in "gh":
        mine = [r for r in rows if r[0] == g]
        mine.sort(key=lambda r: _none_first(r[2], r[1], r[3]) if by == "s" else _none_first(r[1], r[2], r[3]))
        expected += [(g, i, t, s, u, len(mine)) for i, (_, t, s, u) in enumerate(mine)]
    assert got == expected


def test_numbering_of_odd_tables(spark):
    empty = spark.createDataFrame([], "g string, t int, m map<string,int>")
    assert numbered_rows(empty, ["g"], ["t"]).count() == 0 and numbered_rows(empty, [], ["t"]).count() == 0
    one = spark.createDataFrame([(None, None, {"a": 1})], empty.schema)
    assert [(r._i, r._n, r.m) for r in numbered_rows(one, ["g"], ["t"]).collect()] == [(0, 1, {"a": 1})]


def test_downsample_of_a_text_order(spark):
    rows = [(f"{i:04d}",) for i in range(1000)]
    got = [r.s for r in TS.downsample(spark.createDataFrame(rows, "s string"), 30, "s").orderBy("s").collect()]
    assert got == [f"{i:04d}" for i in range(1000) if i % 34 == 0][-30:]


def test_chromosome_order_of_free_text(spark):
    labels = ["10", "2", "X", "chr3", "MT", "Y", "", "weird", None, "10"]
    got = {r.chromosome: (r.lexical_rank, r.natural_rank) for r in
           chromosome_order(spark.createDataFrame([(x,) for x in labels], "chromosome string")).collect()}
    distinct = sorted({x for x in labels if x is not None})
    natural = ["2", "chr3", "10", "X", "Y", "MT", "", "weird"]
    assert got == {x: (distinct.index(x) + 1, natural.index(x) + 1) for x in distinct}


# --- first rows -------------------------------------------------------------------
def _plain_first(rows, key, lead):
    """Least lead, NULL last, ties by the whole row with NULL last."""
    out = {}
    for r in sorted(rows, key=lambda r: (r[lead] is None, r[lead] or 0, [(x is None, x if x is not None else 0) for x in r[2:]])):
        out.setdefault(r[key], r)
    return set(out.values())


def test_first_rows_with_a_hot_key_and_ties(spark):
    draw = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 50}", draw.choice([None, 1, 2, 3, 3]), draw.choice(["b", "a", None]), draw.randint(0, 5)) for i in range(3000)]
    rows += [("no lead", None, "z", 1), ("no lead", None, "y", 2), (None, 4, "n", 1), (None, 4, None, 1), (None, 9, "a", 0)]
    df = spark.createDataFrame(rows, "k string, a int, s string, u int").repartition(5)
    assert {tuple(r) for r in first_rows(df, ["k"], ["a"]).collect()} == _plain_first(rows, 0, 1)
    # a text lead has no fixed width: ranked without the first phase
    by_text = {r.k: r.s for r in first_rows(df, ["k"], ["s"]).collect()}
    assert by_text["hot"] == "a" and by_text["no lead"] == "y" and by_text[None] == "a"
    assert first_rows(df.limit(0), ["k"], ["a"]).count() == 0


def test_latest_by_key_ties_and_missing_times(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t, 1, "x"), ("a", t, 2, "w"), ("a", None, 9, "z"), ("b", None, 1, "p"), ("b", None, 3, "q"), (None, t, 5, None), (None, t, 5, None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, n int, s string")
    got = {(r.k, r.n, r.s) for r in TS.latest_by_key(df, ["k"], "ts", tiebreak="n").collect()}
    assert got == {("a", 2, "w"), ("b", 3, "q"), (None, 5, None)}
    got = {(r.k, r.n) for r in TS.latest_by_key(df, ["k"], "ts").collect()}
    assert got == {("a", 2), ("b", 3), (None, 5)}


def test_first_per_batch_without_ids(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("b0", None, t, "A"), ("b0", 7, t + dt.timedelta(1), "B"), ("b0", 5, t + dt.timedelta(2), "C"),
            ("b1", None, t + dt.timedelta(1), "D"), ("b1", None, t, "F"), ("b1", None, t, "E"), ("b1", None, None, "A")]
    df = spark.createDataFrame(rows, "batch string, snp_id long, ts timestamp, genotype string")
    assert {(r.batch, r.genotype) for r in TS.first_per_batch(df, "batch").collect()} == {("b0", "C"), ("b1", "E")}


# --- calls, trios and pairs --------------------------------------------------------
def test_calls_take_the_first_row(spark):
    t = dt.datetime(2024, 1, 1)
    big = 2 ** 62
    rows = [("p", 3, t, "AG"), ("p", 2, t, "TT"), ("p", 2, t, "CC"), ("p", 1, t, "aa"), ("p", None, t, "AA"),
            ("q", None, t + dt.timedelta(1), "AA"), ("q", None, t, "GT"), ("q", None, None, "CC"),
            ("r", None, None, "TG"), ("r", None, None, "GC"), ("s", -big, t, "CT"), ("s", big, t, "AA"), ("s", 0, t, "AA"),
            ("u", 1, t, "A"), ("u", 2, t, ""), ("u", 3, t, None), ("u", 4, t, "A "), ("u", 5, t, " A"), ("v", 1, dt.datetime(1, 1, 2), "GG")]
    df = spark.createDataFrame([(f"f{i % 1}", p, "child", True, "chr1", 5, n, x, g) for i, (p, n, x, g) in enumerate(rows)],
                               "family_id string, person_id string, member_type string, has_snp boolean, chromosome string, position int, "
                               "snp_id long, ts timestamp, genotype string")
    got = {r.person_id: (r.locus, r.genotype) for r in FAM.genotype_calls(df).collect()}
    assert got == {"p": ("1:5", "CC"), "q": ("1:5", "GT"), "r": ("1:5", "GC"), "s": ("1:5", "CT"), "v": ("1:5", "GG")}
    assert FAM.genotype_calls(df.withColumn("position", F.lit(None).cast("int"))).count() == 0
    assert FAM.genotype_calls(df.drop("snp_id", "ts")).filter("person_id = 'p'").first().genotype == "AA"


CALLS = "family_id string, person_id string, member_type string, locus string, genotype string"


def test_a_large_family_is_paired_whole(spark):
    draw = random.Random(9)
    people = [("f", "father"), ("m", "mother"), *((f"c{i:03d}", "child") for i in range(60))]
    calls = [("big", p, m, f"1:{x}", draw.choice(["AA", "AG", "GG", "CT"])) for p, m in people for x in range(4) if draw.random() < 0.9]
    calls += [("small", p, m, "1:1", "AG") for p, m in people[:3]]
    df = spark.createDataFrame(calls, CALLS)
    got = {(r.family_id, r.relation, r.person_a, r.person_b): (r.loci, r.similarity) for r in FAM.genetic_similarity(df).collect()}
    role = {p: i for i, (_, group) in enumerate([("f", ["f"]), ("m", ["m"]), ("c", [p for p, m in people if m == "child"])]) for p in group}
    by = {}
    for f, p, _, x, g in calls:
        by.setdefault((f, p), {})[x] = g
    shared = lambda a, b: 2 if sorted(a) == sorted(b) else 1 if set(a) & set(b) else 0
    expected = {}
    for (f, a), ga in by.items():
        for (g, b), gb in by.items():
            if f == g and (role[a] < role[b] or (role[a] == role[b] == 2 and a < b)) and ga.keys() & gb.keys():
                both = ga.keys() & gb.keys()
                relation = {(0, 1): "father-mother", (0, 2): "father-child", (1, 2): "mother-child", (2, 2): "siblings"}[role[a], role[b]]
                expected[f, relation, a, b] = (len(both), sum(shared(ga[x], gb[x]) for x in both) / 2 / len(both))
    assert got.keys() == expected.keys()
    assert all(got[k][0] == v[0] and abs(got[k][1] - v[1]) < 1e-4 for k, v in expected.items())
    trios = FAM.trio_join(df)
    assert trios.count() == sum(("big", "f") in by and x in by["big", "f"] and x in by["big", "m"]
                                for f, p, m, x, _ in calls if f == "big" and m == "child") + 1
    m = FAM.mendelian_consistency(df).filter("family_id = 'small'").first()
    assert (m.trios, m.consistent, m.consistent_share) == (1, 1, 1.0)


def test_an_unknown_family_is_an_error(spark):
    df = spark.createDataFrame([("?", f"c{i}", "child", "1:1", "AA") for i in range(30)]
                               + [("?", "f", "father", "1:1", "AA"), ("?", "m", "mother", "1:1", "AA")], CALLS)
    for run in (FAM.genetic_similarity, FAM.trio_join, FAM.mendelian_consistency):
        with pytest.raises(Exception, match="more than most_members = 20"):
            run(df, most_members=20).collect()
    assert FAM.genetic_similarity(df, most_members=32).count() == 30 * 29 // 2 + 30 * 2 + 1
