"""The pipeline's stages, each held against a plain version on its own input."""

from collections import Counter

import corpus_pipeline as pipeline
from allelic.llm import mixing, quality, token_store
from allelic.llm.common import stored, table
from tests.llm import brute
from tests.llm.conftest import SF001


def test_stages_one_by_one(spark):
    from tokenizers import Tokenizer
    docs = table(spark, SF001, "documents")
    columns = docs.columns
    assert [f.__name__ for _, f in pipeline.STAGES] == ["good", "distinct", "clean", "mixed", "tokens"]

    scores = {r["doc_id"]: r["predicted"] for r in quality.quality_scores(docs, table(spark, SF001, "labels")).collect()}
    good = stored(pipeline.good(spark, docs, SF001), "t")
    assert good.columns == columns
    assert {r["doc_id"] for r in good.collect()} == {i for i, p in scores.items() if p}

    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    distinct = stored(pipeline.distinct(spark, good, SF001), "t")
    assert distinct.columns == columns
    assert sorted(r["doc_id"] for r in distinct.collect()) == sorted(i for i, _, c in brute.simhash_components(rows) if i == c)

    rows = [(r["doc_id"], r["text"]) for r in distinct.collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF001, "benchmark").collect()]
    clean = stored(pipeline.clean(spark, distinct, SF001), "t")
    assert clean.columns == columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(x[0] for x in brute.contamination(rows, items) if not x[-1])
    assert 0 < clean.count() < distinct.count() < good.count() < docs.count()

    mixed = stored(pipeline.mixed(spark, clean, SF001), "t")
    assert mixed.columns == columns
    queue = mixing.fair_queue(clean)
    times = Counter()
    for r in queue.collect():
        times[r["id"]] += 2 * r["taken"] >= r["size"] and r["taken"] > 0
    assert Counter(r["doc_id"] for r in mixed.collect()) == +times
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert all(texts[r["doc_id"]] == r["text"] for r in mixed.collect())

    rows = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    got = stored(pipeline.tokens(spark, mixed, SF001), "t").collect()
    assert sorted(map(tuple, got)) == sorted(brute.tokens(rows, Tokenizer.from_file(token_store.default_tokenizer())))


def test_run_gives_the_last_stage(spark):
    got = pipeline.run(spark, SF001)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(got.collect(), key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]


def test_stages_on_odd_and_empty_tables(spark, odd, empty, tmp_path):
    spark.createDataFrame([(1, "twelve words that do not stand in any of the documents here today")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for given in (odd, empty):
        docs, n = given, given.count()
        for _, stage in pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, str(tmp_path)), "t")
            assert docs.columns == given.columns
        assert (docs.count() > 0) == (n > 0)
        assert pipeline.tokens(spark, docs, str(tmp_path)).count() == docs.count()
