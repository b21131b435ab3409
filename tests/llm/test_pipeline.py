"""The pipeline's stages against brute-force versions of their decisions, on real and odd documents."""

from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_near_dedup import plain as plain_groups
from tests.llm.test_substring_dedup import plain as plain_spans
from ticklake.llm import quality_classifier, quality_rules
from ticklake.llm.common import staged

SF = "/root/testdata/sf0.001"


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns

    first = staged(cp.classify(spark, docs, SF), "t")
    assert first.columns == columns
    good = {r.doc_id for r in quality_classifier.classify(docs, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in first.collect()} == good

    second = staged(cp.rules(spark, first, SF), "t")
    assert second.columns == columns
    kept = {r.doc_id for r in quality_rules.apply_rules(first, labels).filter("kept").collect()}
    assert {r.doc_id for r in second.collect()} == kept
    clean = {r.doc_id for r in labels.filter("quality = 1").collect()} & {
        r.doc_id for r in staged(quality_rules.text_statistics(docs), "t").filter(~quality_rules.base_failed()).collect()}
    assert len(clean & kept) >= 0.95 * len(clean)

    third = staged(cp.near_duplicates(spark, second, SF), "t")
    assert third.columns == columns
    want = plain_groups([(r.doc_id, r.text) for r in second.collect()], 5, 80)
    assert {r.doc_id for r in third.collect()} == {d for d, x in want.items() if x[2]}

    fourth = staged(cp.substrings(spark, third, SF), "t")
    assert fourth.columns == columns
    rows = [(r.doc_id, r.text) for r in third.collect()]
    spans = plain_spans(rows, 50)
    for r in fourth.collect():
        n, gone, _ = spans[r.doc_id]
        assert len(r.text.split()) == n - gone if gone else r.text == dict(rows)[r.doc_id]

    pieces = cp.pack(spark, fourth, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {d for d, _ in rows}
    full = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 4096 for r in full)


def test_run_applies_all_stages_in_order(spark, monkeypatch):
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "quality rules", "near duplicates", "substring dedup", "best-fit packing"]
    cut = [("one", lambda s, d, sf: d.filter("doc_id < 50")), ("two", lambda s, d, sf: d.filter("doc_id >= 20")),
           ("three", lambda s, d, sf: d.select("doc_id"))]
    monkeypatch.setattr(cp, "STAGES", cut)
    assert sorted(r.doc_id for r in cp.run(spark, SF).collect()) == list(range(20, 50))


def test_rules_judge_rows_that_share_an_id_by_their_texts(spark):
    good = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, good, "x"), (1, "too short", "y"), (None, good, "z"), (2, None, None)], "doc_id long, text string, _key string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert sorted(r["_key"] for r in quality_rules.keep_accepted(docs, labels).collect()) == ["x", "z"]
