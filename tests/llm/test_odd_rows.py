"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, in every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewell.llm import exact_dedup, html_text, language_id, license_scan, packing, simhash, suffix_dedup, toxicity, url_filter
from tidewell.llm.common import table


OPERATORS = {
    "license": (license_scan.scan, True), "mark_copies": (exact_dedup.mark_copies, True), "drop_copies": (exact_dedup.drop_copies, False), "near_copies": (simhash.near_copies, True),
    "keep_one": (simhash.keep_one, False), "spans": (suffix_dedup.repeated_spans, False), "pack": (packing.pack, False),
    "language": (lambda d: language_id.predict(d, language_id.fit(d.withColumn("lang", d["source"])), ["doc_id"]), True),
    "toxicity": (lambda d: toxicity.score(d, toxicity.ToxicityModel(b" grub ", b" snarvex ", 2.0), ["doc_id"]), True),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(odd, none, name):
    run, per_row = OPERATORS[name]
    assert run(none).count() == 0
    rows = run(odd).collect()
    assert not per_row or len(rows) == odd.count()


def test_near_copies_of_odd_rows(odd):
    rows = simhash.near_copies(odd).collect()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["fp"] == by[2]["fp"] == by[3]["fp"] == 0 and by[2]["component_id"] == 1 and by[6]["component_id"] == 5 and by[8]["component_id"] == 7
    lone = odd.where("doc_id = 12").withColumn("doc_id", F.lit(None).cast("long"))
    assert simhash.keep_one(odd.unionByName(lone.withColumn("text", F.lit("quite another text with no equal")))).where("doc_id IS NULL").count() == 1
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} >= {1, 5, 7} and not {r["doc_id"] for r in kept.collect()} & {2, 3, 6, 8}


def test_languages(spark, odd):
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(odd, language_id.fit(odd.selectExpr("doc_id", "text", "if(doc_id = 7, 'aa', 'bb') AS lang")), ["doc_id"]).collect()}
    assert got[1] == got[2] == got[3] == got[9] == ("und", 0.0) and got[7][0] == "aa" and got[11][0] in ("aa", "bb")


def test_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "", ""), (2, "", ""), (None, "http://a/1", "<p>x" * 20000)], "page_id long, url string, html string")
    assert [r["text"] for r in html_text.extract(pages).orderBy("page_id").collect()][1:] == ["", "", ""]
    assert html_text.extract(pages.where("false")).count() == 0
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, toxic int, quality int")
    assert url_filter.judge(pages, labels).count() == 4 and url_filter.judge(pages.where("false"), labels.where("false")).count() == 0


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, sf, odd, none, stage):
    name, run = corpus_pipeline.STAGES[stage]
    for docs in (odd, none):
        out = run(spark, docs, sf)
        assert docs is odd or out.count() == 0
        assert stage == len(corpus_pipeline.STAGES) - 1 or out.schema.simpleString() == docs.schema.simpleString()


def test_pipeline_against_its_parts(spark, sf):
    """Each stage against plain Python over its own input."""
    from .test_brute_force import fingerprint, joined, plain

    docs = table(spark, sf, "documents")
    docs = corpus_pipeline.STAGES[0][1](spark, docs, sf).cache()
    rows = docs.collect()
    best = {}
    for r in rows:
        best[r["text"] or ""] = max(best.get(r["text"] or "", -1), r["doc_id"])
    exact = corpus_pipeline.STAGES[1][1](spark, docs, sf).cache()
    assert {r["doc_id"] for r in exact.collect()} == set(best.values())
    rows = sorted(exact.collect(), key=lambda r: r["doc_id"])
    prints = [fingerprint(r["text"]) for r in rows]
    root = joined(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    near = corpus_pipeline.STAGES[2][1](spark, exact, sf).cache()
    assert {r["doc_id"] for r in near.collect()} == {rows[i]["doc_id"] for i in root}
    items = [plain(r["text"]) for r in table(spark, sf, "benchmark").collect()]
    clean = corpus_pipeline.STAGES[3][1](spark, near, sf).cache()
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in near.collect() if not any(f" {i} " in f" {plain(r['text'])} " for i in items)}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()} == {r["doc_id"] for r in clean.collect()}
