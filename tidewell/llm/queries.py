"""Queries opN_<name> of this subpackage, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewell.llm import collocations, decontaminate, exact_dedup, html_text, language_id, license_scan, packing, periodic_runs, personal_data, simhash, suffix_dedup, toxicity, url_filter
from tidewell.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


def held_out(parts: int, part: int) -> Column:
    """Whether the checksum of a document's id falls into the held-out part; a null id does not."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


@query(
    "op2_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_copies(table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs.where(~held_out(5, 0)), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "margin", "hits")


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


@query("op1_license_scan", license_scan.oracle())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~held_out(4, 2)))
    return language_id.predict(docs, model, ["doc_id"]).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query("op8_html_text")
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of the run query: in a tenth of the documents, by the checksum of their id, the words from word a on repeat the p words at a."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    picked = docs.select("doc_id", "text", h.alias("h"), F.expr("h div 10").alias("g"))
    worded = picked.withColumn("words", F.when(F.expr("h % 10 = 0"), words)).withColumn("n", F.size("words").cast("long"))
    sized = worded.withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "slice(flatten(array_repeat(slice(words, int(a) + 1, int(p)), int((n - a) div p) + 1)), 1, int(n - a))"
    planted = F.expr(f"array_join(concat(slice(words, 1, int(a)), {tail}), ' ')")
    return sized.select("doc_id", F.when(F.expr("n > 0"), planted).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(planted_runs(table(spark, sf_dir, "documents")), ["doc_id"])
    greater = "reduce(runs, runs[0], (b, r) -> if(r.length * b.period > b.length * r.period, r, b))"  # the first of equals
    best = found.withColumn("best", F.when(F.size("runs") > 0, F.expr(greater)))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op12_collocations", collocations.oracle())
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_personal_data")
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents"), ["doc_id"])

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*personal_data.BASE)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in personal_data.BASE]
    return found.select("doc_id", *counts, F.sha2(personal_data.listed(base).cast("binary"), 256).alias("base_sha256"), personal_data.listed(F.col("spans")).alias("spans"))
