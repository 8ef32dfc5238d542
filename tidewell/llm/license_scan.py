"""License scan: an exact set-similarity join of text blocks with license templates; DataFrame functions only.

A block is a line of a document; a line of more than ``BLOCK`` words is cut into windows of ``BLOCK`` words, every
``BLOCK / 2`` words, so each stretch of ``BLOCK / 2`` words lies whole in a block. A text of several lines is cut into such windows
as a whole too, across its newlines, so a notice wrapped over lines meets its template. A block meets a template when it holds at least
``THRESHOLD`` of the template's distinct words. The join works on token sets in one global order, rare words first, by counts over all
documents; words in no template come before all others and are left out at once. Filters, before any pair is
verified: length (a block with fewer template words than the overlap asked for), prefix (the overlap asked for is o: of n words in order, the first
n - o + 1 must share one), position (the words left after the shared one must suffice).

The templates are a fixed list, so the driver holds their words, counts and index, some hundred rows, whatever the corpus size.

Base phrases are found at all places where their words stand consecutively, in the whole text.

Defined cases: null text equals empty text (no words, score 0); rows that share doc_id and text have the same result each; extra columns are not read; empty table:
empty result; a place that two phrases share counts for both.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.llm.common import ascii_lower

# Base phrases and their labels, license notices and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
THRESHOLD, BLOCK = 0.8, 64
#: Separators of words before A-Z are lower-cased; the words are the same ones.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), BETWEEN), lambda w: w != "")


def overlap(size: int, threshold: float = THRESHOLD) -> int:
    """Least shared words for a containment of the threshold (rounded to keep 0.8 * 5 at 4)."""
    return math.ceil(round(threshold * size, 9))


def word_order(docs: DataFrame, text: Column, vocabulary: list[str]) -> list[str]:
    """The template words by their number of places in all documents, rarest first; words of equal count by name."""
    found = F.filter(F.split(F.lower(text), BETWEEN), lambda w: w.isin(vocabulary))
    counts = {r["w"]: r["n"] for r in docs.select(F.explode(found).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def matching_blocks(docs: DataFrame, id_cols: list[str], text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Id columns, line, block, label, containment: a row for each block and template that meet."""
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col), F.lit(""))
    sets = [(label, sorted(set(words.split()))) for label, words in templates]
    vocabulary = sorted({w for _, s in sets for w in s})
    rank = {w: i for i, w in enumerate(word_order(docs, text, vocabulary))}
    least = min(overlap(len(s), threshold) for _, s in sets)
    index, whole = [], []
    for k, (label, s) in enumerate(sets):
        order, o = sorted(rank[w] for w in s), overlap(len(s), threshold)
        whole.append((k, label, order, o))
        index += [(k, r, i, len(s), o) for i, r in enumerate(order[: len(s) - o + 1])]
    index = spark.createDataFrame(index, "template int, word int, i int, size int, least int")
    whole = spark.createDataFrame(whole, "template int, label string, words array<int>, least int")

    # the whole text of several lines goes as one more line, after its last one
    whole_text = F.when(F.contains(text, F.lit("\n")), F.array(text)).otherwise(F.array().cast("array<string>"))
    # cheap test first: enough different template words in the line at all (any case folding that keeps A-Z finds them)
    lines = docs.select(*id_cols, F.posexplode(F.concat(F.split(text, "\n"), whole_text)).alias("line", "body"))
    known = F.array_distinct(F.filter(F.split(F.lower("body"), BETWEEN), lambda w: w.isin(vocabulary)))
    lines = lines.where(F.size(known) >= least).withColumn("all", words_of(F.col("body"))).drop("body")
    n_blocks = F.greatest(F.lit(1), F.ceil((F.size("all") - BLOCK) / (BLOCK // 2)) + 1).cast("int")
    ranks = F.create_map(*[F.lit(x) for w, r in rank.items() for x in (w, r)])

    # only a block's template words leave the row: the words of a long text are not copied once per block
    def inside(block: Column) -> Column:
        words = F.slice("all", block * (BLOCK // 2) + 1, F.lit(BLOCK))
        return F.struct(block.alias("block"), F.array_distinct(F.filter(words, lambda w: w.isin(vocabulary))).alias("known"))

    cut = F.filter(F.transform(F.sequence(F.lit(0), n_blocks - 1), inside), lambda x: F.size(x["known"]) >= least)
    blocks = lines.select(*id_cols, "line", F.explode(cut).alias("x"))
    blocks = blocks.select(*id_cols, "line", "x.block", F.array_sort(F.transform("x.known", lambda w: F.element_at(ranks, w))).alias("has"))

    prefix = F.slice("has", 1, F.size("has") - least + 1)
    near = blocks.select(*id_cols, "line", "block", "has", F.posexplode(prefix).alias("j", "word")).join(F.broadcast(index), "word")
    n = F.size("has")
    near = near.where((n >= F.col("least")) & (F.col("j") <= n - F.col("least")) & (F.least(F.col("size") - F.col("i"), n - F.col("j")) >= F.col("least")))
    shared = F.size(F.array_intersect("has", "words"))
    met = near.select(*id_cols, "line", "block", "has", "template").join(F.broadcast(whole), "template").where(shared >= F.col("least"))
    return met.select(*id_cols, "line", "block", "label", (shared / F.size("words")).alias("containment"))


def base_places(words: Column) -> Column:
    """Array of (at, label) of all base phrases."""
    n = F.size(words)
    nexts = [words, *[F.slice(words, k + 1, F.greatest(n, F.lit(1))) for k in (1, 2)]]
    zipped = F.arrays_zip(*[w.alias(f"w{k}") for k, w in enumerate(nexts)])

    def label(x: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, name in PHRASES:
            same = [x[f"w{k}"] == F.lit(w) for k, w in enumerate(phrase.split())]
            found = F.when(same[0] & same[1] & (same[2] if len(same) > 2 else F.lit(True)), F.lit(name)).otherwise(found)
        return found

    marked = F.transform(zipped, lambda x, i: F.struct(i.cast("long").alias("at"), label(x).alias("label")))
    return F.filter(marked, lambda x: x["label"].isNotNull())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("body"))
    n_words = F.regexp_count("body", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")
    none = F.array().cast("array<struct<at:bigint,label:string>>")
    places = F.when(F.col("body").rlike("(?i)license"), base_places(words_of(F.col("body")))).otherwise(none)
    base = keyed.select("doc_id", "key", n_words.alias("n_words"), places.alias("places"))
    met = matching_blocks(keyed, ["doc_id", "key"], "body")
    met = met.groupBy("doc_id", "key").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    met = met.withColumnsRenamed({"doc_id": "doc_id_", "key": "key_"})
    both = base.join(met, F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("key") == F.col("key_")), "left")
    base_labels = F.array_distinct(F.transform("places", lambda p: p["label"]))
    labels = F.array_union(base_labels, F.coalesce("more", F.array().cast("array<string>")))
    ats = F.transform("places", lambda p: p["at"])
    score = F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return both.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(ats).alias("first_word"),
        F.array_max(ats).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        score.alias("score"),
    )


def oracle() -> str:
    """The same by brute force over the blocks of single lines: every block against every template."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    rows = ", ".join(f"({k}, '{label}', {sorted(set(words.split()))})" for k, (label, words) in enumerate(TEMPLATES))
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, i AS place, '{name}' AS label FROM w, unnest(range(len(words))) u(i) WHERE " + " AND ".join(f"words[i + {k + 1}] = '{x}'" for k, x in enumerate(phrase.split()))
        for phrase, name in PHRASES
    )
    return f"""
    WITH t(k, label, words) AS (VALUES {rows}),
    d AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS body FROM documents),
    w AS (SELECT doc_id, regexp_extract_all(body, '{pattern}') AS words FROM d),
    p AS ({phrases}),
    base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM p GROUP BY doc_id),
    lines AS (SELECT doc_id, regexp_extract_all(l, '{pattern}') AS words FROM d, unnest(string_split(body, chr(10))) u(l)),
    blocks AS (SELECT doc_id, words[b * {BLOCK // 2} + 1 : b * {BLOCK // 2} + {BLOCK}] AS words
               FROM lines, unnest(range(greatest(1, CAST(ceil((len(words) - {BLOCK}) / {BLOCK // 2}.0) AS BIGINT) + 1))) u(b)),
    met AS (SELECT doc_id, t.label, len(list_intersect(t.words, blocks.words)) / len(t.words) AS containment
            FROM blocks JOIN t ON len(list_intersect(t.words, blocks.words)) >= ceil(round({THRESHOLD} * len(t.words), 9))),
    best AS (SELECT doc_id, max(containment) AS best FROM met GROUP BY doc_id),
    l AS (SELECT doc_id, label, true AS base FROM p UNION ALL SELECT doc_id, label, false FROM met),
    labels AS (SELECT doc_id, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
                      string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM l GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
    FROM w LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN labels USING (doc_id)
    """
