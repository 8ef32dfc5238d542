"""Repeated passages by a sparse suffix array over all documents.

Suffixes are kept at minimiser positions only: of each run of ``SPAN`` word ``GRAM``-grams the one of least hash. A passage of
``PASSAGE`` words holds such a run at its beginning, and the choice depends on its words alone, so every two copies of a
passage keep a suffix at the same place, with at least ``PASSAGE - SPAN + 1`` words of the passage to its right.

1. Suffixes are grouped by the hash of their first ``PASSAGE - SPAN + 1`` words, the only part that has to be equal; their order by letters
   is never needed. Suffixes that another document has too are candidates; all others go.
2. Candidates are extended left and right: to each window of ``PASSAGE`` words whose minimiser they are.
3. Windows are grouped by hash the same way; those that another document has too are repeats. The repeats of a
   document, overlapping or touching, make up its spans.

The result is exact: a word is in a span if and only if a window of ``PASSAGE`` words around it also occurs in another document
(up to collisions of 64-bit hashes). Counts are pre-aggregated and joins can be split, so a passage of any number of documents is safe.

Of equal texts only one row is cut and moved (found by the Bloom passes of exact dedup, so other texts stay where they are); a passage-long text of two ids (null counts as one) is a span as a whole.

Defined cases: null and short texts have no span; rows that share doc_id and text are one document, and each such row gets its spans; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.common import _FOLD, _WORD, SpanHash, byte_hash, saved, text_slices, word_spans
from tidewell.llm.exact_dedup import drop_copies

PASSAGE, SPAN, GRAM = 50, 32, 8


def _minimisers(data: np.ndarray, offsets: np.ndarray, passage: int) -> tuple[SpanHash, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, and for each window of ``passage`` words: its row, first word and minimiser (words from the slice's first)."""
    data = _FOLD[data]
    starts, ends, first = word_spans(_WORD[data], offsets)
    hashes = SpanHash(byte_hash(data).of(starts, ends))
    count = np.maximum(np.diff(first) - passage + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    begin = first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    if not len(row):
        return hashes, row, begin, begin
    at = np.arange(len(starts) - GRAM + 1)
    grams = hashes.of(at, at + GRAM)
    least = sliding_window_view(grams, SPAN)[begin].argmin(axis=1) if len(begin) < 1 << 14 else _argmin(grams)[begin]
    return hashes, row, begin, begin + least


def _argmin(grams: np.ndarray) -> np.ndarray:
    """Place of the first least value in each run of ``SPAN`` values."""
    best, place = grams[: len(grams) - SPAN + 1].copy(), np.zeros(len(grams) - SPAN + 1, dtype=np.int64)
    for k in range(1, SPAN):
        other = grams[k : k + len(best)]
        less = other < best
        np.copyto(best, other, where=less)
        place[less] = k
    return place


def suffixes(keyed: DataFrame, passage: int) -> DataFrame:
    """(doc, suffix, at): the kept suffixes of ``keyed`` (doc, text); suffix is the hash of the words sure to be in the passage.

    One row more for each text has no suffix, and its number of words as ``at``.
    """
    sure = passage - SPAN + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, data, offsets in text_slices(batch.column(1)):
                hashes, row, begin, place = _minimisers(data, offsets, passage)
                all_rows = row
                place, index = np.unique(place, return_index=True)
                first = np.zeros(len(offsets) - 1, dtype=np.int64)
                first[row[::-1]] = begin[::-1]  # the first window of a row begins with its first word
                row = row[index]
                key = hashes.of(place, place + sure).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(lo + row)), pa.array(key), pa.array((place - first[row]).astype(np.int32))], names=["doc", "suffix", "at"])
                whole = np.unique(all_rows)
                words = (np.bincount(all_rows) + passage - 1)[whole].astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(lo + whole)), pa.nulls(len(whole), pa.int64()), pa.array(words)], names=["doc", "suffix", "at"])

    return keyed.mapInArrow(run, "doc long, suffix long, at int")


def windows(keyed: DataFrame, passage: int) -> DataFrame:
    """(doc, window, begin): the windows around the candidates of ``keyed`` (doc, text, ats)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ats = batch.column(2)
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                hashes, row, begin, place = _minimisers(data, offsets, passage)
                first = np.zeros(len(offsets) - 1, dtype=np.int64)
                first[row[::-1]] = begin[::-1]
                part = ats.slice(lo, hi - lo)
                wanted = np.repeat(first, part.value_lengths().to_numpy(zero_copy_only=False)) + part.flatten().to_numpy(zero_copy_only=False)
                pick = np.flatnonzero(np.isin(place, wanted))
                for p in np.array_split(pick, max(1, -(-len(pick) // 100_000))):
                    key = hashes.of(begin[p], begin[p] + passage).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(lo + row[p])), pa.array(key), pa.array((begin[p] - first[row[p]]).astype(np.int32))], names=["doc", "window", "begin"]
                    )

    return keyed.mapInArrow(run, "doc long, window long, begin int")


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that two or more documents have.

    Written apart from the joins with it, so that adaptive execution may split a value of very many rows there.
    """
    return saved(rows.groupBy(key).agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select(key), f"shared-{key}")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE) -> DataFrame:
    """doc_id, first_word, n_words, first_doc_id (smallest id with a passage of the span): one row per span."""
    if passage < SPAN + GRAM:
        raise ValueError(f"passages of fewer than {SPAN + GRAM} words may hold no whole run of minimisers")
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text, F.lit(1)).alias("doc"), text.alias("text"))
    # each text once: its copies repeat as a whole and need no windows
    once = drop_copies(named.select("doc", "text").where(F.length("text") >= 2 * passage - 1), "doc")
    kept = saved(suffixes(once, passage), "suffixes")
    some, none = F.bool_or(F.col("doc_id").isNotNull()), F.bool_or(F.col("doc_id").isNull())
    copied = (F.min("doc_id") < F.max("doc_id")) | (some & none)
    texts = named.select("doc", "doc_id").groupBy("doc").agg(F.min("doc_id").alias("least_id"), F.coalesce(copied, F.lit(False)).alias("copied"))
    sizes = kept.where("suffix IS NULL").select("doc", F.col("at").alias("size"))
    texts = saved(texts.join(sizes, "doc"), "texts")
    kept = kept.where("suffix IS NOT NULL")
    candidates = kept.join(_shared(kept, "suffix"), "suffix", "left_semi").groupBy("doc").agg(F.collect_set("at").alias("ats"))
    near = saved(windows(once.join(candidates, "doc"), passage), "windows")
    repeats = saved(near.join(_shared(near, "window"), "window", "left_semi"), "repeats")
    firsts = saved(repeats.join(texts.select("doc", "least_id"), "doc").groupBy("window").agg(F.min("least_id").alias("first_doc_id")), "firsts")
    placed = repeats.join(firsts, "window").groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("begin", "first_doc_id"))).alias("found"))
    placed = texts.join(placed, "doc", "left").where("copied OR found IS NOT NULL")
    # a span begins where the window before, if any, ends short of this one
    opens = F.expr(f"filter(found, (x, i) -> i = 0 OR x.begin > found[i - 1].begin + {passage})")
    ends = F.expr(f"filter(found, (x, i) -> i = size(found) - 1 OR found[i + 1].begin > x.begin + {passage})")
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("size") - passage).alias("b")))
    pairs = F.when(F.col("copied"), whole).otherwise(F.arrays_zip(opens["begin"].alias("a"), ends["begin"].alias("b")))
    spans = placed.select("doc", "least_id", "copied", "found", F.explode(pairs).alias("s"))
    first = F.expr("array_min(transform(filter(found, x -> x.begin BETWEEN s.a AND s.b), x -> x.first_doc_id))")
    spans = spans.select(
        "doc",
        F.col("s.a").cast("long").alias("first_word"),
        (F.col("s.b") - F.col("s.a") + passage).cast("long").alias("n_words"),
        F.when(F.col("copied"), F.least(first, "least_id")).otherwise(first).alias("first_doc_id"),
    )
    return saved(spans, "spans").join(named.select("doc", "doc_id"), "doc").select("doc_id", "first_word", "n_words", "first_doc_id")
