"""Phrase collocations by top-order marginalisation: only the longest windows are counted, ``ROLLUP`` sums them to all shorter phrases.

Each word starts one window: itself and the words that follow it, as lead columns ``w0`` to ``w4``, padded with nulls from the end
of its piece. Windows are counted once, in the slice, then in the map task, then over the shuffle. A phrase of k words
starts where a window starts with it, so ``ROLLUP (lang, w0, ..., w4)`` gives the counts of all phrases of one to five words,
and of all words of a language, from these counts alone.

Most windows of five words are unique, so a window is padded earlier, where it can't matter: every phrase in the result, and every part
of it, occurs ``LEAST`` times or more. A first pass counts hashed words and pairs of neighbours in ``slots`` counters, summed in the
map tasks first, a second one the triples of words whose pairs passed. A window ends before a word that would complete a pair or triple with a
counter under ``LEAST``; a window without any word left adds to the number of words only. Counters are never too small, so no count
in the result changes; full counters only mean that fewer windows are cut. What is broadcast is one bit a counter and pass: at most
``MOST_SLOTS`` / 8 = 32 MB each, however large the input.

All arithmetic of scores is decimal: products may pass 64 bits.

Defined cases: null text is empty, null lang is ``und``; repeated rows count each time; ties are broken by count, then phrase; an empty table gives an
empty result; only lang and text are read, so other columns may have any names. Empty texts and texts of one word add to the number of words only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.llm.common import _FOLD, byte_hash, coded_words, mixed, saved, text_slices

#: Words of the longest phrase, least occurrences of a phrase, percentage of its occurrences that a longer phrase must cover to replace it, phrases returned for each language.
LONGEST, LEAST, COVERED, TOP = 5, 100, 100, 2000

#: Least and most counters of word pairs, bytes of text for each.
LEAST_SLOTS, MOST_SLOTS, BYTES_PER_SLOT = 1 << 20, 1 << 28, 4

#: Parts of a language whose first phrases are found apart.
PARTS = 64

_SPLIT = np.zeros(256, dtype=bool)
_SPLIT[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_WORD = ~_SPLIT
_WORD[[9, 32]] = False
_STEP = np.uint64(0xD6E8FEB86659FD93)

WINDOW = [f"w{i}" for i in range(LONGEST)]


class _Slice:
    """Words of a slice of documents: numbers, languages, and whether the next word follows in the same piece."""

    def __init__(self, langs: pa.Array, data: np.ndarray, offsets: np.ndarray):
        self.ids, self.words, starts, first = coded_words(_FOLD[data], _WORD[data], offsets)
        coded = langs.cast(pa.large_binary()).dictionary_encode()
        self.langs = coded.dictionary
        self.lang = np.repeat(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(first))
        opens = np.zeros(len(starts) + 1, dtype=bool)
        opens[first] = True
        piece = np.cumsum(_SPLIT[data])[starts]
        self.follows = np.zeros(len(starts), dtype=bool)
        self.follows[:-1] = (piece[1:] == piece[:-1]) & ~opens[1:-1]

    def slots(self, at: np.ndarray, size: int, slots: int) -> np.ndarray:
        """Counters of the phrases of ``size`` words that start at words ``at``."""
        word, lang = _hashes(self.words), _hashes(self.langs)
        phrase = mixed(lang[self.lang[at]] + np.uint64(size))
        for step in range(size):
            phrase = phrase * _STEP + word[self.ids[at + step]]
        return (mixed(phrase) & np.uint64(slots - 1)).astype(np.int64)

    def frequent(self, at: np.ndarray, size: int, bits: np.ndarray) -> np.ndarray:
        """Those of ``at`` whose counter is set in ``bits``."""
        slot = self.slots(at, size, 8 * len(bits))
        return at[(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)]

    def starts(self, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Frequent words, and those of them that start a frequent pair."""
        words = self.frequent(np.arange(len(self.ids)), 1, short)
        known = np.zeros(len(self.ids) + 1, dtype=bool)
        known[words] = True
        return words, self.frequent(words[self.follows[words] & known[words + 1]], 2, short)

    def triples(self, pairs: np.ndarray) -> np.ndarray:
        """First words of the triples of frequent pairs."""
        paired = np.zeros(len(self.ids) + 1, dtype=bool)
        paired[pairs] = True
        return pairs[paired[pairs + 1]]


def _hashes(words: pa.Array) -> np.ndarray:
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    _, bounds, data = words.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    return byte_hash(np.frombuffer(data, dtype=np.uint8) if data and data.size else np.zeros(0, np.uint8)).of(bounds[:-1], bounds[1:])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[_Slice]:
    for batch in batches:
        for lo, hi, data, offsets in text_slices(batch.column(1)):
            yield _Slice(batch.column(0).slice(lo, hi - lo), data, offsets)


def slots_for(text_bytes: int) -> int:
    return min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (text_bytes // BYTES_PER_SLOT).bit_length()))


def frequent_slots(texts: DataFrame, least: int, slots: int, short: Broadcast | None = None) -> Broadcast:
    """One bit a counter: whether its phrases occur ``least`` times or more. Words and pairs, or, with their bits ``short``, triples. ``texts``: lang, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = short and np.frombuffer(short.value, dtype=np.uint8)
        for part in _slices(batches):
            if bits is None:
                found = np.concatenate([part.slots(np.arange(len(part.ids)), 1, slots), part.slots(np.flatnonzero(part.follows), 2, slots)])
            else:
                found = part.slots(part.triples(part.starts(bits)[1]), 3, slots)
            slot, hits = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(hits)], names=["slot", "hits"])

    full = texts.mapInArrow(run, "slot int, hits long").groupBy("slot").agg(F.sum("hits").alias("hits")).where(F.col("hits") >= least)
    bits = np.zeros(slots // 8, dtype=np.uint8)
    packed = full.groupBy(F.expr("slot >> 6").alias("word")).agg(F.expr("bit_or(shiftleft(1L, slot & 63))").alias("mask")).toArrow()
    bits.view(np.int64)[packed["word"].to_numpy()] = packed["mask"].to_numpy()
    return texts.sparkSession.sparkContext.broadcast(bits.tobytes())


def slice_windows(part: _Slice, short: np.ndarray, long: np.ndarray) -> list[pa.Array]:
    """Language, padded window and number of occurrences of the different windows of a slice."""
    n, words = len(part.ids), max(1, len(part.words))
    single, pairs = part.starts(short)
    goes_on = np.zeros(n + LONGEST, dtype=bool)
    goes_on[part.frequent(part.triples(pairs), 3, long)] = True
    size = np.zeros(n, dtype=np.int64)
    size[single] = 1
    size[pairs] = 2
    for more in range(LONGEST - 2):
        size += (size == more + 2) & goes_on[more : n + more]
    begin, counts, sizes = [], [], []
    for k in range(LONGEST + 1):
        at = np.flatnonzero(size == k)
        key = part.lang[at]
        for step in range(k):
            key = np.unique(key, return_inverse=True)[1] * words + part.ids[at + step]
        _, place, count = np.unique(key, return_index=True, return_counts=True)
        begin.append(at[place])
        counts.append(count)
        sizes.append(np.full(len(place), k))
    begin, counts, sizes = np.concatenate(begin), np.concatenate(counts), np.concatenate(sizes)
    columns = [part.langs.take(pa.array(part.lang[begin]))]
    for step in range(LONGEST):
        ids = part.ids[np.minimum(begin + step, n - 1)]
        columns.append(part.words.take(pa.array(ids, mask=sizes <= step)))
    return [*(c.cast(pa.large_string()).cast(pa.string()) for c in columns), pa.array(counts.astype(np.int64))]


def count_phrases(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, words, f): occurrences of all phrases of one to five words that occur ``least`` times or more; without words, of all words of the language."""
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    slots = slots_for(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    short = frequent_slots(texts, least, slots)
    long = frequent_slots(texts, least, slots, short)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(x.value, dtype=np.uint8) for x in (short, long)]
        for part in _slices(batches):
            yield pa.RecordBatch.from_arrays(slice_windows(part, *bits), names=["lang", *WINDOW, "n"])

    windows = texts.mapInArrow(run, f"lang string, {', '.join(f'{w} string' for w in WINDOW)}, n long")
    windows = saved(windows.groupBy("lang", *WINDOW).agg(F.sum("n").alias("n")), "windows")
    summed = windows.rollup("lang", *WINDOW).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # the grouping number of k words is 2 ** (LONGEST - k) - 1; a padded k-th word means that the phrase is shorter
    phrase = F.lit(False)
    for k, w in enumerate(WINDOW, 1):
        phrase |= (F.col("level") == (1 << (LONGEST - k)) - 1) & F.col(w).isNotNull() & (F.col("f") >= least)
    whole = F.col("level") == (1 << LONGEST) - 1
    return summed.where(phrase | whole).select("lang", F.array_compact(F.array(*WINDOW)).alias("words"), "f")


def _joined(words: Column | str) -> Column:
    return F.array_join(words, " ")


def exact_score(a: str, n: str, l: str, r: str) -> Column:
    """floor(1000 * a * n / (l * r)) of long columns, exact up to 38 digits."""
    wide = {c: f"CAST({c} AS DECIMAL(38, 0))" for c in (a, n, l, r)}
    return F.expr(f"(1000 * {wide[a]} * {wide[n]}) DIV ({wide[l]} * {wide[r]})")


def score_phrases(counted: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of all phrases of two words or more: the lowest score of all cuts, the first of equals."""
    known = counted.where(F.size("words") > 0).select("lang", _joined("words").alias("phrase"), "f")
    totals = counted.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = counted.where(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"), cut)
    cuts = cuts.select("*", _joined(F.slice("words", 1, F.col("k"))).alias("first"), _joined(F.slice("words", F.col("k") + 1, LONGEST)).alias("rest"))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    scored = cuts.join(totals, "lang").withColumn("score", exact_score("a", "n", "l", "r"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    scored = scored.groupBy("lang", "words", "a", "n").agg(best)
    return scored.select("lang", _joined("words").alias("phrase"), "words", "a", "best.l", "best.r", "n", "best.score")


def maximal(scored: DataFrame, covered: int = COVERED) -> DataFrame:
    """``scored`` without the phrases inside a longer one that has ``covered`` percent of their occurrences.

    Between a phrase and a longer one around it lies, word by word, a phrase with no fewer occurrences than the longer; so the ones longer by one word decide.
    """
    size = F.size("words")
    inner = F.explode(F.array(_joined(F.slice("words", 1, size - 1)), _joined(F.slice("words", 2, size)))).alias("phrase")
    around = scored.where(size > 2).select("lang", "a", inner).groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    return scored.join(around, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("around") < covered * F.col("a"), F.lit(True))).drop("around")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by score, then count, then phrase."""
    counted = saved(count_phrases(docs, least, text_col, lang_col), "phrases")
    scored = saved(score_phrases(counted), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = maximal(scored, covered).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    """DuckDB: every phrase of one to five words counted apart."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
    ), worded AS (
      SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS w FROM pieces
    ), placed AS (
      SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded WHERE len(w) > 0
    ), sized AS (
      SELECT lang, w, i, unnest(range(1, least({LONGEST}, len(w) - i + 1) + 1)) AS k FROM placed
    ), f AS (
      SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f FROM sized GROUP BY ALL
    ), total AS (
      SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
    ), wanted AS (
      SELECT lang, phrase, string_split(phrase, ' ') AS w, k, f AS a FROM f WHERE k > 1 AND f >= {LEAST}
    ), cuts AS (
      SELECT *, unnest(range(1, k)) AS c FROM wanted
    ), parts AS (
      SELECT lang, phrase, w, a, c, array_to_string(w[:c], ' ') AS p, array_to_string(w[c + 1:], ' ') AS q FROM cuts
    ), scored AS (
      SELECT s.lang, s.phrase, s.w, s.a, s.c, x.f AS l, y.f AS r, t.n, (1000 * s.a::HUGEINT * t.n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
      FROM parts s JOIN f x ON x.lang = s.lang AND x.phrase = s.p JOIN f y ON y.lang = s.lang AND y.phrase = s.q JOIN total t ON t.lang = s.lang
    ), best AS (
      SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
    ), kept AS (
      SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM best o WHERE o.lang = b.lang AND len(o.w) > len(b.w) AND 100 * o.a >= {COVERED} * b.a AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' '))
    ), ranked AS (
      SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM kept
    )
    SELECT * FROM ranked WHERE rank <= {TOP}
    """
