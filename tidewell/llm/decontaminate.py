"""Benchmark decontamination by template canonicalisation.

Numbers, names (capitalised words inside a sentence) and units (after a number) become typed placeholders. Windows of
``WINDOW`` canonical words, hashed, join documents with benchmark items, so a question with other numbers or names still
meets its original. The matched windows of a document and an item are grouped by alignment (document position less item
position); an alignment counts if its slots are consistent: every benchmark value stands for one document value, and the
other way round. A document leaks an item if the counted alignments cover ``COVERAGE`` of the item's windows, or a run of
``RUN`` words.

Windows of the plain lower-cased words are hashed as well. They have no slots, so nothing limits or contradicts them; they find
word-for-word copies in which one name was changed, that consist of numbers or names mostly, or that are lower-cased. Each kind
is counted by itself, and an item that either kind finds is leaked.

Windows that more than ``FEW`` items hold (a common preamble) don't pair documents with items: they count for the pairs that a rarer
window found. Items that could be leaked by such windows alone are the exception; for these every window pairs. So no leak is missed, and
a preamble doesn't bring all its documents together with all its items.

A bit map of the benchmark's hashes, of fixed size, keeps windows that cannot join from the shuffle; it drops no match.

Defined cases: null and empty texts have no window and no leak; an item shorter than a window is one window; one of
fewer than ``MIN_WORDS`` words, or of placeholders mostly, matches by its plain words only, one of fewer than ``SHORT`` words only documents that have
no other words; a null item_id is an id like any other; copies of a
document are each reported, rows that share their id together; empty tables give an empty result; extra columns are
carried by ``drop_leaks`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from tidewell.llm.common import _FOLD, _WORD, SpanHash, byte_hash, free_name, saved, text_slices, word_spans

WINDOW, MIN_WORDS, SHORT, COVERAGE, RUN, FEW, MAP_BITS = 8, 5, 3, 0.5, 13, 8, 24

# Words that count as units when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs oz gram grams kilogram kilograms ton tons ml l litre litres "
    "liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years percent "
    "dollar dollars euro euros cent cents pound pounds degree degrees km2 m2 mph kmh"
).split()

_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_POINT = np.zeros(256, dtype=bool)
_POINT[[44, 46]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[10, 33, 34, 46, 58, 63]] = True
NUMBER, NAME, UNIT = np.uint64(1), np.uint64(2), np.uint64(3)
#: Keeps the hashes of plain windows apart from those of template windows.
PLAIN = np.uint64(0x5851F42D4C957F2D)


def _word_hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), dtype=np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return np.sort(byte_hash(data).of(np.concatenate([[0], ends[:-1]]), ends))


_UNIT_HASHES = _word_hashes(UNITS)


def canonical(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Canonical word values, plain word hashes, whether a word is a slot, and the words before each document."""
    n = len(data)
    digit = _DIGIT[data]
    inner = np.zeros(n, dtype=bool)
    inner[1:-1] = _POINT[data[1:-1]] & digit[:-2] & digit[2:]
    inner[offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)] - 1] = False
    inner[offsets[:-1][offsets[:-1] < n]] = False
    inside = _WORD[data] | inner
    starts, ends, first = word_spans(inside, offsets)
    words = byte_hash(_FOLD[data]).of(starts, ends)
    if not len(starts):
        return words, words, np.zeros(0, dtype=bool), first
    numeric = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(digit | inner, out=numeric[1:])
    number = numeric[ends] - numeric[starts] == ends - starts
    unit = np.zeros(len(starts), dtype=bool)
    unit[1:] = number[:-1] & np.isin(words[1:], _UNIT_HASHES)
    stops = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(_STOP[data], out=stops[1:])
    opening = np.ones(len(starts), dtype=bool)
    opening[1:] = stops[starts[1:]] > stops[ends[:-1]]
    heads = first[:-1][first[:-1] < len(starts)]
    opening[heads] = True
    unit[heads] = False
    second = data[np.minimum(starts + 1, n - 1)]
    upper = (data[starts] >= 65) & (data[starts] <= 90)
    name = upper & ~opening & (ends - starts > 1) & ((second >= 97) & (second <= 122) | (second >= 128))
    values = words.copy()
    values[number], values[name], values[unit] = NUMBER, NAME, UNIT
    return values, words, number | name | unit, first


def _listed(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bit map holds the leading bits of each hash."""
    top = h >> np.uint64(64 - MAP_BITS)
    return (bits[top >> np.uint64(3)] >> (top & np.uint64(7)).astype(np.uint8)) & 1 == 1


def windows(frame: DataFrame, id_cols: list[str], text_col: str, sizes: list[int], bits: np.ndarray | None = None) -> DataFrame:
    """Id columns, h (window hash), size, pos, total (usable windows of the row), plain (kind), slots (word hashes in the slots).

    Without ``bits``, each row takes windows of the largest size it can fill; with the bit map, of all sizes, those it lists (of
    fewer than ``SHORT`` words only the whole text). A template window is usable when it has ``MIN_WORDS`` words and at most half of
    it are slots; a plain one always is, and has none.
    """
    thin = frame.select(*id_cols, text_col)
    k = len(id_cols)
    longs = [StructField(c, LongType()) for c in ("h", "size", "pos", "total")]
    schema = StructType([*thin.schema.fields[:k], *longs, StructField("plain", BooleanType()), StructField("slots", ArrayType(LongType()))])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(k)):
                values, words, slot, first = canonical(data, offsets)
                n_words = np.diff(first)
                no_slot = np.zeros(len(words) + 1, dtype=np.int64)
                kinds = ((False, SpanHash(values), np.concatenate([[0], np.cumsum(slot)])), (True, SpanHash(words ^ PLAIN), no_slot))
                slot_words = words[slot].view(np.int64)
                for size in sizes:
                    whole = size < max(sizes) if bits is None else size < SHORT
                    fits = n_words == size if whole else n_words >= size
                    count = np.where(fits, n_words - size + 1, 0)
                    row = np.repeat(np.arange(hi - lo), count)
                    pos = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                    at = first[:-1][row] + pos
                    for plain, hashes, slots_before in kinds if size >= MIN_WORDS else kinds[1:]:
                        good = 2 * (slots_before[at + size] - slots_before[at]) <= size
                        total = np.bincount(row[good], minlength=hi - lo)
                        h = hashes.of(at, at + size)
                        pick = np.flatnonzero(good if bits is None else good & _listed(bits, h))
                        for part in np.array_split(pick, max(1, -(-len(pick) // 50_000))):
                            begin = slots_before[at[part]]
                            n = slots_before[at[part] + size] - begin
                            ahead = np.concatenate([[0], np.cumsum(n)])
                            index = np.repeat(begin - ahead[:-1], n) + np.arange(ahead[-1])
                            listed = pa.ListArray.from_arrays(pa.array(ahead, type=pa.int32()), pa.array(slot_words[index]))
                            ids = [c.take(pa.array(lo + row[part])) for c in batch.columns[:k]]
                            kind = pa.array(np.full(len(part), plain))
                            yield pa.RecordBatch.from_arrays(
                                [*ids, pa.array(h[part].view(np.int64)), pa.array(np.full(len(part), size)), pa.array(pos[part]), pa.array(total[row[part]]), kind, listed], names=names
                            )

    return thin.mapInArrow(run, schema)


def bit_map(hashes: DataFrame) -> np.ndarray:
    """Bit map of the leading ``MAP_BITS`` bits of ``h``; the driver receives at most 2 ** (MAP_BITS - 6) rows of 16 bytes."""
    bits = hashes.select(F.shiftrightunsigned("h", 64 - MAP_BITS).alias("bit"))
    rows = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS INT))")).alias("mask")).collect()
    out = np.zeros(1 << (MAP_BITS - 6), dtype="<u8")
    for r in rows:
        out[r["word"]] = r["mask"] & ((1 << 64) - 1)
    return out.view(np.uint8)


def _longest(places: Column) -> Column:
    """Length of the longest run of consecutive places."""
    starts = F.transform(F.array_sort(places), lambda x, i: x - i)  # equal within a run
    return F.array_max(F.transform(F.array_distinct(starts), lambda r: F.size(F.filter(starts, lambda y: y == r))))


def _with(left: DataFrame, right: DataFrame, keys: list[str], extra: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``keys``, null equal to null; of ``right`` only ``extra`` is kept."""
    named = right.select(*[F.col(c).alias(f"{c}_right") for c in keys], *extra)
    joined = left.join(named, reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}_right")) for c in keys]), how)
    return joined.select(*left.columns, *extra)


def benchmark_windows(benchmark: DataFrame, window: int, coverage: float, run_words: int, few: int) -> tuple[DataFrame, DataFrame]:
    """The windows of all items, with ``anchor`` (whether the window pairs documents with the item), and the common ones (h, size, plain)."""
    kind, owner = ["h", "size", "plain"], ["item_id", "total", "size", "plain"]
    item = saved(windows(benchmark.select("item_id", "text"), ["item_id"], "text", list(range(1, window + 1))), "items")
    held = item.select("item_id", "total", *kind).distinct().groupBy(*kind).agg(F.count(F.lit(1)).alias("items"))
    common = saved(held.where(F.col("items") > few).select(*kind), "common")
    tagged = item.join(common.withColumn("common", F.lit(True)), kind, "left").withColumn("common", F.coalesce("common", F.lit(False)))
    places = tagged.where("common").groupBy(*owner).agg(F.collect_set("pos").alias("places"))
    enough = (F.size("places") >= coverage * F.col("total")) | (_longest(F.col("places")) + F.col("size") - 1 >= run_words)
    tagged = _with(tagged, places.where(enough).withColumn("alone", F.lit(True)), owner, ["alone"], "left")
    tagged = tagged.withColumn("anchor", ~F.col("common") | F.coalesce("alone", F.lit(False))).drop("common", "alone")
    return saved(tagged, "anchors"), common


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_cols: list[str], text_col: str = "text", window: int = WINDOW, coverage: float = COVERAGE, run_words: int = RUN, few: int = FEW
) -> DataFrame:
    """Id columns, item_id, coverage, run (longest aligned match in words), exact (no slot of the windows that found it differs): a row per leaked item.

    Where both kinds of windows find an item, coverage and run are the larger ones.
    """
    item, common = benchmark_windows(benchmark, window, coverage, run_words, few)
    sizes = sorted(r["size"] for r in item.select("size").distinct().collect())  # at most ``window`` rows
    found = saved(windows(docs, id_cols, text_col, sizes, bit_map(item)).drop("total"), "found")
    kind = ["h", "size", "plain"]
    right = item.select(*kind, "item_id", F.col("pos").alias("item_pos"), F.col("total").alias("item_total"), F.col("slots").alias("item_slots"), "anchor")
    key = [*id_cols, "item_id", "item_total", "size", "plain"]
    meets = found.join(right.where("anchor").drop("anchor"), kind)
    pairs = saved(meets.select(*key).distinct(), "pairs")
    shared = _with(found.join(common, kind, "left_semi"), pairs, [*id_cols, "size", "plain"], ["item_id", "item_total"])
    also = _with(shared, right.where("not anchor"), [*kind, "item_id", "item_total"], ["item_pos", "item_slots"])
    meets = meets.unionByName(also).withColumn("shift", F.col("pos") - F.col("item_pos"))
    slots = F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b"))
    aligned = meets.groupBy(*key, "shift").agg(F.collect_set("item_pos").alias("seen"), F.array_distinct(F.flatten(F.collect_set(slots))).alias("pairs"))
    one_to_one = [F.size(F.array_distinct(F.col("pairs")[c])) == F.size("pairs") for c in ("a", "b")]
    aligned = aligned.where(one_to_one[0] & one_to_one[1]).withColumn("run", _longest(F.col("seen")) + F.col("size") - 1)
    aligned = aligned.withColumn("exact", F.forall("pairs", lambda p: p["a"] == p["b"]))
    leaks = aligned.groupBy(*key).agg(F.size(F.array_distinct(F.flatten(F.collect_set("seen")))).alias("n"), F.max("run").alias("run"), F.bool_and("exact").alias("exact"))
    leaks = leaks.withColumn("coverage", F.col("n") / F.col("item_total"))
    leaks = leaks.where((F.col("coverage") >= coverage) | (F.col("run") >= run_words))
    return leaks.groupBy(*id_cols, "item_id").agg(F.max("coverage").alias("coverage"), F.max("run").alias("run"), F.bool_and("exact").alias("exact"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text leaks an item; decided by the text, so ids may be null or repeat."""
    a, b = free_name(docs, "k1__"), free_name(docs, "k2__")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({a: F.xxhash64(text), b: F.xxhash64(text, F.lit(1))})
    leaks = saved(find_leaks(keyed, benchmark, [a, b], text_col).select(a, b).distinct(), "leaks")
    return keyed.join(leaks, [a, b], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
