"""Periodic runs of words: stretches that repeat a block of q words at least four times, found with multi-scale minimizers.

Periods up to ``SHORT`` are found by direct lag scans: words equal to the word q places on. Longer periods belong to
scales: scale K takes periods over K/2 up to K. At a scale every place has a hash of its next K words, and of every K/2
neighbouring places the one with the least hash is kept, the leftmost of equals. Inside a run of period q the kept places repeat at
distance q, and as K >= q no K words are equal at a smaller distance; so neighbours among the places of one hash
give the period. A run has at least four periods, so two windows a period apart fit into it at its scale and no run is
missed. Seeds of one distance that follow each other without a gap are one candidate; it is extended word by word, and
what counts is the exact comparison, never a hash.

Documents are independent rows, so nothing is shuffled. A slice of documents of about 1 MB is worked on as one array, with a separator
of its own after each document, that equals no word; a longer document makes a slice of its own. Kept places of all scales
together are a constant part of the words, so time is about n log n in the longest document.

Defined cases: null and empty texts have no words, no runs and an empty collapsed text; repeated rows are rows like any other;
an empty table gives an empty result; only the named columns are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tidewell.llm.common import _SPACE, coded_words, mixed, text_slices

#: Least words of a run, least periods in it (the scales rely on four), longest period of the direct scans (a power of two).
LEAST_WORDS, LEAST_PERIODS, SHORT = 6, 4, 8

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

_STEP = np.uint64(0xD6E8FEB86659FD93)


def _stretches(seq: np.ndarray, lag: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of places in lo..hi whose word equals the one ``lag`` places on."""
    same = np.zeros(hi - lo + 2, dtype=np.int8)
    same[1:-1] = seq[lo:hi] == seq[lo + lag : hi + lag]
    edges = np.flatnonzero(np.diff(same)) + lo
    return edges[::2], edges[1::2]


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima inside blocks, forwards and backwards."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _seeds(grams: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of neighbouring kept places with one hash, for distances of this scale."""
    low = np.uint64(len(grams).bit_length())
    place = np.uint64((1 << int(low)) - 1)
    least = _window_minima(grams >> low << low | np.arange(len(grams), dtype=np.uint64), scale // 2) & place
    kept = least[np.flatnonzero(np.diff(least, prepend=place))].astype(np.int64)
    hashes = grams[kept]
    order = np.argsort(hashes, kind="stable")
    kept, hashes = kept[order], hashes[order]
    away = np.diff(kept)
    good = (hashes[1:] == hashes[:-1]) & (away > scale // 2) & (away <= scale)
    return kept[:-1][good], away[good]


def _candidates(places: np.ndarray, lags: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    """(lag, first place, last place) of seeds without gaps that may span a run."""
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    begin = np.flatnonzero((np.diff(lags, prepend=-1) != 0) | (np.diff(places, prepend=-scale - 1) > scale))
    end = np.append(begin[1:], len(places))[: len(begin)] - 1
    first, last, lag = places[begin], places[end], lags[begin]
    wide = last + scale - first + scale >= (LEAST_PERIODS - 1) * lag
    return zip(lag[wide].tolist(), first[wide].tolist(), last[wide].tolist())


def find_runs(seq: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, smallest period) of all runs in ``seq``, by start and period; ``longest``: most words without a separator."""
    found: dict[tuple[int, int], int] = {}

    def keep(lag: int, begin: np.ndarray, end: np.ndarray) -> None:
        long = end - begin >= max(LEAST_WORDS, LEAST_PERIODS * lag) - lag
        for a, b in zip(begin[long].tolist(), end[long].tolist()):
            key = (a, b + lag - a)
            found[key] = min(lag, found.get(key, lag))

    n, most = len(seq), longest // LEAST_PERIODS
    for lag in range(1, min(SHORT, most, n - 1) + 1):
        keep(lag, *_stretches(seq, lag, 0, n - lag))
    size, grams = 1, mixed(seq.astype(np.uint64))
    while size < 2 * most and n > 2 * size:
        scale = size
        if scale > SHORT and scale // 2 < most:
            for lag, first, last in _candidates(*_seeds(grams, scale), scale):
                lo, hi = max(0, first - scale), min(n - lag, last + 2 * scale)
                while True:
                    begin, end = _stretches(seq, lag, lo, hi)
                    open_lo, open_hi = lo > 0 and len(begin) and begin[0] == lo, hi < n - lag and len(end) and end[-1] == hi
                    if not (open_lo or open_hi):
                        break
                    width = hi - lo
                    lo, hi = max(0, lo - width) if open_lo else lo, min(n - lag, hi + width) if open_hi else hi
                keep(lag, begin, end)
        grams = mixed(grams[:-size] * _STEP + grams[size:])
        size *= 2
    rows = sorted((start, period, length) for (start, length), period in found.items())
    return np.array([(s, m, q) for s, q, m in rows], dtype=np.int64).reshape(-1, 3)


def slice_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Words of each document of a slice: their number, runs, and the words left when each run is cut to one period."""
    ids, words, _, first = coded_words(data, ~_SPACE[data], offsets)
    docs, counts = len(offsets) - 1, np.diff(first)
    opens = first[:-1] + np.arange(docs)  # places of the documents' first words, a separator after each document
    places = np.arange(len(ids)) + np.repeat(np.arange(docs), counts)
    seq = np.empty(len(ids) + docs, dtype=np.int64)
    seq[places] = ids
    seq[first[1:] + np.arange(docs)] = -1 - np.arange(docs)
    runs = find_runs(seq, int(counts.max(initial=0)))
    start, length, period = runs.T
    again = np.zeros(len(seq) + 1, dtype=np.int64)
    np.add.at(again, start + period, 1)
    np.add.at(again, start + length, -1)
    kept = np.cumsum(again)[places] == 0
    left = np.concatenate([[0], np.cumsum(kept)])[first]
    doc = np.searchsorted(opens, start, side="right") - 1
    parts = [pa.array(x) for x in (start - opens[doc], length, period)]
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(docs + 1)), pa.int32()), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
    texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.take(pa.array(ids[kept]))), pa.scalar(b" ", pa.large_binary()))
    return pa.array(counts.astype(np.int64)), runs, texts.cast(pa.large_string()).cast(pa.string())


def collapse_runs(docs: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """Id columns, n_words, runs (array of start, length, period by start and period) and collapsed: the words that are in no run
    after its first period, joined by one space."""
    thin = docs.select(*id_cols, text_col)
    schema = StructType([*thin.schema.fields[:-1], *_parse_datatype_string(f"n_words bigint, runs {RUNS}, collapsed string").fields])
    k = len(id_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(k)):
                ids = batch.slice(lo, hi - lo).columns[:k]
                yield pa.RecordBatch.from_arrays([*ids, *slice_runs(data, offsets)], names=[f.name for f in schema])

    return thin.mapInArrow(run, schema)
