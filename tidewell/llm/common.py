"""Helpers shared by the text operators: byte arrays from Arrow batches, word hashes, components, saved frames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.session import cut_lineage, scratch_path

#: Bytes of text worked on at once; a longer document makes a slice of its own.
SLICE_BYTES = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: cuts lineage, compressed, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added while ``df`` has a column called so (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(c):
    """A-Z lower-cased, everything else as it is."""
    return F.translate(c, UPPER, LOWER)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, end row, their bytes, their offsets. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, off, data = column.buffers()
    off = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def word_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, runs ending with their document, and the runs before each document."""
    n = len(inside)
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def coded_words(data: np.ndarray, inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Words, the runs of true bytes: a number for each, the different words by their numbers, their first bytes, and the words before each document."""
    starts, ends, first = word_spans(inside, offsets)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, starts, first


def mixed(h: np.ndarray) -> np.ndarray:
    """Finishing step of splitmix64: spreads every input bit over all output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class SpanHash:
    """64-bit hashes of any spans of a sequence in constant time each, from sums of value times power of an odd base."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        power = np.full(n + 1, _P, dtype=np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * power[:n], out=self.sums[1:])
        inverse = np.full(n + 1, _P_INV, dtype=np.uint64)
        inverse[0] = 1
        self.inverse = np.cumprod(inverse)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + np.uint64(1))


def byte_hash(data: np.ndarray) -> SpanHash:
    return SpanHash(_VALUES[data])


def rows_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list of longs: (node, root), root the smallest node reachable.

    Smallest labels spread along edges and along their own labels in turn, until a round changes nothing; every
    round is a few joins and is written to the checkpoint folder. Nothing but a count reaches the driver.
    """
    # both directions from one evaluation of the edges: a second one may list the same link the other way round
    ways = [F.struct(F.col(x).alias("node"), F.col(y).alias("near")) for x, y in ((a, b), (b, a))]
    both = cut_lineage(edges.select(F.explode(F.array(*ways)).alias("e")).select("e.node", "e.near").where("node <> near").distinct())
    labels = cut_lineage(both.groupBy("node").agg(F.min("near").alias("root")).withColumn("root", F.least("node", "root")))
    while True:
        near = both.join(labels.select(F.col("node").alias("near"), "root"), "near").groupBy("node").agg(F.min("root").alias("by_edge"))
        step = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "by_edge").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("by_label"))
        step = cut_lineage(step.join(jump, "root").select("node", "was", F.least("root", "by_label").alias("root")))
        labels = step.select("node", "root")
        if step.where("root <> was").isEmpty():
            return labels
