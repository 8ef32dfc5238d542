"""Best-fit packing with several permitted sequence lengths.

A document's length is its words plus one separator; a longer one than the largest capacity is cut into pieces of that
capacity, so no token is lost. Pieces are dealt to shards of about ``SHARD`` rows; every shard is packed by a task of its
own. There the permitted lengths are optimised jointly: the shard is packed best-fit decreasing once for every bin size to
open by default (a larger piece opens the smallest size that holds it), every bin is then downsized to the smallest
size that holds its contents, and the plan of least total cost stays.

The cost of a sequence is ``OVERHEAD + c + c * c / ATTENTION`` for capacity c, padding included.

Defined cases: null and empty texts have length 1; the result has no text; equal rows are packed one by one; shards are
dealt by row number, so a repeated id (or null) spreads; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

CAPACITIES, OVERHEAD, ATTENTION, SHARD = (512, 1024, 2048, 4096, 8192), 256.0, 16384.0, 8192


def cost(capacity: int) -> float:
    return OVERHEAD + capacity + capacity * capacity / ATTENTION


def word_length(text: Column) -> Column:
    """Whitespace-separated words plus one separator."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long") + 1


def best_fit(lengths: Sequence[int], capacities: Sequence[int], default: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each length, in the order given (longest first), and the contents of each bin.

    Open bins stand in a list for each free room; a bit set of the rooms in use gives the tightest room that fits.
    """
    rooms: dict[int, list[int]] = {}
    used, place, offset, contents, size = 0, [], [], [], []
    for n in lengths:
        fits = used >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                used ^= 1 << room
        else:
            room = max(default, next(c for c in capacities if c >= n))
            at = len(contents)
            contents.append(0)
            size.append(room)
        place.append(at)
        offset.append(contents[at])
        contents[at] += n
        left = room - n
        if left:
            rooms.setdefault(left, []).append(at)
            used |= 1 << left
    return place, offset, contents


def pack_shard(lengths: np.ndarray, capacities: Sequence[int] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and downsized bin capacity of each piece, by the plan of least cost (ties: the larger default)."""
    sizes = np.asarray(capacities)
    best = None
    for default in reversed(capacities):
        place, offset, contents = best_fit(lengths.tolist(), capacities, default)
        final = sizes[np.searchsorted(sizes, contents)]
        total = sum(cost(int(c)) * int(n) for c, n in zip(*np.unique(final, return_counts=True)))
        if best is None or total < best[0]:
            best = total, np.asarray(place), np.asarray(offset), final
    return best[1], best[2], best[3][best[1]]


def pieces(docs: DataFrame, length: Column, largest: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, n_tokens): every document cut at multiples of the largest capacity."""
    sized = docs.select(F.col(id_col).alias("doc_id"), length.alias("total"))
    cut = sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / largest))))
    start = F.col("piece") * largest
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.col("total") - start, F.lit(largest)).alias("n_tokens"))


def pack(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, length: Column | None = None, id_col: str = "doc_id", shard_rows: int = SHARD) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, bin_id, bin_offset, bin_capacity."""
    capacities = sorted(capacities)
    cut = pieces(docs, word_length(F.col("text")) if length is None else length, capacities[-1], id_col)
    shards = max(1, -(-docs.count() // shard_rows))
    cut = cut.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        place, offset, capacity = pack_shard(rows["n_tokens"].to_numpy(), capacities)
        return rows.assign(bin_id=rows["shard"].to_numpy() * (1 << 32) + place, bin_offset=offset, bin_capacity=capacity).drop(columns="shard")

    id_type = dict(docs.dtypes)[id_col]
    return cut.groupBy("shard").applyInPandas(run, f"doc_id {id_type}, piece long, start long, n_tokens long, bin_id long, bin_offset long, bin_capacity long")
