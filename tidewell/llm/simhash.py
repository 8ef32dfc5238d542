"""SimHash near-dedup: fingerprints, BK-trees over shards of them, components of the links.

Fingerprint: 64 bits over the XXH64 hashes of word shingles, repeats counted. Two texts are linked when their
fingerprints differ in at most ``radius`` bits.

Search: the 64 bits are cut into ``radius + 2`` blocks; fingerprints within the radius agree on at least two whole blocks, so
for each pair of blocks a fingerprint goes to the shard named by its bits there. A shard's fingerprints form a BK-tree
(children keyed by their integer Hamming distance to the parent); all of the shard's fingerprints are its queries and
follow only edges within the radius. A shard emits a spanning forest of its links, not its pairs. Shard trees travel
to the queries by shuffle, not by broadcast: all of them together are all fingerprints, whose size has no bound. A shard
of more than ``SHARD`` fingerprints is cut into parts, and each pair of parts is searched by a task of its own.

Defined cases: null text equals empty text, whose fingerprint is zero and links like any other; equal texts and repeated
rows share a fingerprint; rows with a null doc_id count for links but never name a component unless it has no
other id; an empty table gives an empty result; extra columns are carried by ``keep_one`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewell.llm.common import _FOLD, _SPACE, components, free_name, saved, text_slices, word_spans

WORDS, RADIUS, SEED, SHARD = 4, 4, 42, 4096


def slice_fingerprints(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Fingerprints of the documents of one slice of text."""
    data = _FOLD[data]
    starts, ends, _ = word_spans(~_SPACE[data], offsets)
    # one space after each word, no other: shingles are then plain spans
    inside = ~_SPACE[data]
    keep = inside.copy()
    after = ends[ends < len(data)]
    keep[after[_SPACE[data[after]]]] = True
    place = np.cumsum(keep) - keep
    raw = np.where(_SPACE[data], np.uint8(32), data)[keep].tobytes()
    s, e = place[starts], place[ends - 1] + 1
    first = np.searchsorted(starts, offsets)
    n_words = np.diff(first)
    n_shingles = np.where(n_words == 0, 0, np.maximum(n_words - words + 1, 1))
    total = int(n_shingles.sum())
    out = np.zeros(len(n_words), dtype=np.uint64)
    if not total:
        return out
    ahead = np.cumsum(n_shingles) - n_shingles
    at = np.repeat(first[:-1] - ahead, n_shingles) + np.arange(total)
    last = np.minimum(at + words - 1, np.repeat(first[1:], n_shingles) - 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[i:j], SEED) for i, j in zip(s[at].tolist(), e[last].tolist())), dtype=np.uint64, count=total)
    full = np.flatnonzero(n_shingles > 0)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(total, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, ahead[full], axis=0, dtype=np.int64)
    majority = (2 * ones > n_shingles[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, id_cols: list[str], text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Id columns and ``fp``, the fingerprint as a signed long."""
    thin = docs.select(*id_cols, text_col)
    schema = StructType([*thin.schema.fields[:-1], StructField("fp", LongType())])
    k = len(id_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.zeros(batch.num_rows, dtype=np.uint64)
            for lo, hi, data, offsets in text_slices(batch.column(k)):
                fp[lo:hi] = slice_fingerprints(data, offsets, words)
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], pa.array(fp.view(np.int64))], names=[*batch.schema.names[:k], "fp"])

    return thin.mapInArrow(run, schema)


def block_masks(radius: int) -> list[int]:
    """One mask for each pair of blocks: fingerprints within the radius agree under at least one of them."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [x | y for x, y in combinations(blocks, 2)]


def tree_links(codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a shard: each code's position and that of the first code of its group.

    The BK-tree is built level by level from its subsets; each node takes the queries that reach it as one array.
    """
    group = np.arange(len(codes))
    children: dict[int, list[tuple[int, int]]] = {}
    todo = [(np.arange(len(codes)), -1, 0)]
    while todo:
        subset, parent, distance = todo.pop()
        node, rest = int(subset[0]), subset[1:]
        if parent >= 0:
            children.setdefault(parent, []).append((distance, node))
        if len(rest):
            away = np.bitwise_count(codes[rest] ^ codes[node])
            order = np.argsort(away, kind="stable")
            rest, away = rest[order], away[order]
            cut = np.flatnonzero(np.diff(away)) + 1
            todo.extend((part, node, int(np.bitwise_count(codes[part[0]] ^ codes[node]))) for part in np.split(rest, cut))
    walk = [(0, np.arange(len(codes)))]
    while walk:
        node, queries = walk.pop()
        away = np.bitwise_count(codes[queries] ^ codes[node]).astype(np.int64)
        met = np.unique(group[queries[away <= radius]])
        met = met[met != group[node]]
        if len(met):
            met = np.append(met, group[node])
            group[np.isin(group, met)] = met.min()
        for distance, child in children.get(node, ()):
            reach = queries[np.abs(away - distance) <= radius]
            if len(reach):
                walk.append((child, reach))
    linked = np.flatnonzero(group != np.arange(len(codes)))
    return linked, group[linked]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between distinct fingerprints that join the same ones as all pairs within the radius do."""
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in block_masks(radius)]
    keys = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)]
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.t", "k.key")
    # written apart from the join, so that adaptive execution may split a shard of very many rows there
    sizes = saved(rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shards")
    parts = F.ceil(F.col("n") / SHARD).cast("int")
    rows = rows.join(sizes, ["t", "key"]).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("other", other).select("fp", "t", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    shards = rows.groupBy("t", "key", "i", "j").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = np.diff(column.offsets.to_numpy())
            begin = np.cumsum(sizes) - sizes
            two = begin[sizes == 2]
            near = two[np.bitwise_count(values[two] ^ values[two + 1]) <= radius]
            a, b = [values[near]], [values[near + 1]]
            for i in np.flatnonzero(sizes > 2):
                codes = np.sort(values[begin[i] : begin[i] + sizes[i]])
                member, head = tree_links(codes, radius)
                a.append(codes[member])
                b.append(codes[head])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    return shards.mapInArrow(run, "a long, b long")


def groups(printed: DataFrame, radius: int = RADIUS, name: Column | None = None) -> DataFrame:
    """(fp, component_id) of each fingerprint of ``printed`` (doc_id, fp): the smallest ``name`` reachable, doc_id by default."""
    distinct = saved(printed.groupBy("fp").agg(F.min("doc_id" if name is None else name).alias("least")), "prints")
    roots = components(links(distinct, radius)).select(F.col("node").alias("fp"), "root")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    per_root = saved(named.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    return named.select("fp", "root").join(per_root, "root").select("fp", "component_id")


def near_copies(docs: DataFrame, text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links, the document's own included), a row per document."""
    printed = saved(fingerprints(docs, ["doc_id"], text_col), "fp")
    return printed.join(groups(printed, radius), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id and, of several such rows or where no row has an id, the smallest text hash.

    Rows that repeat both stay together. Only ids, hashes and fingerprints are shuffled for the search; a text moves once, when the
    dropped rows are taken out.
    """
    names = [free_name(docs, n) for n in ("key__", "gone_id__", "gone_key__")]
    keyed = docs.withColumn(names[0], F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    printed = saved(fingerprints(keyed, ["doc_id", names[0]], text_col), "fp")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(names[0]).alias("key"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id.id")) & (F.col(names[0]) == F.col("component_id.key"))
    named = printed.join(groups(printed, radius, first), "fp").where(~kept)
    dropped = saved(named.select(F.col("doc_id").alias(names[1]), F.col(names[0]).alias(names[2])).distinct(), "dropped")
    same = keyed["doc_id"].eqNullSafe(dropped[names[1]]) & (keyed[names[0]] == dropped[names[2]])
    return keyed.join(dropped, same, "left_anti").drop(names[0])
