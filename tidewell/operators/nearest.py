"""Exact k nearest neighbours: trained cells, one-byte residual codes, two rounds of search, exact scores of the survivors.

* **Cells.** k-means on a bounded sample gives about ``sqrt(N)`` cells (at most ``MOST_CELLS``, fitted on at most
  ``SAMPLE`` vectors). Every vector is placed in its nearest cell and kept as the residual to the cell's centre, one
  byte a dimension with a step of its own, and the exact length of what the code leaves out. So the distance of a query to a
  vector is known within that error, from an eighth of the bytes.
* **Two rounds.** Queries of one cell form blocks; the codes of the cells they visit are sent to them and stream by, so a
  query stands in one place however many blocks it meets. In the first round a query visits the nearest cells that
  hold enough vectors; the k-th smallest upper bound is its reach. In the second round it visits the other cells that
  the triangle inequality leaves within its reach.
* **Survivors.** Only vectors whose lower bound is within the final reach are scored, on their full vectors.

Equal vectors are searched once and listed again at the end, so a third of all rows may be one vector. Both metrics
become a distance by an extra coordinate: ``d^2 = 2 - 2 * score``. Zero queries score 0 everywhere and take the first ids.
The driver sees the sample, the centres and a row per cell. Vectors without clusters prune few cells; the search then
compares all queries with all codes, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewell.functions.scalars import norm, unit
from tidewell.operators.skew import numbered
from tidewell.operators.topk import topk_by
from tidewell.session import cut_lineage, written

#: Slack of distances and of squared distances; scores equal to ten digits are ties.
SLACK, TIE = 1e-9, 1e-9

#: Most cells, most vectors of the sample, vectors and queries of a block, wanted rows beyond which a query's reach stays open.
MOST_CELLS, SAMPLE, BLOCK, OPEN = 4096, 65536, 2048, 4096

#: Vectors of a row of codes (many rows arrive in one batch), queries that share a task, their wanted rows in all, rows of a product with all centres.
CODES, QUERIES, WANTED, ROWS = 64, 16384, 4_000_000, 256


def _slices(batches) -> Iterator[pd.DataFrame]:
    """Batches cut to ``ROWS`` rows, so that their distances to all centres stay small."""
    for pdf in batches:
        for at in range(0, len(pdf), ROWS):
            yield pdf.iloc[at : at + ROWS]


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)[None, :], 0))


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in column])


def train_cells(sample: np.ndarray, cells: int, rounds: int = 6) -> np.ndarray:
    """Centres of ``cells`` cells by k-means; a cell that loses all its vectors keeps its centre."""
    centres = sample[:cells].copy()
    for _ in range(rounds):
        own = np.concatenate([_distances(sample[i : i + 4096], centres).argmin(1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        sizes = np.bincount(own, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def encode(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte a dimension of ``x - centres``, the step of each row, and the length of what the code leaves out."""
    rest = x - centres
    step = np.abs(rest).max(1) / 127
    codes = np.rint(rest / np.where(step > 0, step, 1)[:, None]).astype(np.int8)
    return codes, step, np.linalg.norm(rest - codes * step[:, None], axis=1) + SLACK


def _place(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """(item_id, cell, dist, code, step, err) of (item_id, vec)."""

    def run(batches):
        for pdf in _slices(batches):
            if len(pdf):
                x = _matrix(pdf["vec"])
                away = _distances(x, centres)
                cell = away.argmin(1)
                codes, step, err = encode(x, centres[cell])
                yield pd.DataFrame({"item_id": pdf["item_id"], "cell": cell, "dist": away.min(1), "code": [c.tobytes() for c in codes], "step": step, "err": err})

    kind = vectors.schema["item_id"].dataType.simpleString()
    return vectors.select("item_id", "vec").mapInPandas(run, f"item_id {kind}, cell int, dist double, code binary, step double, err double")


def _visits(queries: DataFrame, centres: np.ndarray, radius: np.ndarray, sizes: np.ndarray, second: bool) -> DataFrame:
    """``queries`` with the cells to visit: at first the nearest that hold ``need`` vectors, then the others within reach.

    ``own``: the cell of the query's block. ``cells`` is a bit set, 64 cells to a word: a query may visit all of them.
    """
    kept = [c for c in queries.columns if c not in ("own", "cells")]

    def run(batches):
        for pdf in _slices(batches):
            if not len(pdf):
                continue
            away = _distances(_matrix(pdf["vec"]), centres)
            order = away.argsort(1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            last = np.minimum((held < pdf["need"].to_numpy()[:, None]).sum(1), len(centres) - 1)
            first = np.zeros(away.shape, dtype=bool)
            np.put_along_axis(first, order, np.arange(len(centres))[None, :] <= last[:, None], axis=1)
            if second:
                first = ~first & (sizes > 0) & (away - radius <= pdf["reach"].to_numpy()[:, None] + SLACK)
            out = pdf[kept].copy()
            out["own"] = order[:, 0]
            out["cells"] = list(_words(first))
            yield out

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema if f.name in kept)
    return queries.mapInPandas(run, f"{kinds}, own int, cells array<bigint>")


def _words(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as bit sets, 64 flags to a word."""
    wide = np.zeros((len(flags), -(-flags.shape[1] // 64) * 64), dtype=bool)
    wide[:, : flags.shape[1]] = flags
    return np.packbits(wide, axis=1, bitorder="little").view("<i8")


def _numbered(key: str, sizes: dict[int, int], by: str, block: int) -> Column:
    """A part of the row's group ``key``, so many that none exceeds ``block`` by much."""
    large = {k: -(-n // block) for k, n in sizes.items() if n > block}
    parts = F.lit(1)
    if large:
        parts = F.coalesce(F.create_map(*[F.lit(x) for kv in large.items() for x in kv])[F.col(key)], F.lit(1))
    return F.pmod(F.xxhash64(by), parts).cast("int")


def _together(centres: np.ndarray, sizes: dict[int, int], block: int) -> np.ndarray:
    """A group for every cell: neighbours along the longest axis of the centres share one as long as they hold at most ``block`` queries."""
    spread = centres - centres.mean(0)
    order = np.argsort(spread @ np.linalg.eigh(spread.T @ spread)[1][:, -1], kind="stable")
    out, group, held = np.zeros(len(centres), dtype=int), 0, 0
    for cell in order:
        n = sizes.get(int(cell), 0)
        if held and held + n > block:
            group, held = group + 1, 0
        out[cell], held = group, held + n
    return out


def _search(asked: DataFrame, placed: DataFrame, centres: np.ndarray, query_sizes: dict[int, int], cell_sizes: dict[int, int]) -> DataFrame:
    """(query_id, item_id, low, reach): vectors whose lower bound is within the query's reach when they stream by; the least reach is the final one.

    ``asked``: query_id, vec, need, reach, own, cells. A block of queries comes first, then the codes of all cells it visits. Blocks
    hold the queries of neighbouring cells, as every block costs a copy of these codes.
    """
    spark = asked.sparkSession
    widest = max(1, min(OPEN, asked.agg(F.max("need")).first()[0] or 1))
    everyone = sum(query_sizes.values())
    block = max(1, min(QUERIES, WANTED // widest, max(BLOCK, -(-everyone // (4 * spark.sparkContext.defaultParallelism)))))
    group = _together(centres, query_sizes, block)
    held = {}
    for cell, n in query_sizes.items():
        held[int(group[cell])] = held.get(int(group[cell]), 0) + n
    blocks = sum(-(-n // block) for n in held.values())
    q = asked.where(F.exists("cells", lambda x: x != 0)).withColumn("own", F.array(*[F.lit(int(g)) for g in group])[F.col("own")])
    q = q.withColumn("qpart", _numbered("own", held, "query_id", block))
    listed = F.collect_list(F.struct("query_id", "vec", "need", "reach", "cells"))
    q_blocks = q.groupBy("own", "qpart").agg(listed.alias("asked"))
    part = F.pmod(F.xxhash64("item_id"), F.array(*[F.lit(-(-cell_sizes.get(c, 1) // CODES)) for c in range(len(centres))])[F.col("cell")])
    v_blocks = placed.groupBy("cell", part.alias("part")).agg(*[F.collect_list(c).alias(c) for c in ("item_id", "code", "step", "err")]).drop("part")
    words = q.groupBy("own", "qpart").agg(F.array(*[F.bit_or(F.col("cells")[i]) for i in range(-(-len(centres) // 64))]).alias("words"))
    every = F.sequence(F.lit(0), F.lit(len(centres) - 1))
    pairs = words.select("own", "qpart", F.explode(F.filter(every, lambda c: F.getbit(F.get("words", F.floor(c / 64).cast("int")), c % 64) == 1)).alias("cell"))
    met = pairs.join(v_blocks, "cell").unionByName(q_blocks, allowMissingColumns=True)
    met = met.select("own", "qpart", F.col("code").isNotNull().cast("int").alias("kind"), "cell", "asked", "item_id", "code", "step", "err")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * blocks)
    streamed = met.repartition(parts, F.struct("own", "qpart")).sortWithinPartitions("own", "qpart", "kind")  # both sides anew, however they lie
    dim = centres.shape[1]

    def run(batches):
        block = None
        for batch in batches:
            kinds, cells = batch.column("kind").to_numpy(), batch.column("cell").fill_null(-1).to_numpy()
            queries, lists = batch.column("asked"), [batch.column(c) for c in ("item_id", "code", "step", "err")]
            for r, (kind, cell) in enumerate(zip(kinds.tolist(), cells.tolist())):
                if kind == 0:
                    block = None  # frees the last block first
                    block = _Block(queries[r].values)
                    continue
                item, code, step, err = (x[r].values for x in lists)
                codes = np.frombuffer(b"".join(code.to_pylist()), dtype=np.int8).reshape(-1, dim)
                rows, cols, low = block.meet(cell, centres[cell] + codes * step.to_numpy()[:, None], err.to_numpy())
                if len(rows):
                    found = [block.ids.take(pa.array(rows)), item.take(pa.array(cols)), pa.array(low), pa.array(block.reach[rows])]
                    yield pa.RecordBatch.from_arrays(found, names=["query_id", "item_id", "low", "reach"])

    kinds = asked.schema["query_id"].dataType.simpleString(), placed.schema["item_id"].dataType.simpleString()
    return streamed.mapInArrow(run, f"query_id {kinds[0]}, item_id {kinds[1]}, low double, reach double")


class _Block:
    """Queries of neighbouring cells while codes stream by: each one's reach, the ``need``-th least upper bound so far."""

    def __init__(self, queries: pa.StructArray):
        part = dict(zip((f.name for f in queries.type), queries.flatten()))
        n = len(queries)
        self.ids = part["query_id"]
        self.x = part["vec"].flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        self.need = part["need"].to_numpy(zero_copy_only=False)
        self.reach = np.array(part["reach"].to_numpy(zero_copy_only=False), dtype=float)
        self.words = part["cells"].flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        self.best = np.full((n, min(OPEN, int(self.need.max()))), np.inf)
        self.loose = max(1e-3, 2e-6 * self.x.shape[1])  # more than a product of single precision may be off
        self.aim = np.zeros((n, self.x.shape[1] + 3), dtype=np.float32)
        self._aimed(np.flatnonzero(np.isfinite(self.reach)))

    def _aimed(self, rows: np.ndarray) -> None:
        """A query and its reach as one vector: its product with that of a vector and its error (``_few``) is positive within the reach."""
        x, wide = self.x[rows], self.reach[rows] ** 2 + TIE
        self.aim[rows] = np.column_stack([x, np.sqrt(wide), (x**2).sum(1) - wide, np.ones(len(rows))])

    def visitors(self, cell: int) -> np.ndarray:
        return np.flatnonzero(self.words[:, cell >> 6] >> (cell & 63) & 1)

    def meet(self, cell: int, y: np.ndarray, err: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and lower bounds of the visitors of ``cell`` and the vectors within their reach."""
        who = self.visitors(cell)
        known = np.isfinite(self.reach[who])
        if known.all():
            return self._few(who, y, err)
        parts = self._all(who[~known], y, err), self._few(who[known], y, err)
        rows, cols, low = (np.concatenate(x) for x in zip(*parts))
        return rows, cols, low

    def _all(self, who: np.ndarray, y: np.ndarray, err: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``meet`` of queries without a reach so far: every vector counts."""
        i, j = np.indices((len(who), len(y))).reshape(2, -1)
        return self._within(who, i, j, _distances(self.x[who], y).ravel(), err)

    def _few(self, who: np.ndarray, y: np.ndarray, err: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``meet`` of queries with a reach: one product of single precision leaves few pairs, which are then measured."""
        slack = err + SLACK
        against = np.column_stack([2 * y, 2 * slack, np.full(len(y), -1.0), slack**2 - (y**2).sum(1)]).astype(np.float32)
        aim = self.aim if len(who) == len(self.aim) else self.aim[who]
        i, j = np.nonzero(aim @ against.T >= -self.loose)
        x, v = self.x[who[i]], y[j]
        away = np.sqrt(np.maximum((x**2).sum(1) + (v**2).sum(1) - 2 * np.einsum("ij,ij->i", x, v), 0))
        return self._within(who, i, j, away, err)

    def _within(self, who: np.ndarray, i: np.ndarray, j: np.ndarray, away: np.ndarray, err: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the pairs ``i`` (in order), ``j`` within the reach, which their upper bounds may lessen first."""
        width, high = self.best.shape[1], away + err[j]
        nearer = np.flatnonzero(high < self.best[who[i], -1])  # the others keep their best
        if len(nearer):
            rows, first, counts = np.unique(i[nearer], return_index=True, return_counts=True)
            row = np.repeat(np.arange(len(rows)), counts)
            pool = np.full((len(rows), width + int(counts.max())), np.inf)
            pool[:, :width] = self.best[who[rows]]
            pool[row, width + np.arange(len(nearer)) - first[row]] = high[nearer]
            pool = np.sort(np.partition(pool, width - 1, axis=1)[:, :width], axis=1)
            who_n = who[rows]
            self.best[who_n] = pool
            at = np.minimum(self.need[who_n], width) - 1
            kth = np.where(self.need[who_n] <= width, pool[np.arange(len(who_n)), at], np.inf)
            less = kth < self.reach[who_n]
            self.reach[who_n[less]] = kth[less]
            self._aimed(who_n[less])
        low = np.maximum(away - err[j] - SLACK, 0)
        kept = low**2 <= self.reach[who[i]] ** 2 + TIE
        return who[i[kept]], j[kept], low[kept]


def _prepared(queries: DataFrame, vectors: DataFrame, metric: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with the extra coordinate: unit length vectors, queries of unit length or zero; ``scale`` turns their product into the score."""
    if metric == "cosine":
        scaled, scale = unit("features"), F.lit(1.0)
    else:
        longest = float(vectors.agg(F.max(norm("features"))).first()[0] or 1.0) or 1.0
        scaled, scale = F.transform("features", lambda x: x.cast("double") / longest), norm("features") * longest
    extra = F.array(F.sqrt(F.greatest(F.lit(0.0), 1.0 - norm("_s") * norm("_s"))))
    v = vectors.select("item_id", scaled.alias("_s")).select("item_id", F.concat("_s", extra).alias("vec"))
    return queries.select("query_id", F.concat(unit("features"), F.array(F.lit(0.0))).alias("vec"), "need", scale.alias("scale")), v


def _scores(rows: DataFrame, q: DataFrame, v: DataFrame) -> DataFrame:
    """(query_id, item_id, score) of given pairs, on the full vectors."""
    pairs = rows.join(q.select("query_id", F.col("vec").alias("qvec"), "scale"), "query_id").join(v, "item_id")

    def run(batches):
        for pdf in batches:
            if len(pdf):
                score = np.einsum("ij,ij->i", _matrix(pdf["qvec"])[:, :-1], _matrix(pdf["vec"])[:, :-1])
                yield pd.DataFrame({"query_id": pdf["query_id"], "item_id": pdf["item_id"], "score": score * pdf["scale"].to_numpy()})

    kinds = (q.schema["query_id"].dataType.simpleString(), v.schema["item_id"].dataType.simpleString())
    return pairs.select("query_id", "item_id", "qvec", "vec", "scale").mapInPandas(run, f"query_id {kinds[0]}, item_id {kinds[1]}, score double")


def _needed(scored: DataFrame, q: DataFrame, different: DataFrame, v: DataFrame) -> DataFrame:
    """(query_id, head, score, _rest) of the heads of equal vectors that a query needs: better ones have fewer than ``need`` members, and
    no more than ``_rest`` members of a head can be wanted. An id that is given several times counts once.
    """
    often = v.groupBy("item_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    sized = scored.join(different.select(F.col("item_id").alias("head"), "copies"), "head").withColumn("_s", F.round("score", 10))
    upto, ties = W.partitionBy("query_id").orderBy(F.desc("_s")), W.partitionBy("query_id", "_s")
    ahead = F.sum("copies").over(upto) - F.sum("copies").over(ties)
    wanted = q.groupBy("query_id").agg((F.max("need") * often).alias("_need"))
    rest = sized.withColumn("_ahead", ahead).join(wanted, "query_id").withColumn("_rest", F.col("_need") - F.col("_ahead")).where("_rest > 0")
    return cut_lineage(rest.select("query_id", "head", "score", "_rest"))


def _first_ids(queries: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """Rows of queries that score 0 everywhere: the first ``need`` ids."""
    most = min(n, queries.agg(F.max("need")).first()[0] or 0)
    head = members.orderBy("item_id").limit(most).select("item_id", F.row_number().over(W.orderBy("item_id")).alias("_rank"))
    asked = queries.select("query_id", F.explode(F.sequence(F.lit(1), F.least("need", F.lit(most)))).alias("_rank"))
    return asked.join(head, "_rank").select("query_id", "item_id", F.lit(0.0).alias("score"))


def nearest(queries: DataFrame, vectors: DataFrame, k: int, metric: str = "cosine", exclude_same: bool = False, cells: int | None = None) -> DataFrame:
    """Best ``k`` vectors per query as ``(query_id, item_id, score)``, ties by item id.

    ``queries``: ``query_id, features`` and optionally ``need`` (rows wanted by this query, for callers
    that filter afterwards; then at least these rows are returned). ``vectors``: ``item_id, features``.
    ``metric='dot'`` ranks by inner product. ``cells``: other than about the square root of the vectors.
    """
    extra = exclude_same + 0
    own_need = "need" in queries.columns
    q = queries.withColumn("need", (F.col("need").cast("long") if own_need else F.lit(k).cast("long")) + extra)
    q, v = _prepared(q, vectors, metric)
    v = cut_lineage(v)
    different = cut_lineage(v.groupBy("vec").agg(F.min("item_id").alias("item_id"), F.count("*").alias("copies")))
    n, most = different.agg(F.count("*"), F.max("copies")).first()
    if not n:
        kinds = queries.schema["query_id"].dataType.simpleString(), vectors.schema["item_id"].dataType.simpleString()
        return queries.sparkSession.createDataFrame([], f"query_id {kinds[0]}, item_id {kinds[1]}, score double")
    cells = min(cells or int(n**0.5) + 1, MOST_CELLS, n)
    picked = F.pmod(F.xxhash64("item_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, min(SAMPLE, 32 * cells) / n)) + 1
    rows = different.where(picked).select("vec").toPandas()["vec"]
    sample = _matrix(rows) if len(rows) else _matrix(different.limit(cells).toPandas()["vec"])
    centres = train_cells(sample, min(cells, len(sample)))
    placed = cut_lineage(_place(different, centres))
    stats = placed.groupBy("cell").agg(F.max("dist").alias("radius"), F.count("*").alias("n")).collect()
    radius, sizes = np.zeros(len(centres)), np.zeros(len(centres), dtype=np.int64)
    for r in stats:
        radius[r.cell], sizes[r.cell] = r.radius, r.n
    cell_sizes = {r.cell: r.n for r in stats}

    zero = ~F.exists("vec", lambda x: x != 0)
    q = cut_lineage(_visits(q.withColumn("reach", F.lit(float("inf"))).withColumn("zero", zero), centres, radius, sizes, second=False))
    seen = q.groupBy("own").agg(F.count("*").alias("n"), F.max("zero").alias("zero")).collect()
    query_sizes = {r.own: r.n for r in seen}
    blank, q = q.where("zero"), q.where("not zero")
    first = cut_lineage(_search(q, placed, centres, query_sizes, cell_sizes))
    reach = first.groupBy("query_id").agg(F.min("reach").alias("reach"))
    again = q.drop("reach").join(reach, "query_id").select("query_id", "vec", "need", "reach")
    again = cut_lineage(_visits(again, centres, radius, sizes, second=True))  # read twice, and products may differ in their last bits
    found = first.unionByName(_search(again, placed, centres, query_sizes, cell_sizes))
    final = F.min("reach").over(W.partitionBy("query_id"))
    found = found.withColumn("reach", final).where(F.col("low") * F.col("low") <= F.col("reach") * F.col("reach") + TIE)
    scored = _scores(found.select("query_id", "item_id"), q, different.select("item_id", "vec"))
    if most > 1:  # equal vectors again
        groups = v.join(different.where("copies > 1").select(F.col("item_id").alias("head"), "vec"), "vec").select("head", "item_id")
        scored = scored.withColumnRenamed("item_id", "head")
        if own_need:
            scored = _needed(scored, q, different, v)
            members = groups.withColumn("_rank", F.row_number().over(W.partitionBy("head").orderBy("item_id")))
            widest = scored.agg(F.max("_rest")).first()[0] or 0
            members = members.where(F.col("_rank") <= widest)
            scored = scored.join(members, "head", "left").where(F.col("_rank").isNull() | (F.col("_rank") <= F.col("_rest")))
        else:
            groups = topk_by(groups.withColumn("score", F.lit(0)), "head", k + extra).drop("score")
            scored = scored.join(groups, "head", "left")
        scored = scored.select("query_id", F.coalesce("item_id", "head").alias("item_id"), "score")
    if any(r.zero for r in seen):
        scored = scored.unionByName(_first_ids(blank, v, v.count()))
    if exclude_same:
        scored = scored.where("query_id <> item_id")
    if own_need:
        return scored
    ranked = topk_by(scored.withColumn("_s", F.round("score", 10)), "query_id", k, score="_s")
    return ranked.drop("_s")


def all_scores(queries: DataFrame, vectors: DataFrame, above: float | None = None) -> DataFrame:
    """Cosine of every query with every vector, for fixed candidate lists: the pairs are the result. Blocks of both sides meet in one product.

    ``above``: only the pairs of a larger score leave the task.
    """
    q, v = _prepared(queries.withColumn("need", F.lit(0)), vectors, "cosine")
    sides = []
    for side, name, n in ((q, "query_id", queries.count()), (v, "item_id", vectors.count())):
        part = F.pmod(F.xxhash64(name), F.lit(max(1, -(-n // BLOCK))))
        sides.append(side.groupBy(part.alias(f"part_{name}")).agg(F.collect_list(F.struct(name, "vec")).alias(name)))
        last = max(1, -(-n // BLOCK)) - 1
    met = sides[0].withColumn("part_item_id", F.explode(F.sequence(F.lit(0), F.lit(last)))).join(sides[1], "part_item_id")

    def run(batches):
        for batch in batches:
            for left, right in zip(batch.column("query_id"), batch.column("item_id")):
                (ids, x), (others, y) = ((x.field(0), _matrix(x.field(1).to_pylist())) for x in (left.values, right.values))
                score = x @ y.T
                for at in range(0, len(ids), ROWS):
                    part = score[at : at + ROWS]
                    i, j = np.nonzero(np.ones_like(part, dtype=bool) if above is None else part > above)
                    found = [ids.take(pa.array(at + i)), others.take(pa.array(j)), pa.array(part[i, j])]
                    yield pa.RecordBatch.from_arrays(found, names=["query_id", "item_id", "score"])

    kinds = queries.schema["query_id"].dataType.simpleString(), vectors.schema["item_id"].dataType.simpleString()
    return met.select("query_id", "item_id").mapInArrow(run, f"query_id {kinds[0]}, item_id {kinds[1]}, score double")


def nearest_approx(queries: DataFrame, vectors: DataFrame, k: int, distance: float, bucket: float = 0.5, tables: int = 4, seed: int = 42) -> DataFrame:
    """Approximate neighbours within ``distance`` (Euclidean on unit vectors) by random-projection hashing: the best of those that share a bucket.

    Rows with like hashes form blocks; a block of queries stands in one task while the vectors of all blocks it shares a bucket with stream
    by, and keeps its best only. So a pair is met once, however many buckets it shares, and no pair is shuffled as a row. Equal vectors are met once.
    """
    lsh = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket, numHashTables=tables, seed=seed)
    q = queries.select("query_id", unit("features").alias("vec")).distinct()
    v = vectors.select("item_id", unit("features").alias("vec")).distinct()
    own = v.groupBy("item_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0  # rows of its own id that a query may have to leave out
    model = lsh.fit(v.select(array_to_vector("vec").alias("v")))
    hashes = F.array(*[vector_to_array(F.col("h")[t])[0].cast("long") for t in range(tables)])

    def sorted_in(rows: DataFrame, size: int) -> DataFrame:
        """(vec, h, block) of different vectors: rows of like hashes share a block."""
        different = rows.select("vec").dropDuplicates().select("vec", array_to_vector("vec").alias("v"))
        hashed = model.transform(different).select("vec", hashes.alias("h"))
        placed = numbered(hashed, [F.col("h"), F.col("vec")], "i")
        return written(placed.withColumn("block", F.floor((F.col("i") - 1) / size)), "hashed")

    everyone = max(1, queries.count())
    size = max(1, min(QUERIES // 2, max(BLOCK // 2, -(-everyone // (4 * q.sparkSession.sparkContext.defaultParallelism)))))
    asked, found = sorted_in(q, size), sorted_in(v, BLOCK // 2)

    def buckets(side: DataFrame, name: str) -> DataFrame:
        return side.select(F.col("block").alias(name), F.posexplode("h").alias("t", "b")).distinct()

    pairs = buckets(asked, "own").join(buckets(found, "block"), ["t", "b"]).select("own", "block").distinct()
    number = F.col("i").alias("number")
    stream = asked.select(F.col("block").alias("own"), F.lit(0).alias("kind"), number, "vec", "h")
    stream = stream.unionByName(found.join(pairs, "block").select("own", F.lit(1).alias("kind"), number, "vec", "h"))
    parts = max(int(q.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * -(-everyone // size))
    stream = stream.repartition(parts, "own").sortWithinPartitions("own", "kind").select("own", "kind", "number", "vec", "h")
    most = 1 - distance**2 / 2

    def run(batches):
        yield from _best_of_blocks(batches, k + own, most, tables)

    near = stream.mapInArrow(run, "asked bigint, number bigint")
    a, b = asked.select(F.col("i").alias("asked"), F.col("vec").alias("qvec")), found.select(F.col("i").alias("number"), "vec")
    square = F.aggregate(F.zip_with("qvec", "vec", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    scored = near.join(a, "asked").join(b, "number").withColumn("d", F.sqrt(square)).where(F.col("d") < distance)
    scored = scored.select("qvec", "vec", (1.0 - F.col("d") * F.col("d") / 2).alias("score"))
    ids = topk_by(v.withColumn("score", F.lit(0)), "vec", k + own).select("vec", "item_id")
    lists = topk_by(scored.join(ids, "vec").select("qvec", "item_id", "score"), "qvec", k + own)
    rows = q.join(lists.withColumnRenamed("qvec", "vec"), "vec").select("query_id", "item_id", "score")
    return topk_by(rows.where("query_id <> item_id"), "query_id", k)


def _best_of_blocks(batches, k: int, most: float, tables: int):
    """(asked, number): for each query of a block the vectors of a common bucket whose product is among its ``k`` best, and those as good but for rounding."""

    def lists(column, width: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    def out(block):
        ids, _, _, best, which = block
        low = np.maximum(best[:, :k].min(1), most)[:, None] - TIE
        i, j = np.nonzero((best >= low) & (which >= 0))
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(which[i, j])], names=["asked", "number"])

    def widened(block, rows):
        ids, x, h = (np.concatenate([old, new]) for old, new in zip(block[:3], rows)) if block else rows
        return ids, x, h, np.full((len(ids), k), -np.inf), np.full((len(ids), k), -1, dtype=np.int64)

    block = own = None
    for batch in batches:
        owns, kinds, ids = (batch.column(c).to_numpy() for c in ("own", "kind", "number"))
        if not len(ids):
            continue
        x, h = lists(batch.column("vec"), len(batch.column("vec")[0])), lists(batch.column("h"), tables)
        cuts = np.flatnonzero(np.append(True, (owns[1:] != owns[:-1]) | (kinds[1:] != kinds[:-1])))
        for at, end in zip(cuts, np.append(cuts[1:], len(ids))):
            if own is not None and owns[at] != own:
                yield out(block)
                block = None
            own = owns[at]
            if kinds[at] == 0:
                block = widened(block, (ids[at:end], x[at:end], h[at:end]))
                continue
            for lo in range(at, end, ROWS):
                hi = min(end, lo + ROWS)
                score = block[1] @ x[lo:hi].T
                common = np.zeros(score.shape, dtype=bool)
                for t in range(tables):
                    common |= block[2][:, t, None] == h[None, lo:hi, t]
                score[~common | (score < most - TIE)] = -np.inf
                block = _kept(block, score, ids[lo:hi], k)
    if block:
        yield out(block)


def _kept(block, score: np.ndarray, numbers: np.ndarray, k: int):
    """The block with its best lists after more scores; they grow where others are as good as the last but for rounding."""
    ids, x, h, best, which = block
    last = np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k] if best.shape[1] > k else best.min(1)
    rows = np.flatnonzero((score >= np.maximum(last, -2)[:, None] - TIE).any(1))
    if not len(rows):
        return block
    pool = np.concatenate([best[rows], score[rows]], axis=1)
    named = np.concatenate([which[rows], np.broadcast_to(numbers, (len(rows), len(numbers)))], axis=1)
    order = np.argsort(-pool, axis=1, kind="stable")
    pool, named = np.take_along_axis(pool, order, 1), np.take_along_axis(named, order, 1)
    wide = max(k, int((pool >= np.maximum(pool[:, k - 1 : k], -2) - TIE).sum(1).max()))
    if wide > best.shape[1]:
        more = wide - best.shape[1]
        best = np.pad(best, ((0, 0), (0, more)), constant_values=-np.inf)
        which = np.pad(which, ((0, 0), (0, more)), constant_values=-1)
    wide = best.shape[1]
    best[rows], which[rows] = pool[:, :wide], np.where(pool == -np.inf, -1, named)[:, :wide]
    return ids, x, h, best, which


def gram(vectors: DataFrame, col: str = "features") -> np.ndarray:
    """Sum of outer products; tasks add up their batches, the driver sees one k x k matrix."""

    def outer(batches):
        total = None
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf[col].to_numpy()).astype(float)
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    cells = vectors.select(col).mapInPandas(outer, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    n = 1 + max((c.i for c in cells), default=-1)
    out = np.zeros((n, n))
    for c in cells:
        out[c.i, c.j] = c.v
    return out


def times(df: DataFrame, matrix: np.ndarray, col: str = "features", out: str = "features") -> DataFrame:
    """Row vectors times a small fixed matrix, batch by batch; ``out`` holds the product."""
    others = [f for f in df.schema.fields if f.name not in (col, out)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + [f"`{out}` array<double>"])

    def product(batches):
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf[col].to_numpy()).astype(float) @ matrix
                yield pdf[[f.name for f in others]].assign(**{out: list(x)})

    return df.mapInPandas(product, schema)
