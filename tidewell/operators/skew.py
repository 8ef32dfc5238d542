"""Exact building blocks that stay balanced when one key owns a large share of the rows.

* ordered state per key is computed per (key, piece) and stitched through one summary row per piece;
  a key with many rows is cut into pieces of bounded size along its order;
* exact quantiles pre-aggregate equal values and rank only the value buckets that hold a
  wanted rank;
* co-occurrence candidates treat all large groups, however many, through bit sets of the items
  that meet in blocks, instead of emitting every pair inside them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewell.session import cut_lineage, written

#: Rows of a key beyond which it is cut into pieces of about this size, and rows of a task beyond which more tasks share the keys.
PIECE_ROWS, TASK_ROWS = 200_000, 500_000


def with_pieces(df: DataFrame, keys: list[str], order: list[str], out: str, piece_rows: int | None = None) -> DataFrame:
    """``df`` with a piece number ``out`` that rises along ``order`` inside each key; a key's piece holds about ``piece_rows`` rows at most.

    Keys of no more rows are one piece, where they lie. The rows of the others are dealt by ranges of (keys, order), whatever
    their times: a key may have all its rows in one minute. The cuts come from a sample and are fixed by writing the rows once, so every
    reader sees the same pieces. ``order`` should be unique inside a key, or its ties stay together.
    """
    rows = PIECE_ROWS if piece_rows is None else piece_rows
    sizes = written(df.groupBy(*keys).agg(F.count("*").alias("_n")), "key-sizes")
    hot = sizes.where(F.col("_n") > rows)
    total, everything = sizes.agg(F.sum(F.when(F.col("_n") > rows, F.col("_n"))), F.sum("_n")).first()
    parts = (everything or 0) // TASK_ROWS + 1
    if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        df = df.repartition(parts, *keys)  # what a task sorts does not grow with the input
    if not total:
        return df.withColumn(out, F.lit(0))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]

    def side(how: str) -> DataFrame:
        return df.alias("l").join(hot.alias("h"), same, how)

    cut = side("left_semi").repartitionByRange(-(-total // rows) + 1, *keys, *order).withColumn(out, F.spark_partition_id())
    return side("left_anti").withColumn(out, F.lit(0)).unionByName(written(cut, "pieces"))


def with_key_count(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Row count per key joined back: partial aggregation plus a join AQE can split."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias(out)), keys)


def dense_ids(df: DataFrame, key: str, out: str, slots: int = 4096) -> DataFrame:
    """Number distinct keys 1..n without one global sort: rank inside hash slots plus each slot's offset."""
    placed = df.withColumn("_s", F.pmod(F.xxhash64(key), F.lit(slots)))
    sizes = placed.groupBy("_s").agg(F.count("*").alias("_n"))
    sizes = sizes.select("_s", (F.sum("_n").over(W.orderBy("_s")) - F.col("_n")).alias("_off"))  # at most `slots` rows
    ranked = placed.withColumn("_r", F.row_number().over(W.partitionBy("_s").orderBy(key)))
    return ranked.join(sizes, "_s").withColumn(out, F.col("_off") + F.col("_r")).drop("_s", "_r", "_off")


def numbered(df: DataFrame, order: list[Column], out: str, piece_rows: int | None = None) -> DataFrame:
    """Number the rows 1..n along ``order``, of any types, without one global sort.

    Rows are dealt by ranges into pieces of about ``piece_rows`` and numbered inside their piece; the sizes of the pieces ahead are added.
    """
    parts = df.count() // (PIECE_ROWS if piece_rows is None else piece_rows) + 1
    cut = written(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()), "numbered")
    sizes = cut.groupBy("_p").agg(F.count("*").alias("_n"))
    sizes = sizes.select("_p", (F.sum("_n").over(W.orderBy("_p")) - F.col("_n")).alias("_off"))  # a row per piece
    ranked = cut.withColumn("_r", F.row_number().over(W.partitionBy("_p").orderBy(*order)))
    return ranked.join(sizes, "_p").withColumn(out, F.col("_off") + F.col("_r")).drop("_p", "_r", "_off")


def previous_row(df: DataFrame, keys: list[str], order: list[str], carry: list[str], out: str = "prev", piece_rows: int | None = None) -> DataFrame:
    """Struct of ``carry`` of the preceding row per key (null for the first row)."""
    d = with_pieces(df, keys, order, "_b", piece_rows)
    local = W.partitionBy(*keys, "_b").orderBy(*order)
    d = d.withColumn("_p", F.lag(F.struct(*carry)).over(local))
    tails = d.groupBy(*keys, "_b").agg(F.max_by(F.struct(*carry), F.struct(*order)).alias("_tail"))
    tails = tails.select(*keys, "_b", F.lag("_tail").over(W.partitionBy(*keys).orderBy("_b")).alias("_before"))
    return (
        d.join(tails, [*keys, "_b"])
        .withColumn(out, F.coalesce("_p", "_before"))
        .drop("_b", "_p", "_before")
    )


def sessionise(
    df: DataFrame,
    keys: list[str],
    ts: str,
    order: list[str],
    gap_s: float,
    starts: Column | None = None,
    piece_rows: int | None = None,
) -> DataFrame:
    """Add ``session`` (1, 2, … per key), ``prev_ts`` and ``is_break``.

    A row opens a session when it is the key's first, or when more than ``gap_s`` seconds passed
    since the previous row and ``starts`` holds for it. ``gap_s < 0`` never splits. The rows of a piece are ordered in
    one task; one summary row per piece carries the state on, so a hot key's rows never meet in one task.
    """
    d = with_pieces(df.withColumn("_starts", F.lit(True) if starts is None else starts), keys, order, "_b", piece_rows)
    d = d.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    local = W.partitionBy(*keys, "_b").orderBy(*order)

    def breaks(before: Column) -> Column:
        if gap_s < 0:
            return F.lit(False)
        return (F.col("_us") - before > int(gap_s * 1_000_000)) & F.col("_starts")

    d = d.withColumn("_lp", F.lag("_us").over(local))
    d = d.withColumn("_lb", F.when(F.col("_lp").isNotNull(), breaks(F.col("_lp"))).otherwise(False).cast("long"))
    d = d.withColumn("_lc", F.sum("_lb").over(local.rowsBetween(W.unboundedPreceding, W.currentRow)))
    summary = d.groupBy(*keys, "_b").agg(
        F.max("_us").alias("_last"),
        F.min_by(F.struct("_us", "_starts"), F.struct(*order)).alias("_head"),
        F.sum("_lb").alias("_n"),
    )
    across = W.partitionBy(*keys).orderBy("_b")
    summary = summary.withColumn("_pl", F.lag("_last").over(across)).select(
        *keys, "_b", "_n", "_pl", F.col("_head._us").alias("_us"), F.col("_head._starts").alias("_starts")
    )
    summary = summary.withColumn("_fb", F.when(F.col("_pl").isNull(), True).otherwise(breaks(F.col("_pl"))).cast("long"))
    summary = summary.withColumn("_base", F.sum(F.col("_n") + F.col("_fb")).over(across) - F.col("_n"))
    summary = summary.select(*keys, "_b", "_pl", "_fb", "_base")
    first = F.col("_lp").isNull()
    return (
        d.join(summary, [*keys, "_b"])
        .withColumn("session", F.col("_base") + F.col("_lc"))
        .withColumn("prev_ts", F.timestamp_micros(F.coalesce("_lp", "_pl")))
        .withColumn("is_break", F.when(first, F.col("_fb")).otherwise(F.col("_lb")) == 1)
        .drop("_b", "_starts", "_us", "_lp", "_lb", "_lc", "_pl", "_fb", "_base")
    )


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], rule: str = "linear", buckets: int = 128) -> DataFrame:
    """Exact quantiles per key as rows ``(keys…, p, value)``.

    ``rule='linear'`` interpolates at ``p*(n-1)``; ``rule='np1'`` at rank ``p*(n+1)`` clamped to the ends.
    """
    v = F.col(value).cast("double")
    own_key = not keys
    if own_key:
        df, keys = df.withColumn("_all", F.lit(1)), ["_all"]
    counted = df.where(v.isNotNull()).groupBy(*keys, v.alias("_v")).agg(F.count("*").alias("_c"))
    cuts = F.percentile_approx("_v", [i / buckets for i in range(1, buckets)], 10000)  # of the distinct values: buckets of like size, whatever the tail
    span = counted.groupBy(*keys).agg(cuts.alias("_cuts"), F.sum("_c").alias("_n"))

    def target(p: float) -> Column:
        if rule == "linear":
            pos = (F.col("_n") - 1) * F.lit(float(p))
        else:
            pos = F.least(F.greatest(F.lit(float(p)) * (F.col("_n") + 1) - 1, F.lit(0.0)), (F.col("_n") - 1).cast("double"))
        r0 = F.floor(pos)
        return F.struct(F.lit(float(p)).alias("p"), r0.alias("r0"), F.least(r0 + 1, F.col("_n") - 1).alias("r1"), (pos - r0).alias("f"))

    span = span.withColumn("_t", F.array(*[target(p) for p in probs]))
    placed = counted.join(span, keys).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
    sums = placed.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
    across = W.partitionBy(*keys).orderBy("_b")
    sums = sums.withColumn("_before", F.sum("_bc").over(across) - F.col("_bc"))

    def hit(start: Column, end: Column) -> Column:
        return F.filter("_t", lambda t: ((t.r0 >= start) & (t.r0 < end)) | ((t.r1 >= start) & (t.r1 < end)))

    near = placed.join(sums, [*keys, "_b"]).where(F.size(hit(F.col("_before"), F.col("_before") + F.col("_bc"))) > 0)
    inside = W.partitionBy(*keys, "_b").orderBy("_v")
    near = near.withColumn("_end", F.col("_before") + F.sum("_c").over(inside)).withColumn("_start", F.col("_end") - F.col("_c"))
    rows = near.select(*keys, "_v", "_start", "_end", F.explode(hit(F.col("_start"), F.col("_end"))).alias("t"))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col(f"t.{rank}") >= F.col("_start")) & (F.col(f"t.{rank}") < F.col("_end")), F.col("_v")))

    out = rows.groupBy(*keys, F.col("t.p").alias("p"), F.col("t.f").alias("_f")).agg(at("r0").alias("_a"), at("r1").alias("_z"))
    out = out.select(*keys, "p", (F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("_f")).alias("value"))
    return out.drop("_all") if own_key else out


def shared_counts(members: DataFrame, salt_size: int = 256) -> DataFrame:
    """All item pairs ``item_a < item_b`` with the number of groups they share.

    The pairs are the result itself; large groups are salted so no task owns one of them.
    """
    sized = with_key_count(members.select("grp", "item").dropDuplicates(), ["grp"], "_n").withColumn("_s", F.ceil(F.col("_n") / salt_size).cast("int"))
    left = sized.select("grp", F.col("item").alias("item_a"), F.pmod(F.xxhash64("item"), "_s").cast("int").alias("salt"))
    right = sized.select("grp", F.col("item").alias("item_b"), F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("salt"))
    pairs = left.join(right, ["grp", "salt"]).where("item_a < item_b")
    return pairs.groupBy("item_a", "item_b").agg(F.count("*").alias("shared"))


#: Groups of an item beyond which its partners are counted in several tasks, listed partners that a task counts at once and in all.
ITEM_GROUPS, COUNTED, TASK_PAIRS = 100_000, 2_000_000, 16_000_000

#: Most groups that are weighed as hot ones.
MOST_HOT = 65_536


@dataclass
class Listing:
    """How the pairs of the groups that are not hot are listed.

    ``numbers``: item, its number ``i`` along the order that breaks ties of ``shared``, its number of groups ``n``, and whether ``whole``
    lists are wanted. ``split``: partners from this number on are a list of their own.
    """

    numbers: DataFrame
    k: int
    upper: bool
    salt_size: int
    split: int = 0


def _shared_light(light: DataFrame, how: Listing) -> DataFrame:
    """(i, j, shared) of items by number over the groups that are not hot: the partners j that may be among the ``k`` best of i.

    Every item gets the packed members of its groups (4 bytes a partner), counts them in its task and lets only those go that fewer than
    ``k`` partners beat in both overlap and order. So no pair is shuffled as a row. Groups are cut into chunks of about ``salt_size`` members; an
    item of very many groups is counted in several tasks, whose sums are added before the cut.
    """
    sized = with_key_count(light, ["grp"], "_n")
    salt = F.pmod(F.xxhash64("item"), F.ceil(F.col("_n") / how.salt_size)).cast("int").alias("salt")
    named = sized.join(how.numbers, "item").select("grp", salt, F.struct("item", "i", "n", "whole").alias("x"))
    chunks = written(named.groupBy("grp", "salt").agg(F.collect_list("x").alias("x")), "chunks")
    listed = chunks.groupBy("grp").agg(F.sum(F.size("x")).cast("double").alias("n")).agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0.0
    parts = max(int(light.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(listed // TASK_PAIRS) + 1)
    there = chunks.select("grp", F.col("x").alias("y") if how.upper else F.transform("x", lambda y: y.i).alias("y"))
    met = chunks.select("grp", "x").join(there, "grp").select("grp", F.explode("x").alias("x"), "y")
    others = F.transform(F.filter("y", lambda y: y["item"] > F.col("x.item")), lambda y: y.i) if how.upper else F.col("y")
    cut = F.pmod(F.xxhash64("grp"), F.ceil(F.col("x.n") / ITEM_GROUPS)).cast("int").alias("cut")
    met = met.select(F.col("x.i").alias("i"), cut, (F.col("x.whole") | (F.col("x.n") > ITEM_GROUPS)).alias("whole"), others.alias("j"))
    streamed = met.repartition(parts, "i", "cut").sortWithinPartitions("i", "cut")
    k, split = how.k, how.split

    def run(batches):
        yield from _counted(batches, lambda i, j, shared: may_be_best(i, j, shared, k, split))

    found = streamed.mapInArrow(run, "i int, j int, shared bigint")
    if how.numbers.where(F.col("n") > ITEM_GROUPS).isEmpty():
        return found
    return found.groupBy("i", "j").agg(F.sum("shared").alias("shared"))


def _counted(batches, best):
    """Batches of (i, j, shared) from batches of (i, cut, whole, list of j) in order of i and cut; ``best`` marks the rows that go on."""
    held, rows, size = None, [], 0

    def counted(last: bool):
        nonlocal held, rows, size
        i, cut, whole, lens, flat = (np.concatenate(x) for x in zip(*rows))
        new = np.append(True, (i[1:] != i[:-1]) | (cut[1:] != cut[:-1]))
        first = np.flatnonzero(new)  # the lists of one item, and of one cut of it, are a group
        if held and held[0] != (i[0], cut[0]):
            raise ValueError("the rows are not in order")
        keys, shared = np.unique(np.repeat(np.cumsum(new) - 1, lens) << 31 | flat, return_counts=True)
        if held:
            keys, at = np.unique(np.append(held[1], keys), return_inverse=True)
            shared = np.bincount(at, np.append(held[2], shared), len(keys)).astype(np.int64)
        group, j = keys >> 31, keys & 0x7FFFFFFF
        done = np.ones(len(keys), bool) if last else group < len(first) - 1
        held = None if last else ((i[-1], cut[-1]), j[~done], shared[~done])
        tail = None if last else tuple(x[-1:] for x in (i, cut, whole)) + (np.zeros(1, np.int64), np.empty(0, np.int64))
        rows, size = ([] if last else [tail]), 0
        i, j, shared, whole = i[first][group[done]], j[done], shared[done], whole[first][group[done]]
        go = whole | best(i, j, shared)
        return pa.RecordBatch.from_arrays([pa.array(i[go].astype(np.int32)), pa.array(j[go].astype(np.int32)), pa.array(shared[go])], names=["i", "j", "shared"])

    for batch in batches:
        i, cut, whole, lists = (batch.column(n) for n in ("i", "cut", "whole", "j"))
        i, cut, whole = i.to_numpy(), cut.to_numpy(), whole.to_numpy(zero_copy_only=False)
        lens, flat = np.diff(lists.offsets.to_numpy()).astype(np.int64), lists.flatten().to_numpy().astype(np.int64)
        other = flat != np.repeat(i, lens)
        lens = np.bincount(np.repeat(np.arange(len(i)), lens)[other], minlength=len(i))
        if len(i):
            rows.append((i, cut, whole, lens, flat[other]))
            size += len(flat)
        if size >= COUNTED:
            yield counted(False)
    if rows:
        yield counted(True)


#: Values of the overlap that are told apart where a task leaves out partners.
LEVELS = 24


def may_be_best(i: np.ndarray, j: np.ndarray, shared: np.ndarray, k: int, split: int = 0) -> np.ndarray:
    """Which rows, in order of i and j, may be among the best ``k`` of their i: fewer than ``k`` smaller j have as much in common.

    Partners from ``split`` on are a list of their own. Beyond ``LEVELS`` values of ``shared`` neighbouring ones count as one, which keeps some rows more.
    """
    keep = np.zeros(len(i), bool)
    if not len(i):
        return keep
    big = j >= split
    new = np.append(True, (i[1:] != i[:-1]) | (big[1:] != big[:-1]))
    first, group = np.flatnonzero(new), np.cumsum(new) - 1
    values = np.unique(shared)
    for level in np.array_split(values, LEVELS) if len(values) > LEVELS else values[:, None]:
        sure = shared >= level[-1]
        ahead = np.cumsum(sure) - sure
        keep |= (shared >= level[0]) & (shared <= level[-1]) & (ahead - ahead[first][group] < k)
    return keep


#: Pairs of a class, an item and a bit that are compared in the time of listing one pair.
DENSE = 500


def _hot_groups(members: DataFrame, hot_size: int) -> DataFrame:
    """Groups of more than ``hot_size`` members, the largest first as long as comparing bit sets is less work than listing their pairs.

    Bit sets take classes times items times groups; with very many groups, hardly larger than ``hot_size``, the later ones are listed.
    """
    sizes = members.groupBy("grp").agg(F.count("*").alias("_n")).where((F.col("_n") > hot_size) & F.col("grp").isNotNull())
    largest = [r[0] for r in sizes.orderBy(F.desc("_n")).limit(MOST_HOT).select("_n").collect()]
    if not largest:
        return sizes.select("grp")
    n = np.array(largest, dtype=float)
    items = float(members.agg(F.approx_count_distinct("item")).first()[0])
    dense, listed = np.minimum(np.cumsum(n), items) ** 2 * np.arange(1, len(n) + 1), np.cumsum(n * n)
    good = np.flatnonzero(dense <= DENSE * listed)
    most = int(good[-1]) + 1 if len(good) else 1
    return (sizes if most == len(n) < MOST_HOT else sizes.orderBy(F.desc("_n"), "grp").limit(most)).select("grp")


def cooccurrence_candidates(
    members: DataFrame,
    k: int,
    tie: str = "size",
    hot_size: int = 2000,
    salt_size: int = 256,
    upper: bool = False,
    split_at: int | None = None,
) -> DataFrame:
    """Directed candidates ``(item_a, item_b, shared, n_a, n_b)`` that hold every item's exact top ``k``.

    With ``upper`` only partners ``item_b > item_a`` count (ids must be whole numbers). ``split_at`` lets the
    score use another formula for ``n_b < split_at``: the promise then holds for either side on its own.

    Holds for every score that never falls with ``shared`` and never rises with ``n_b``
    (ties by item id). ``members`` has columns ``grp, item``. ``tie='id'`` is for scores that ignore ``n_b``.

    Groups beyond ``hot_size`` members are hot as long as that is less work than listing their pairs (``_hot_groups``); no hot group is
    expanded into pairs. Items of the same hot groups form a
    class; a class's hot groups are a bit set, and the overlap of two items in hot groups is that of their classes. Pairs that
    meet in hot groups only are found class against item, in blocks of bit sets (``_hot_pairs``), and all items of a class share the best
    partners found. Pairs that meet in a light group get the overlap of their classes added.
    """
    members = written(members.select("grp", "item").dropDuplicates(), "members")
    hot = _hot_groups(members, hot_size)
    hot = written(dense_ids(hot, "grp", "bit").select("grp", (F.col("bit") - 1).cast("int").alias("bit")), "hot-groups")
    bits = hot.count()
    counts = members.where("item is not null").groupBy("item").agg(F.count("*").alias("n"))
    light = members.join(hot, "grp", "left_anti") if bits else members
    # numbers along the order that breaks ties of the overlap: a partner loses to an earlier one with as much in common
    late = F.lit(0) if split_at is None else (F.col("n") >= split_at).cast("int")
    numbers = numbered(counts, [late, *([F.col("n")] if tie == "size" else []), F.col("item")], "i")
    numbers = numbers.select("item", F.col("i").cast("int").alias("i"), "n")
    if bits:  # items in hot groups get their overlap there added, so all their partners are wanted
        inside = members.join(hot, "grp").select("item").distinct().withColumn("whole", F.lit(True))
        numbers = numbers.join(inside, "item", "left").withColumn("whole", F.coalesce("whole", F.lit(False)))
    else:
        numbers = numbers.withColumn("whole", F.lit(False))
    numbers = written(numbers, "numbers")
    split = 0 if split_at is None else numbers.where(F.col("n") < split_at).count() + 1
    pairs = _shared_light(light, Listing(numbers, k, upper, salt_size, split))
    for x, i in (("a", "i"), ("b", "j")):
        pairs = pairs.join(numbers.select(F.col("i").alias(i), F.col("item").alias(f"item_{x}"), F.col("n").alias(f"n_{x}")), i).drop(i)
    if not bits:
        return pairs.select("item_a", "item_b", "shared", "n_a", "n_b")
    sets = members.join(hot, "grp").groupBy("item").agg(F.array_sort(F.collect_list("bit")).alias("bits"))
    sets = counts.join(sets, "item", "left").withColumn("bits", F.coalesce("bits", F.array().cast("array<int>")))
    classes = written(dense_ids(sets.where(F.size("bits") > 0).select("bits").dropDuplicates(), "bits", "cls"), "classes").select("cls", "bits")
    stats = written(sets.join(classes, "bits", "left").select("item", "n", "bits", "cls"), "item-sets")
    a, b = (stats.toDF(f"item_{x}", f"n_{x}", f"bits_{x}", f"cls_{x}") for x in "ab")
    met = F.col("shared") + F.size(F.array_intersect("bits_a", "bits_b"))
    out = pairs.select("item_a", "item_b", "shared").join(a, "item_a").join(b, "item_b").select("item_a", "item_b", met.alias("shared"), "n_a", "n_b")
    sides = b.where(F.col("cls_b").isNotNull()).withColumn("big", F.lit(True) if split_at is None else F.col("n_b") >= split_at)
    order = [F.col("n_b"), F.col("item_b")] if tie == "size" else [F.col("item_b")]
    levels = F.sequence(F.lit(0), F.lit(int(stats.agg(F.max("item")).first()[0] or 0).bit_length())) if upper else F.array(F.lit(0))
    # The ids above an id fall into one aligned block for each zero bit of it, the odd ones; without ``upper`` there is one block.
    block = F.expr("shiftright(item_b, lvl)") if upper else F.lit(1)
    sides = sides.withColumn("lvl", F.explode(levels)).withColumn("blk", block).where("blk % 2 = 1")
    best = _first(sides, ["cls_b", "big", "lvl", "blk"], order, k + 1).select("item_b", "n_b", F.col("bits_b").alias("bits"), "big", "lvl", "blk")
    found = _hot_pairs(classes, best, bits, k + 1, tie)
    ranked = _first(found, ["cls", "shared", "big", "lvl", "blk"], order, k + 1)
    asks = a.where(F.col("cls_a").isNotNull()).select("item_a", "n_a", F.col("cls_a").alias("cls"))
    if upper:
        asks = asks.withColumn("lvl", F.explode(levels)).withColumn("blk", F.expr("shiftright(item_a, lvl)")).where("blk % 2 = 0").withColumn("blk", F.col("blk") + 1)
    keys = ["cls", "lvl", "blk"] if upper else ["cls"]
    hot_rows = asks.join(ranked if upper else ranked.drop("lvl", "blk"), keys).where("item_a <> item_b").select("item_a", "item_b", "shared", "n_a", "n_b")
    return out.unionByName(hot_rows).groupBy("item_a", "item_b").agg(
        F.max("shared").alias("shared"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b")
    )


def _first(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= k).drop("_r")


#: Classes and items of a block, bits compared in one round.
BLOCK_CLASSES, BLOCK_ITEMS, ROUND_BITS = 1024, 2048, 4096


def _set_rows(lists, lo: int, hi: int) -> np.ndarray:
    """0/1 rows of the bits ``lo``..``hi`` of sparse sets."""
    out = np.zeros((len(lists), hi - lo), dtype=np.float32)
    sizes = [len(x) for x in lists]
    rows, bits = np.repeat(np.arange(len(lists)), sizes), np.concatenate([np.asarray(x) for x in lists])
    inside = (bits >= lo) & (bits < hi)
    out[rows[inside], bits[inside] - lo] = 1
    return out


def overlaps(left, right, bits: int) -> np.ndarray:
    """Common bits of every two sets of two blocks, summed over rounds of ``ROUND_BITS``."""
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    for lo in range(0, bits, ROUND_BITS):
        hi = min(bits, lo + ROUND_BITS)
        total += _set_rows(left, lo, hi) @ _set_rows(right, lo, hi).T
    return total.astype(np.int32)


def skyband(shared: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Which columns, best first inside each group of columns that begins at ``starts``, have fewer than ``k`` columns before them in their group with as much or more in common."""
    keep = np.zeros(shared.shape, dtype=bool)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, shared.shape[1])))
    for value in np.unique(shared[shared > 0]):
        ahead = np.cumsum(shared >= value, axis=1, dtype=np.int32)
        before = np.where(starts > 0, ahead[:, starts - 1], 0)
        keep |= (shared == value) & (ahead - before[:, group] <= k)
    return keep


def _hot_pairs(classes: DataFrame, items: DataFrame, bits: int, k: int, tie: str) -> DataFrame:
    """(cls, item_b, n_b, big, lvl, blk, shared): for every class the items with common bits that may be among its ``k`` best of their (big, lvl, blk).

    A block of classes stands in its task once, blocks of items stream by. An item leaves the task only if fewer than ``k`` items of
    the block are at least as good in both overlap and order.
    """
    n = max(1, -(-classes.count() // BLOCK_CLASSES))
    part = F.pmod(F.col("cls"), F.lit(n)).cast("int")
    left = classes.groupBy(part.alias("part")).agg(F.collect_list(F.struct("cls", "bits")).alias("classes"))
    m = max(1, -(-items.count() // BLOCK_ITEMS))
    right = items.groupBy(F.pmod(F.xxhash64("lvl", "blk", "item_b"), F.lit(m)).alias("_m")).agg(F.collect_list(F.struct(*items.columns)).alias("items")).drop("_m")
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("kind", F.col("items").isNotNull().cast("int"))
    streamed = both.repartition(n, "part").sortWithinPartitions("part", "kind")

    def run(batches):
        classes = None
        for pdf in batches:
            for kind, rows, other in zip(pdf["kind"], pdf["classes"], pdf["items"]):
                if kind == 0:
                    classes = [r["bits"] for r in rows], np.array([r["cls"] for r in rows])
                    continue
                group = lambda r: (r["big"], r["lvl"], r["blk"])
                other = sorted(other, key=lambda r: (*group(r), *((r["n_b"],) if tie == "size" else ()), r["item_b"]))
                starts = np.array([i for i, r in enumerate(other) if not i or group(r) != group(other[i - 1])])
                shared = overlaps(classes[0], [r["bits"] for r in other], bits)
                i, j = np.nonzero(skyband(shared, starts, k))
                if len(i):
                    found = pd.DataFrame.from_records(other, columns=["item_b", "n_b", "big", "lvl", "blk"]).iloc[j]
                    yield found.assign(cls=classes[1][i], shared=shared[i, j].astype(np.int64))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema if f.name != "bits")
    return streamed.select("kind", "classes", "items").mapInPandas(run, f"{kinds}, cls bigint, shared bigint")
