"""Exact dedup by two passes of a Bloom filter; DataFrame functions only.

Pass one adds every text's hash to a counting Bloom filter: grouped slot counters, summed in the map tasks first. Slots
hit twice or more remain, packed 64 to a word. Pass two looks both slots of each row up in these words: a row with a
slot hit once only has no equal, and passes straight through. Only the other rows are shuffled, as digests.

The words are broadcast while they stay under ``MAX_WORDS`` rows; beyond it they meet slots and digests in a shuffle join,
and texts stay where they are. To drop rows there, the digests found twice are folded into a filter of ``FOLDED_BITS``,
which can be broadcast whatever the input's size and names the rows that move. A false positive costs a shuffled row,
nothing else: the decision is made on the SHA-256 of the whole text.

Defined cases: null text equals empty text; a null doc_id counts as smaller than any other; of rows with one text and
one doc_id exactly one stays; an empty table gives an empty result; extra columns are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.llm.common import free_name, saved

#: Filter bits for each row, least and most filter bits, and most words of repeated slots to broadcast (16 bytes each).
BITS_PER_ROW, MIN_BITS, MAX_BITS, MAX_WORDS = 16, 1 << 16, 1 << 36, 1 << 21

#: Bits of the filter of repeated digests: at most 2 M words. Up to 8 M repeated texts it lets through under 2 % of the other rows.
FOLDED_BITS = 1 << 27


def _slots(text: Column, bits: int) -> list[Column]:
    """Two slots of a text, in separate halves of the filter."""
    half = F.lit(bits // 2)
    return [F.pmod(F.xxhash64(text), half), F.pmod(F.xxhash64(text, F.lit(1)), half) + half]


def filter_bits(rows: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, 1 << (rows * BITS_PER_ROW).bit_length()))


def _words(slots: DataFrame) -> DataFrame:
    """(word, mask): slots packed 64 to a word."""
    return slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS INT))")).alias("mask"))


def repeated_slots(texts: DataFrame, text: str, bits: int) -> DataFrame:
    """Pass one: (word, mask) of the slots that two or more rows hit."""
    slots = texts.select(F.explode(F.array(*_slots(F.col(text), bits))).alias("slot"))
    return _words(slots.groupBy("slot").agg(F.count(F.lit(1)).alias("hits")).where("hits > 1"))


def text_filter(docs: DataFrame, text: Column) -> tuple[DataFrame, int, bool]:
    """(words of pass one, bits of the filter, whether the words can be broadcast)."""
    bits = filter_bits(docs.count())
    words = saved(repeated_slots(docs.select(text.alias("t__")), "t__", bits), "slots")
    small = words.count() <= MAX_WORDS
    return (F.broadcast(words) if small else words), bits, small


def look_up(rows: DataFrame, slots: list[Column], words: DataFrame, flag: str) -> DataFrame:
    """Pass two: ``rows`` with ``flag``, whether both slots are among ``words``. No row moves where the words are broadcast."""
    names = {n: free_name(rows, n) for n in ("s0__", "s1__", "m0__", "m1__", "w__")}
    out = rows.withColumns({names["s0__"]: slots[0], names["s1__"]: slots[1]})
    for s, m in (("s0__", "m0__"), ("s1__", "m1__")):
        right = words.select(F.col("word").alias(names["w__"]), F.col("mask").alias(names[m]))
        out = out.join(right, F.shiftright(names[s], 6) == F.col(names["w__"]), "left").drop(names["w__"])

    def hit(s: str, m: str) -> Column:
        return F.expr(f"coalesce(shiftrightunsigned(`{names[m]}`, cast(`{names[s]}` & 63 AS INT)) & 1 = 1, false)")

    return out.withColumn(flag, hit("s0__", "m0__") & hit("s1__", "m1__")).drop(*[names[n] for n in ("s0__", "s1__", "m0__", "m1__")])


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def mark_digests(docs: DataFrame, id_col: str, text: Column, words: DataFrame, bits: int) -> DataFrame:
    """(``doc_id, text_sha256, maybe``): digests and slots are worked out below the join, so it carries no text."""
    slots = _slots(text, bits)
    thin = docs.select(F.col(id_col).alias("doc_id"), _digest(text).alias("text_sha256"), slots[0].alias("s0"), slots[1].alias("s1"))
    return look_up(thin, [F.col("s0"), F.col("s1")], words, "maybe").drop("s0", "s1")


def mark_rows(docs: DataFrame, id_col: str, text: Column, flag: str) -> DataFrame:
    """``docs`` with ``flag``: whether an equal text is possible. No row of ``docs`` moves."""
    words, bits, small = text_filter(docs, text)
    if small:
        return look_up(docs, _slots(text, bits), words, flag)
    found = mark_digests(docs, id_col, text, words, bits).where("maybe").groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    folded = found.select(F.explode(F.array(*_slots(F.col("text_sha256"), FOLDED_BITS))).alias("slot")).distinct()
    return look_up(docs, _slots(_digest(text), FOLDED_BITS), F.broadcast(saved(_words(folded), "repeated")), flag)


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256. Texts themselves are never shuffled."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, bits, _ = text_filter(docs, text)
    marked = saved(mark_digests(docs, id_col, text, words, bits).withColumn("row_no", F.monotonically_increasing_id()), "digests")
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), F.col("row_no").alias("row"))
    groups = marked.where("maybe").groupBy("text_sha256").agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = saved(groups, "copy-groups")  # apart from the join, so that adaptive execution may split a hot group's rows there
    moved = marked.where("maybe").join(groups, "text_sha256").select(
        "doc_id", F.col("best.id").alias("keep_id"), "group_size", (F.col("best.row") == F.col("row_no")).alias("kept"), "text_sha256"
    )
    straight = marked.where("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return straight.unionByName(moved)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row with a larger id has; all columns stay as they are.

    Of a group, every map task passes on one row only, so a group of any size is safe.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    flag, key = free_name(docs, "maybe__"), free_name(docs, "sha__")
    marked = mark_rows(docs, id_col, text, flag)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    order = F.struct(F.col(id_col).isNotNull(), F.col(id_col), F.xxhash64(*plain))
    best = marked.where(F.col(flag)).groupBy(_digest(text).alias(key)).agg(F.max_by(F.struct(*columns), order).alias("row__"))
    return marked.where(~F.col(flag)).select(*columns).unionByName(best.select("row__.*"))
