"""Language identification by prediction by partial matching (PPM).

One byte context tree per language, over all 256 bytes (A-Z lower-cased), up to ``ORDER`` preceding bytes. A byte unseen in a context
costs an escape (method C: as many escapes as different bytes seen) and is then coded by the next shorter context, bytes already
ruled out left aside. The statistics are frozen after training, so the code length of a byte after its context never changes; a
text's length under a language is the sum over all of its bytes, and the shortest code wins.

A tree stores only what was met: the code length of each byte seen in a context, and one number for the escape of each context.
Excluding the seen bytes scales the shorter context by a constant, so an escape is an addend and nothing is stored for unseen bytes.

Training reads a bounded sample: at most ``DOCS`` whole documents of each language, smallest hashes of id and text first; every language
that has a document is learned. Spark counts the contexts; the driver receives the counts of the trees' nodes only, at most those of
``DOCS`` documents a language.

Defined cases: null text, empty text and text without a letter get ``und`` and score 0; without training rows every
document does; ties go to the first language by name; repeated rows get equal results, and rows that share id, language and text
are one training document that counts as often as it occurs; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidewell.llm.common import _FOLD, saved, text_slices

ORDER, DOCS = 3, 300
#: Contexts seen less often in the sample are left to shorter ones.
LEAST = 3


@dataclass(frozen=True)
class Level:
    """The contexts of one length: sorted codes of (context, byte) and of contexts, with the bits of the byte and of the escape."""

    grams: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


@dataclass(frozen=True)
class LanguageModel:
    names: tuple[str, ...]
    trees: tuple[tuple[Level, ...], ...]  # by language, shortest contexts first


def _last(codes: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes of each code."""
    return codes & np.uint32((1 << 8 * n) - 1)


def grams_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code of each byte and the ``ORDER`` ones before it, blanks ahead of each document."""
    place = np.arange(len(data)) + ORDER * np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
    padded = np.full(len(data) + ORDER * (len(offsets) - 1), 32, dtype=np.uint32)
    padded[place] = _FOLD[data]
    codes = np.zeros(len(padded), dtype=np.uint32)
    for back in range(ORDER, -1, -1):
        codes[ORDER:] = codes[ORDER:] << np.uint32(8) | padded[ORDER - back : len(padded) - back]
    return codes[place]


def fit(docs: DataFrame, docs_per_language: int = DOCS) -> LanguageModel:
    """Model from the rows of ``docs`` (doc_id, text, lang) that have a language and a text."""
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang", "text")
    key = ["lang", "doc_id", "mark"]
    marked = usable.withColumn("mark", F.xxhash64("text", F.lit(1)))
    # written apart, so that its size is known and no row is dealt by language to meet it
    sizes = saved(marked.groupBy("lang").agg(F.approx_count_distinct(F.struct("doc_id", "mark")).alias("n")), "sizes")
    # a few times the documents wanted pass the first test, so no language is ranked as a whole in one task
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "mark"), F.lit(1 << 40)) / float(1 << 40)
    few = marked.drop("text").join(sizes, "lang").withColumn("place", place).where(F.col("place") * F.col("n") < 4 * docs_per_language + 40)
    few = few.groupBy(*key, "place").agg(F.count(F.lit(1)).alias("times"))
    chosen = few.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "mark"))).where(F.col("r") <= docs_per_language)
    chosen = saved(chosen.select(*key, "times"), "chosen")
    sample = marked.join(chosen, key).groupBy(*key, "times").agg(F.min("text").alias("text"))
    sample = saved(sample.select("lang", "text", "times"), "sample")

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, times = batch.column(0), batch.column(2).to_numpy()
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                codes = grams_of(data, offsets)
                for i in range(hi - lo):
                    code, n = np.unique(codes[offsets[i] : offsets[i + 1]], return_counts=True)
                    lang = pa.array([langs[lo + i].as_py()] * len(code), pa.string())
                    yield pa.RecordBatch.from_arrays([lang, pa.array(code.astype(np.int64)), pa.array(n * times[lo + i])], names=["lang", "code", "n"])

    counts = sample.mapInArrow(count_grams, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    parts = dict(sorted((lang, _tree(part["code"].to_numpy().astype(np.uint32), part["n"].to_numpy())) for lang, part in counts.groupby("lang")))
    return LanguageModel(tuple(parts), tuple(parts.values()))


def _tree(codes: np.ndarray, n: np.ndarray) -> tuple[Level, ...]:
    """Tree of one language, from the different codes of its sample and their counts."""
    levels, shorter, chance = [], np.zeros(0, np.uint32), np.zeros(0)
    for order in range(ORDER + 1):
        grams, at = np.unique(_last(codes, order + 1), return_inverse=True)
        count = np.bincount(at, weights=n)
        contexts, row = np.unique(grams >> np.uint32(8), return_inverse=True)
        often = np.bincount(row, weights=count) >= LEAST
        if not often.any():
            break
        keep = often[row]
        grams, count, row, contexts = grams[keep], count[keep], (np.cumsum(often) - 1)[row[keep]], contexts[often]
        total, kinds = np.bincount(row, weights=count), np.bincount(row)
        # what follows a context follows its shorter end too, at least as often
        lower = chance[np.searchsorted(shorter, _last(grams, order))] if order else np.full(len(grams), 1 / 256)
        full = kinds == 256  # nothing to escape to
        rest = np.where(full, 1.0, 1 - np.bincount(row, weights=lower))
        shorter, chance = grams, count / np.where(full, total, total + kinds)[row]
        escapes = -np.log2(kinds / (total + kinds) / rest)
        levels.append(Level(grams, -np.log2(chance).astype(np.float32), contexts, escapes.astype(np.float32)))
    return tuple(levels)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys``, and whether they are there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def gram_bits(tree: tuple[Level, ...], codes: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each code after the bytes before it."""
    out, open_ = np.zeros(len(codes)), np.arange(len(codes))
    for order in range(len(tree) - 1, -1, -1):
        level, wanted = tree[order], _last(codes[open_], order + 1)
        at, seen = _find(level.grams, wanted)
        out[open_[seen]] += level.bits[at[seen]]
        open_, wanted = open_[~seen], wanted[~seen]
        at, known = _find(level.contexts, wanted >> np.uint32(8))
        out[open_[known]] += level.escapes[at[known]]
    out[open_] += 8
    return out


def code_lengths(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Document x language: bits of the whole text."""
    codes, at = np.unique(grams_of(data, offsets), return_inverse=True)
    out = np.zeros((len(offsets) - 1, len(model.names)))
    for k, tree in enumerate(model.trees):
        cost = np.zeros(len(data) + 1)
        np.cumsum(gram_bits(tree, codes)[at], out=cost[1:])
        out[:, k] = cost[offsets[1:]] - cost[offsets[:-1]]
    return out


_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def predict(docs: DataFrame, model: LanguageModel, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """Id columns, lang_pred, score (share of the winner when all languages are equally likely before)."""
    thin = docs.select(*id_cols, text_col)
    k = len(id_cols)
    schema = StructType([*thin.schema.fields[:k], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    names = np.array(["und", *model.names], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows)
            for lo, hi, data, offsets in text_slices(batch.column(k)) if model.names else ():
                bits = code_lengths(model, data, offsets)
                letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
                known = letters[offsets[1:]] > letters[offsets[:-1]]
                for i in np.flatnonzero(~known & (np.diff(offsets) > 0)):
                    known[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
                low = bits.min(axis=1, keepdims=True)
                best[lo:hi] = np.where(known, bits.argmin(axis=1) + 1, 0)
                score[lo:hi] = np.where(known, 1 / np.exp2(np.maximum(low - bits, -1000.0)).sum(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], pa.array(names[best], pa.string()), pa.array(score)], names=[f.name for f in schema.fields])

    return thin.mapInArrow(run, schema)
