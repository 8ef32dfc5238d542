"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

A window is one word with its separators. It is compressed twice, once behind each dictionary, after a fixed carrier
that both dictionaries hold: the carrier costs the same in both and keeps zstandard from storing short windows raw. The
margin of a window is the length with the ordinary dictionary less the length with the toxic one. A document's
evidence is its largest margin; a threshold calibrated on labelled documents outside the dictionaries maps it to 0..1.

Fitting reads a bounded sample of labelled rows: at most ``toxic_docs`` and ``ordinary_docs`` documents, smallest id hashes
first. Spark counts the words of the sample; the driver receives at most ``MAX_WORDS`` counted words of each class. A word enters the toxic
text if it is in many toxic documents, after different words (so repeated passages don't count), and rare elsewhere. With too few rows to tell, no word enters.

Defined cases: null or empty text and text without words have margin 0; without labels of both classes every score is
0; of several labels of a document the largest counts; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidewell.llm.common import _FOLD, _WORD, byte_hash, saved, text_slices, word_spans

#: Around each window. zstandard starts no match in a block's last eight bytes, so a tail keeps short words off them.
CARRIER, TAIL = bytes(range(0x80, 0xB0)), bytes(range(0xB0, 0xBA))
MAX_WORDS, MAX_WORD_BYTES = 80_000, 256
#: Bytes of the dictionaries, windows remembered by a task.
ORDINARY_BYTES, TOXIC_BYTES, REMEMBERED = 112_640, 16_384, 400_000
#: A search that indexes every position of a dictionary: faster ones skip positions and miss short words.
SEARCH = dict(strategy=zstandard.STRATEGY_BTOPT, window_log=18, hash_log=17, chain_log=18, search_log=5, min_match=4, target_length=32)
#: A word of the toxic text: least toxic documents, least share of different preceding words, least ratio of rates, and
#: least toxic documents times log ratio (chance alone brings a word of the sample that far about once in e^20).
MIN_DOCS, MIN_CONTEXTS, MIN_RATIO, MIN_EVIDENCE = 3, 0.3, 10.0, 20.0
WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    threshold: float

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        def one(content: bytes) -> zstandard.ZstdCompressor:
            params = zstandard.ZstdCompressionParameters(**SEARCH, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params)

        return one(self.ordinary), one(self.toxic)


def _lengths(compressor: zstandard.ZstdCompressor, windows: list[bytes]) -> np.ndarray:
    sizes = np.fromiter(map(len, windows), dtype=np.uint64, count=len(windows))
    segments = np.stack([np.cumsum(sizes) - sizes, sizes], axis=1)
    out = compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(b"".join(windows), segments.tobytes()), threads=0)
    return np.fromiter((len(out[i]) for i in range(len(windows))), dtype=np.int32, count=len(windows))


def measure(model: ToxicityModel):
    """Function of a text column: margin and hits (windows beyond the threshold) of each row.

    The compressors and the windows met so far stay with the function: make it once a task.
    """
    pair = model.compressors()
    known: dict[int, int] = {}

    def of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        margin, hits = np.zeros(len(column)), np.zeros(len(column), dtype=np.int64)
        for lo, _, data, offsets in text_slices(column):
            data = _FOLD[data]
            starts, ends, first = word_spans(_WORD[data], offsets)
            if not len(starts):
                continue
            keys, at, inverse = np.unique(byte_hash(data).of(starts, ends), return_index=True, return_inverse=True)
            found = [known.get(k) for k in keys.tolist()]
            new = [i for i, v in enumerate(found) if v is None]
            if new:
                raw = data.tobytes()
                s, e = starts[at[new]].tolist(), ends[at[new]].tolist()
                windows = [CARRIER + b" " + raw[i:j] + b" " + TAIL for i, j in zip(s, e)]
                diff = (_lengths(pair[0], windows) - _lengths(pair[1], windows)).tolist()
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                for i, v in zip(new, diff):
                    found[i] = known[int(keys[i])] = v
            per_word = np.asarray(found, dtype=np.int32)[inverse]
            full = np.flatnonzero(np.diff(first) > 0)
            margin[lo + full] = np.maximum.reduceat(per_word, first[full])
            hits[lo + full] = np.add.reduceat((per_word > model.threshold).astype(np.int64), first[full])
        return margin, hits

    return of


def margins(docs: DataFrame, model: ToxicityModel, id_cols: list[str], text_col: str = "text") -> DataFrame:
    thin = docs.select(*id_cols, text_col)
    schema = StructType([*thin.schema.fields[:-1], StructField("margin", DoubleType()), StructField("hits", LongType())])
    k = len(id_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = measure(model)
        for batch in batches:
            margin, hits = of(batch.column(k))
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], pa.array(margin), pa.array(hits)], names=[*batch.schema.names[:k], "margin", "hits"])

    return thin.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, toxic_docs: int = 2000, ordinary_docs: int = 6000) -> ToxicityModel:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); rows without either label are left out."""
    labelled = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [labelled.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(n) for c, n in ((1, toxic_docs), (0, ordinary_docs))]
    chosen = saved(chosen[0].unionByName(chosen[1]).withColumn("check", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)), F.lit(4)) == 0), "labelled")
    # at most toxic_docs + ordinary_docs rows of 13 bytes
    sample = saved(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id"), "sample")
    words = F.filter(F.split(F.lower("text"), WORDS), lambda w: (w != "") & (F.octet_length(w) <= MAX_WORD_BYTES))
    pairs = F.explode(F.arrays_zip(words.alias("word"), F.concat(F.array(F.lit("")), words).alias("before")))
    placed = sample.where("not check").select("doc_id", "toxic", pairs.alias("p")).select("doc_id", "toxic", "p.*").where("word IS NOT NULL")
    by_doc = placed.groupBy("word", "toxic").agg(F.count_distinct("doc_id").alias("docs"), F.count_distinct("before").alias("contexts"))
    by_word = by_doc.groupBy("word").agg(*[F.coalesce(F.max(F.when(F.col("toxic") == c, F.col(x))), F.lit(0)).alias(f"{x}{c}") for c in (0, 1) for x in ("docs", "contexts")])
    totals = {r["toxic"]: r["n"] for r in sample.where("not check").groupBy("toxic").agg(F.count_distinct("doc_id").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return ToxicityModel(b"", b"", float("inf"))
    by_word = saved(by_word, "words")
    ratio = ((F.col("docs1") + 0.5) / (totals[1] + 1)) / ((F.col("docs0") + 0.5) / (totals[0] + 1))
    varied = F.col("contexts1") >= F.greatest(F.lit(2), F.lit(MIN_CONTEXTS) * F.col("docs1"))
    toxic = by_word.where((F.col("docs1") >= MIN_DOCS) & (ratio >= MIN_RATIO) & varied & (F.col("docs1") * F.log(ratio) >= MIN_EVIDENCE))
    toxic = toxic.orderBy(F.desc("docs1"), "word").limit(MAX_WORDS).select("word", F.col("docs1").alias("n")).collect()
    ordinary = by_word.where("docs0 >= 2").orderBy(F.desc("docs0"), "word").limit(MAX_WORDS).select("word", F.col("docs0").alias("n")).collect()
    model = ToxicityModel(_dictionary(ordinary, ORDINARY_BYTES, 50, 48), _dictionary(toxic, TOXIC_BYTES, 20, 32), 0.0)
    seen = margins(sample.where("check"), model, ["toxic"]).groupBy("toxic", "margin").count().collect()
    return ToxicityModel(model.ordinary, model.toxic, _threshold([(r["margin"], r["toxic"], r["count"]) for r in seen]))


def _dictionary(words: list, size: int, most: int, segment: int) -> bytes:
    """A zstandard dictionary trained on words, each as often as its documents up to ``most``, in an order without meaning.

    Text that fits the dictionary whole needs no training: training only selects what to keep.
    """
    whole = b" " + b" ".join(r["word"].encode() for r in reversed(words)) + b" "
    if len(whole) <= size:
        return whole
    samples = [b" " + r["word"].encode() + b" " for r in words for _ in range(min(r["n"], most))]
    samples = [samples[i] for i in np.random.default_rng(7).permutation(len(samples))]
    return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()


def _threshold(seen: list[tuple[float, int, int]]) -> float:
    """The margin that parts the classes best (largest difference of hit rates), halfway to the next margin below."""
    total = [max(1, sum(n for _, t, n in seen if t == c)) for c in (0, 1)]
    levels = sorted({m for m, _, _ in seen})
    best, at = -1.0, float(levels[-1]) + 1 if levels else 1.0
    for below, m in zip([levels[0] - 1, *levels], levels):
        rates = [sum(n for x, t, n in seen if t == c and x >= m) / total[c] for c in (0, 1)]
        if rates[1] - 3 * rates[0] > best:
            best, at = rates[1] - 3 * rates[0], (m + below) / 2
    return max(at, 0.5)


def score(docs: DataFrame, model: ToxicityModel, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """Id columns, margin, hits and score; score >= 0.5 exactly where the margin passes the threshold."""
    if model.threshold == float("inf"):
        return docs.select(*id_cols, F.lit(0.0).alias("margin"), F.lit(0).cast("long").alias("hits"), F.lit(0.0).alias("score"))
    over = F.col("margin") - F.lit(model.threshold)
    more = F.when(over >= 0, F.log1p(F.col("hits").cast("double")) / 4).otherwise(0.0)
    return margins(docs, model, id_cols, text_col).withColumn("score", 1 / (1 + F.exp(-(over + more))))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; columns as they are."""
    if model.threshold == float("inf"):
        return docs
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = measure(model)
        for batch in batches:
            yield batch.filter(pa.array(of(batch.column(at))[0] < model.threshold))

    return docs.mapInArrow(run, docs.schema)
