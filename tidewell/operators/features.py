"""Feature transforms: ``fit(df)`` returns a fitted object, its ``transform(df)`` a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tidewell.functions.scalars import BOOL_MAP, cyclic_date, ngrams
from tidewell.operators.skew import dense_ids, numbered, with_pieces
from tidewell.session import written

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


class Transform:
    """Base of user-written transforms as well: override ``fit`` and ``transform``."""

    def fit(self, df: DataFrame) -> "Transform":
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


class Chain(Transform):
    """Transforms applied one after the other."""

    def __init__(self, *steps: Transform):
        self.steps = steps

    def fit(self, df):
        for s in self.steps:
            df = s.fit(df).transform(df)
        return self

    def transform(self, df):
        return reduce(lambda x, s: s.transform(x), self.steps, df)


class ColumnTransform(Transform):
    """A column function as a stateless transform."""

    def __init__(self, out: str, make: Callable[[], Column]):
        self.out, self.make = out, make

    def transform(self, df):
        return df.withColumn(self.out, self.make())


class FeatureIds(Transform):
    """Ids by value count (most frequent first), from 1 or 0; rare values beyond the limits have none."""

    def __init__(self, col: str, out: str, min_size: int = 0, max_classes: int | None = None, exclude_missing: bool = False, zero_based: bool = False):
        self.col, self.out, self.min_size, self.max_classes = col, out, min_size, max_classes
        self.exclude_missing, self.zero_based = exclude_missing, zero_based
        self.ids: DataFrame | None = None

    def fit(self, df):
        if self.col not in df.columns:
            return self
        counts = df.where(F.col(self.col).isNotNull()).groupBy(self.col).agg(F.count("*").alias("n")).where(F.col("n") >= self.min_size)
        order = [F.desc("n"), F.asc(self.col)]
        if self.max_classes is None:
            top = numbered(counts, order, "_id")
        else:
            top = counts.orderBy(*order).limit(self.max_classes).withColumn("_id", F.row_number().over(W.orderBy(*order)))
        self.ids = top.select(self.col, (F.col("_id") - (1 if self.zero_based else 0)).cast("int").alias(self.out))
        return self

    def transform(self, df):
        if self.ids is None or self.col not in df.columns:
            return df
        out = df.join(self.ids, self.col, "inner" if self.exclude_missing else "left")
        return out.withColumn(self.out, F.coalesce(self.out, F.lit(-1)))


class SvmFeatures(Transform):
    """``array<struct<id, value>>`` sorted by id over numbers, texts, lists and maps. ``key`` names the row id."""

    def __init__(self, key: str, out: str = "svm", included: list[str] | None = None, excluded: list[str] = (), zero_based: bool = False):
        self.key, self.out, self.included, self.zero_based = key, out, included, zero_based
        self.excluded = [key, *excluded]
        self.ids: DataFrame | None = None

    def _cells(self, df: DataFrame) -> Column:
        """All (name, value) features of a row as one array."""
        kind = "array<struct<name:string,value:double>>"
        parts = []
        for f in df.schema.fields:
            c, name = F.col(f"`{f.name}`"), f.name
            if (self.included and name not in self.included) or name in self.excluded:
                continue
            if isinstance(f.dataType, NUMERIC):
                one = F.array(F.struct(F.lit(name).alias("name"), c.cast("double").alias("value")))
                parts.append(F.when(c.isNotNull(), one).otherwise(F.array().cast(kind)))
            elif isinstance(f.dataType, T.ArrayType):
                parts.append(F.coalesce(F.transform(F.array_distinct(c), _listed(name)), F.array().cast(kind)))
            elif isinstance(f.dataType, T.MapType):
                parts.append(F.coalesce(F.transform(F.map_entries(c), _mapped(name)), F.array().cast(kind)))
            else:
                text = c.cast("string")
                number = text.try_cast("double")
                one = F.array(
                    F.struct(
                        F.when(number.isNotNull(), F.lit(name)).otherwise(F.concat(F.lit(name + "_"), text)).alias("name"),
                        F.coalesce(number, F.lit(1.0)).alias("value"),
                    )
                )
                parts.append(F.when(text.isNotNull(), one).otherwise(F.array().cast(kind)))
        return F.concat(*[p.cast(kind) for p in parts])

    def fit(self, df):
        names = df.select(F.explode(self._cells(df)).alias("c")).select("c.name").distinct()
        self.ids = dense_ids(names, "name", "id").withColumn("id", F.col("id") - (1 if self.zero_based else 0))
        return self

    def transform(self, df):
        ids = self.ids.select("name", F.col("id").alias("_id"))
        cells = df.select(F.col(self.key).alias("_key"), F.explode(self._cells(df)).alias("c")).select("_key", "c.name", "c.value")
        pair = F.struct(F.col("_id").alias("id"), "value")
        packed = cells.join(ids, "name").groupBy("_key").agg(F.array_sort(F.collect_list(pair)).alias(self.out))
        none = F.array().cast("array<struct<id:bigint,value:double>>")
        out = df.join(packed, df[self.key] == packed["_key"], "left").drop("_key")
        return out.withColumn(self.out, F.coalesce(self.out, none))


def _listed(name: str) -> Callable[[Column], Column]:
    return lambda v: F.struct(F.concat(F.lit(name + "_"), v.cast("string")).alias("name"), F.lit(1.0).alias("value"))


def _mapped(name: str) -> Callable[[Column], Column]:
    """Numbers keep their value under the key's name, texts become part of the name."""

    def entry(e: Column) -> Column:
        text = e.value.cast("string")
        number = text.try_cast("double")
        label = F.concat(F.lit(name + "_"), e.key)
        full = F.when(number.isNotNull(), label).otherwise(F.concat(label, F.lit("_"), text))
        return F.struct(full.alias("name"), F.coalesce(number, F.lit(1.0)).alias("value"))

    return entry


class Scale(Transform):
    """Columns to mean 0 and population standard deviation 1 (a constant column to 0)."""

    def __init__(self, cols: list[str]):
        self.cols = cols
        self.stats: dict[str, tuple[float, float]] = {}

    def fit(self, df):
        row = df.agg(*[x for c in self.cols for x in (F.avg(c).alias(f"{c}_m"), F.stddev_pop(c).alias(f"{c}_s"))]).first()
        self.stats = {c: (row[f"{c}_m"], row[f"{c}_s"]) for c in self.cols}
        return self

    def transform(self, df):
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s or 1.0) for c, (m, s) in self.stats.items() if m is not None})


class Binarise(Transform):
    """One 0/1 column ``col_i`` per label in label order; two labels share one column.

    A table can't have a column for each of very many labels: more than ``max_labels`` are refused, not cut. ``FeatureIds`` is the sparse
    form for them, one id in one column.
    """

    def __init__(self, col: str, max_labels: int = 1000):
        self.col, self.max_labels = col, max_labels
        self.labels: list = []

    def fit(self, df):
        found = df.select(self.col).where(F.col(self.col).isNotNull()).distinct().orderBy(self.col)
        rows = found.limit(self.max_labels + 1).collect()
        if len(rows) > self.max_labels:
            raise ValueError(f"{self.col} has more than {self.max_labels} labels; FeatureIds gives each one an id")
        self.labels = [r[0] for r in rows]
        return self

    def transform(self, df):
        wanted = self.labels[1:] if len(self.labels) == 2 else self.labels
        flags = {f"{self.col}_{i}": F.when(F.col(self.col) == F.lit(v), 1).otherwise(0) for i, v in enumerate(wanted)}
        return df.withColumns(flags)


class AutoTransform(Transform):
    """Types every column from its statistics and applies the matching treatment.

    Dropped: constant, duplicate and too empty columns. Booleans become 0/1; numbers with more than
    ``max_numeric_values`` distinct values are standardised (missing -> 0, optionally clipped to the fitted range);
    the rest is categorical (missing -> ``missing``, value shares outside ``[min_share, max_share]`` -> null, numbers
    ``col_v``); dates become cyclic features and, on request, scaled pairwise differences.
    One aggregation gives all statistics of a fit; categorical shares stay in a table.
    """

    def __init__(
        self,
        include: list[str] | None = None,
        exclude: list[str] = (),
        max_numeric_values: int = 0,
        date_cols: list[str] = (),
        date_formats: list[str] = (),
        ignore: list | None = None,
        force_categorical: list[str] = (),
        min_share: float = 0.0,
        max_share: float = 1.0,
        bools: dict[str, int] | None = None,
        missing: str = "UKN",
        date_parts=(True, True, True, True),
        date_differences: bool = False,
        null_share: float | None = None,
        drop_constant: bool = True,
        drop_duplicates: bool = True,
        clip: bool = False,
    ):
        self.include, self.exclude, self.max_numeric_values = include, list(exclude), max_numeric_values
        self.date_cols, self.date_formats, self.ignore = list(date_cols), list(date_formats), ignore
        self.force_categorical, self.min_share, self.max_share = list(force_categorical), min_share, max_share
        self.bools, self.missing, self.date_parts = bools or BOOL_MAP, missing, date_parts
        self.date_differences, self.null_share = date_differences, null_share
        self.drop_constant, self.drop_duplicates, self.clip = drop_constant, drop_duplicates, clip
        self.drop: list[str] = []
        self.plan: dict[str, str] = {}
        self.scale: dict[str, tuple[float, float, float, float]] = {}
        self.diff_scale: dict[str, tuple[float, float]] = {}
        self.shares: DataFrame | None = None

    def _clean(self, name: str) -> Column:
        c = F.col(f"`{name}`")
        gone = ["", *[str(v) for v in self.ignore or []]]
        text = c.cast("string")
        number = [float(v) for v in self.ignore or [] if isinstance(v, (int, float))]
        hit = text.isin(gone)
        if number:
            hit = hit | F.coalesce(text.try_cast("double").isin(number), F.lit(False))
        return F.when(~hit, c)

    def fit(self, df):
        names = [c for c in df.columns if c not in self.exclude and (not self.include or c in self.include)]
        aggs = [F.count("*").alias("n")]
        for c in names:
            v = self._clean(c)
            text, number = v.cast("string"), v.cast("string").try_cast("double")
            known = F.lower(text).isin(list(self.bools))
            aggs += [
                F.count(v).alias(f"{c}|count"),
                F.approx_count_distinct(text, 0.01).alias(f"{c}|distinct"),
                F.min(text).alias(f"{c}|low"),
                F.max(text).alias(f"{c}|high"),
                F.count_if(known).alias(f"{c}|bools"),
                F.count(number).alias(f"{c}|numbers"),
                F.avg(number).alias(f"{c}|avg"),
                F.stddev_pop(number).alias(f"{c}|sd"),
                F.min(number).alias(f"{c}|min"),
                F.max(number).alias(f"{c}|max"),
                F.sum(F.xxhash64(F.col(f"`{c}`").cast("string"), F.lit(1)).cast("decimal(38,0)")).alias(f"{c}|hash"),
            ]
        s = df.agg(*aggs).first().asDict()
        n = s["n"]
        self.drop = self._duplicates(df, names, s) if self.drop_duplicates else []
        cats = []
        for c in [x for x in names if x not in self.drop]:
            count = s[f"{c}|count"]
            kind = df.schema[c].dataType
            is_number = isinstance(kind, NUMERIC) or (isinstance(kind, T.StringType) and count > 0 and s[f"{c}|numbers"] == count)
            constant = (count == n and s[f"{c}|low"] == s[f"{c}|high"]) or count == 0
            if self.null_share is not None and n - count > self.null_share * n:
                self.drop.append(c)
            elif constant and self.drop_constant:
                self.drop.append(c)
            elif count == n and s[f"{c}|bools"] == n:
                self.plan[c] = "bool"
            elif isinstance(kind, (T.TimestampType, T.DateType, T.TimestampNTZType)) or c in self.date_cols:
                self.plan[c] = "date"
            elif is_number and c not in self.force_categorical and self._many(df, c, s[f"{c}|distinct"], count < n):
                self.plan[c] = "number"
                self.scale[c] = (s[f"{c}|avg"], s[f"{c}|sd"], s[f"{c}|min"], s[f"{c}|max"])
            else:
                self.plan[c] = "category"
                cats.append(c)
        self._fit_shares(df, cats, n)
        if self.date_differences:
            dates = [c for c, k in self.plan.items() if k == "date"]
            diffs = {f"{a}_{b}": _days(self._date(df, a), self._date(df, b)) for a, b in combinations(dates, 2)}
            if diffs:
                row = df.agg(*[x for k, d in diffs.items() for x in (F.avg(d).alias(f"{k}|m"), F.stddev_pop(d).alias(f"{k}|s"))]).first()
                self.diff_scale = {k: (row[f"{k}|m"], row[f"{k}|s"]) for k in diffs}
        return self

    def _many(self, df: DataFrame, c: str, approx: int, has_null: bool) -> bool:
        """More distinct values (missing counts as one) than the limit; near the limit counted exactly."""
        limit = self.max_numeric_values
        if limit <= 0 or approx > 2 * limit + 10:
            return True
        exact = df.select(self._clean(c).alias("v")).where("v is not null").distinct().limit(limit + 1).count()
        return exact + has_null > limit

    def _duplicates(self, df: DataFrame, names: list[str], s: dict) -> list[str]:
        """Earlier columns equal to a later one of the same type: equal hash sums first, then compared row by row."""
        pairs = [
            (a, b)
            for a, b in combinations(names, 2)
            if df.schema[a].dataType == df.schema[b].dataType and s[f"{a}|hash"] == s[f"{b}|hash"] and s[f"{a}|hash"] is not None
        ]
        if not pairs:
            return []
        row = df.agg(*[F.count_if(~F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`"))).alias(str(i)) for i, (a, b) in enumerate(pairs)]).first()
        return sorted({a for i, (a, _) in enumerate(pairs) if row[str(i)] == 0}, key=names.index)

    def _fit_shares(self, df: DataFrame, cats: list[str], n: int) -> None:
        self.shares = None
        if not cats:
            return
        cells = F.array(*[F.struct(F.lit(c).alias("col"), self._clean(c).cast("string").alias("value")) for c in cats])
        counts = df.select(F.explode(cells).alias("x")).groupBy("x.col", "x.value").agg(F.count("*").alias("k"))
        share = F.col("k") / F.lit(n)
        self.shares = counts.where("value is not null").where((share >= self.min_share) & (share <= self.max_share)).select("col", "value")

    def _date(self, df: DataFrame, c: str) -> Column:
        if isinstance(df.schema[c].dataType, T.StringType):
            return F.coalesce(*[F.try_to_timestamp(self._clean(c), F.lit(f)) for f in ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", *self.date_formats]])
        return F.col(f"`{c}`").cast("timestamp")

    def transform(self, df):
        out: dict[str, Column] = {}
        lookups = []
        for c in [x for x in df.columns if x not in self.drop]:
            kind = self.plan.get(c)
            v = self._clean(c)
            if kind == "bool":
                m = F.lit(None).cast("int")
                for k, b in self.bools.items():
                    m = F.when(F.lower(v.cast("string")) == k, F.lit(b)).otherwise(m)
                out[c] = m
            elif kind == "number":
                avg, sd, lo, hi = self.scale[c]
                x = v.cast("string").try_cast("double")
                x = F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi))) if self.clip else x
                out[c] = F.when(v.cast("string").try_cast("double").isNull(), 0.0).otherwise((x - F.lit(float(avg))) / F.lit(float(sd or 1.0)))
            elif kind == "category":
                out[c] = v.cast("string")
                lookups.append(c)
            elif kind == "date":
                out[c] = self._date(df, c)
            else:
                out[c] = F.col(f"`{c}`")
        res = df.select(*[e.alias(c) for c, e in out.items()])
        for c in lookups:
            known = self.shares.where(F.col("col") == c).select(F.col("value").alias(c), F.lit(1).alias("_known"))
            text = F.lower(F.regexp_replace(F.col(c), " ", "_"))
            shown = F.when(F.col(c).try_cast("double").isNotNull(), F.concat(F.lit(c + "_"), text)).otherwise(text)
            value = F.when(F.col(c).isNull(), F.lit(self.missing)).when(F.col("_known") == 1, shown)
            res = res.join(known, c, "left").withColumn(c, value).drop("_known")
        dates = [c for c, k in self.plan.items() if k == "date"]
        for c in dates:
            res = res.withColumns(cyclic_date(c, c, self.date_parts))
        for a, b in combinations(dates, 2):
            if f"{a}_{b}" in self.diff_scale:
                m, sd = self.diff_scale[f"{a}_{b}"]
                d = (_days(F.col(a), F.col(b)) - F.lit(m or 0.0)) / F.lit(sd or 1.0)
                res = res.withColumn(f"{a}_{b}", F.coalesce(d, F.lit(0.0)))
        order = [c for c in df.columns if c in res.columns]
        return res.select(*order, *[c for c in res.columns if c not in order])


def _days(a: Column, b: Column) -> Column:
    return (F.unix_micros(a) - F.unix_micros(b)) / 86_400_000_000.0


class TfidfFeatures(Transform):
    """Map term -> weight: smoothed idf ``ln((1+n)/(1+df))+1``, rows scaled to length 1, optionally the ``top`` chi-squared terms.

    ``key`` names the row id; ``col`` is an array column or text (split into words of two or more characters).
    """

    def __init__(self, key: str, col: str, out: str, min_df: int | float = 1, max_df: int | float = 1.0, stop_words: list[str] = (), ngram_range=(1, 1), target: str | None = None, top: int | None = None):
        self.key, self.col, self.out, self.min_df, self.max_df = key, col, out, min_df, max_df
        self.stop_words, self.ngram_range, self.target, self.top = list(stop_words), ngram_range, target, top
        self.idf: DataFrame | None = None
        self.selected: DataFrame | None = None
        self._fitted: tuple[DataFrame, DataFrame] | None = None

    def _terms(self, df: DataFrame) -> DataFrame:
        kind = df.schema[self.col].dataType
        text = F.array_join(F.transform(self.col, lambda v: v.cast("string")), " ") if isinstance(kind, T.ArrayType) else F.col(self.col).cast("string")
        words = F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1)), lambda t: ~t.isin(self.stop_words) if self.stop_words else F.lit(True))
        lo, hi = self.ngram_range
        grams = F.concat(*[F.transform(ngrams(F.col("_w"), n), lambda g: F.array_join(g, " ")) for n in range(lo, hi + 1)])
        rows = df.select(self.key, words.alias("_w")).select(self.key, F.explode(grams).alias("term"))
        return rows.groupBy(self.key, "term").agg(F.count("*").alias("tf"))

    def _packed(self, df: DataFrame) -> DataFrame:
        """One array of (term, weight) per row, scaled to length 1 inside the row."""
        terms = self._fitted[1] if self._fitted and self._fitted[0] is df else self._terms(df)  # the texts of the fit are not read again
        w = terms.join(self.idf, "term").select(self.key, "term", (F.col("tf") * F.col("idf")).alias("w"))
        w = w.repartition(self.key)  # lists are built behind the shuffle only
        rows = w.groupBy(self.key).agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("e"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
        return rows.select(self.key, F.transform("e", lambda x: F.struct(x.term.alias("term"), (x.w / F.col("n")).alias("w"))).alias("e"))

    def fit(self, df):
        n = df.count()
        lo = self.min_df if isinstance(self.min_df, int) else self.min_df * n
        hi = self.max_df if isinstance(self.max_df, int) else self.max_df * n
        self._fitted = df, written(self._terms(df), "tf")
        df_ = self._fitted[1].groupBy("term").agg(F.count("*").alias("df")).where(F.col("df").between(lo, hi))
        self.idf = written(df_.select("term", (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf")), "idf")
        if self.top is not None:
            weights = self._packed(df).select(self.key, F.explode("e").alias("x")).select(self.key, "x.term", "x.w")
            self.selected = chi_squared(weights, df.select(self.key, F.col(self.target).alias("target")), self.key)
            self.selected = self.selected.orderBy(F.desc("chi2"), "term").limit(self.top).select("term")
        return self

    def transform(self, df):
        packed = self._packed(df)
        if self.selected is not None:
            flat = packed.select(self.key, F.explode("e").alias("x")).select(self.key, "x.term", "x.w").join(self.selected, "term", "left_semi")
            packed = flat.groupBy(self.key).agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("e"))
        packed = packed.select(self.key, F.map_from_entries("e").alias(self.out))
        return df.join(packed, self.key, "left").withColumn(self.out, F.coalesce(self.out, F.create_map().cast("map<string,double>")))


def chi_squared(weights: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Chi-squared of each term's weight sums per class against their expectation: ``term, chi2``."""
    n = targets.agg(F.count("*")).scalar()
    classes = targets.groupBy("target").agg((F.count("*") / n).alias("p"))
    seen = written(weights.join(targets, key).groupBy("term", "target").agg(F.sum("w").alias("o")), "term-classes")  # read twice
    total = seen.groupBy("term").agg(F.sum("o").alias("t"))
    # classes a term never meets add their whole expectation t*p; together 1 minus the met shares
    parts = seen.join(total, "term").join(classes, "target").withColumn("e", F.col("t") * F.col("p"))
    met = parts.groupBy("term").agg(F.sum(F.pow(F.col("o") - F.col("e"), 2) / F.col("e")).alias("x"), F.sum("p").alias("ps"), F.first("t").alias("t"))
    return met.select("term", (F.col("x") + F.col("t") * (1.0 - F.col("ps"))).alias("chi2"))


def fit_classifier(df: DataFrame, target: str, numbers: list[str], categories: list[str], kind: str = "logistic", **params):
    """One-hot categories and numbers (missing -> 0) into a classifier; returns a scorer of class probabilities.

    The scorer adds ``prediction`` (readable class) and ``probabilities`` (array in class order).
    """
    filled = lambda x: x.fillna(0, numbers).fillna("", categories)
    label = StringIndexer(inputCol=target, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="error").fit(df)
    stages = [StringIndexer(inputCol=c, outputCol=f"_{c}", handleInvalid="keep", stringOrderType="alphabetAsc") for c in categories]
    stages += [OneHotEncoder(inputCol=f"_{c}", outputCol=f"_{c}_hot", handleInvalid="keep") for c in categories]
    stages += [VectorAssembler(inputCols=[*numbers, *[f"_{c}_hot" for c in categories]], outputCol="_x")]
    make = {"logistic": LogisticRegression, "gbt": GBTClassifier}[kind]
    stages += [make(featuresCol="_x", labelCol="_label", predictionCol="_p", **params)]
    model = Pipeline(stages=stages).fit(label.transform(filled(df)))
    names = F.array(*[F.lit(x) for x in label.labels])

    def score(rows: DataFrame) -> DataFrame:
        out = model.transform(filled(rows))
        probs = F.slice(vector_to_array("probability"), 1, len(label.labels))
        keep = [*rows.columns, F.get(names, F.col("_p").cast("int")).alias("prediction"), probs.alias("probabilities")]
        return out.select(*keep)

    return score


def kfold(df: DataFrame, key: str, target: str, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], k: int = 5, metric: str = "accuracy", seed: int = 42):
    """(``fold, score`` rows, predictions of every held-out fold). Folds are hash buckets of the key."""
    folded = df.withColumn("fold", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(k)).cast("int"))
    held = []
    for i in range(k):
        scorer = fit(folded.where(F.col("fold") != i).drop("fold"))
        held.append(scorer(folded.where(F.col("fold") == i)))
    predictions = reduce(DataFrame.unionByName, held)
    if metric == "accuracy":
        ok = F.when(F.col("prediction") == F.col(target).cast("string"), 1.0).otherwise(0.0)
        scores = predictions.groupBy("fold").agg(F.avg(ok).alias("score"))
    else:
        scores = auc(predictions.withColumn("p", F.element_at("probabilities", -1)), "fold", target, "p")
    return scores, predictions


def auc(df: DataFrame, group: str, target: str, score: str, piece_rows: int | None = None) -> DataFrame:
    """Area under the ROC curve per group from rank sums over score bins: equal scores share their rank.

    Rows are reduced to one per (group, score) before the running count, which runs over pieces of bounded size.
    """
    bins = df.groupBy(group, F.col(score).alias("s")).agg(F.sum(F.col(target).cast("double")).alias("pos"), F.count("*").alias("n"))
    bins = with_pieces(bins.withColumn("neg", F.col("n") - F.col("pos")), [group], ["s"], "_b", piece_rows)
    before = lambda *keys: W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    ahead = bins.groupBy(group, "_b").agg(F.sum("neg").alias("neg")).withColumn("_ahead", F.coalesce(F.sum("neg").over(before(group, "_b")), F.lit(0.0)))
    ranked = bins.withColumn("_in", F.coalesce(F.sum("neg").over(before(group, "_b", "s")), F.lit(0.0))).join(ahead.drop("neg"), [group, "_b"])
    ranked = ranked.withColumn("below", F.col("_ahead") + F.col("_in"))
    out = ranked.groupBy(group).agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("q")
    )
    return out.select(group, (F.col("u") / (F.col("p") * F.col("q"))).alias("score"))


def predict_udf(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """A custom ``predict(pandas frame) -> pandas frame`` over all rows, batch by batch."""

    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)
