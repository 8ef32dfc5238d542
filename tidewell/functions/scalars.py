"""Scalar column functions; all run inside code generation unless noted."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, functions as F

# Request path patterns and their templates, in matching order.
PATH_TEMPLATES = [
    (r"^/users/[^/]+/recommendations$", "/users/{userid}/recommendations"),
    (r"^/items/[^/]+/actions$", "/items/{itemid}/actions"),
    (r"^/users/[^/]+/actions$", "/users/{userid}/actions"),
    (r"^/items/[^/]+$", "/items/{itemid}"),
    (r"^/users/[^/]+/actions/[^/]+$", "/users/{userid}/actions/{itemid}"),
    (r"^/items/[^/]+/actions/[^/]+$", "/items/{itemid}/actions/{userid}"),
    (r"^/actions/[^/]+$", "/actions/{actionid}"),
]

# Strings read as booleans.
BOOL_MAP = {"true": 1, "false": 0, "1": 1, "0": 0, "yes": 1, "no": 0, "1.0": 1, "0.0": 0}

# Accepted publish date formats.
PUBLISH_FORMATS = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss"]


def path_template(path: str | Column) -> Column:
    """Request path with ids replaced by placeholders; ``/js`` paths and unknown ones stay."""
    path = F.col(path) if isinstance(path, str) else path
    out = F.when(path.startswith("/js"), path)
    for pattern, template in PATH_TEMPLATES:
        out = out.when(path.rlike(pattern), F.lit(template))
    return out.otherwise(path)


def tag_token(tag: str | Column) -> Column:
    tag = F.col(tag) if isinstance(tag, str) else tag
    return F.regexp_replace(F.lower(F.trim(tag)), "[ :;'\",]", "_")


def default_tag(tag: str) -> Column:
    """Missing recommendation tag reads ``default``."""
    c = F.col(tag)
    return F.when(c.isNull() | (c == "null"), "default").otherwise(c)


def default_variation(key: str) -> Column:
    """Missing variation key reads ``all``."""
    c = F.col(key)
    return F.when(c.isNull() | (c == "-"), "all").otherwise(c)


def best_class(predictions: str) -> Column:
    """Struct (score, name) of the highest-scoring class of ``array<struct<prediction, predictedClass, …>>``."""
    return F.array_max(
        F.transform(predictions, lambda p: F.struct(p["prediction"].alias("score"), p["predictedClass"].alias("name")))
    )


def cyclic_date(ts: str, prefix: str, parts=(True, True, True, True)) -> dict[str, Column]:
    """Hour, month, weekday (Monday = 0) as points on a circle with labels, and the year label."""
    t = F.col(ts)
    out: dict[str, Column] = {}

    def circle(value: Column, period: float, label: str, sin: str, cos: str, mark: str) -> None:
        angle = value / F.lit(period) * F.lit(2) * F.pi()
        out[f"{prefix}_{label}"] = F.concat(F.lit(mark), value.cast("string"))
        out[f"{prefix}_{sin}"] = F.sin(angle)
        out[f"{prefix}_{cos}"] = F.cos(angle)

    if parts[0]:
        circle(F.hour(t), 24.0, "hour", "h1", "h2", "h")
    if parts[1]:
        circle(F.month(t), 12.0, "month", "m1", "m2", "m")
    if parts[2]:
        circle(F.weekday(t), 7.0, "w", "w1", "w2", "w")
    if parts[3]:
        out[f"{prefix}_year"] = F.concat(F.lit("y"), F.year(t).cast("string"))
    return out


def date_diffs(cols: list[str]) -> dict[str, Column]:
    """Pairwise differences in fractional days."""
    return {
        f"{a}_{b}": (F.unix_micros(F.col(a).cast("timestamp")) - F.unix_micros(F.col(b).cast("timestamp"))) / 86_400_000_000.0
        for a, b in combinations(cols, 2)
    }


def binary(col: str) -> Column:
    """1 when present and not "0", 0 or empty."""
    c = F.col(col)
    text = c.cast("string")
    number = text.try_cast("double")
    return F.when(c.isNull() | (text == "") | (text == "0") | F.coalesce(number == 0, F.lit(False)), 0).otherwise(1)


def split_tokens(cols: list[str], pattern: str = " ", ignore_numbers: bool = False) -> Column:
    """Tokens of several text columns, trimmed right and lower-cased, numbers dropped on request."""
    empty = F.array().cast("array<string>")
    parts = [F.coalesce(F.split(F.col(c), pattern), empty) for c in cols]
    tokens = F.transform(F.concat(*parts), lambda t: F.lower(F.rtrim(t)))
    if ignore_numbers:
        tokens = F.filter(tokens, lambda t: t.try_cast("double").isNull())
    return tokens


def bool_map(col: str | Column, mapping: dict[str, int] | None = None) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    out = F.lit(None).cast("int")
    for text, number in (mapping or BOOL_MAP).items():
        out = F.when(F.lower(c.cast("string")) == text, F.lit(number)).otherwise(out)
    return out


def ngrams(col: str | Column, n: int) -> Column:
    """Array of n-grams, each an array of n consecutive elements."""
    c = F.col(col) if isinstance(col, str) else col
    starts = F.when(F.size(c) >= n, F.sequence(F.lit(1), F.size(c) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(c, i, n))


def unix_day(ts: str | Column) -> Column:
    return F.unix_date(F.to_date(ts))


def publish_date(col: str | Column, formats: list[str] | None = None) -> Column:
    """First format that parses wins."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats or PUBLISH_FORMATS])


def dot(a: Column | str, b: Column | str) -> Column:
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine; 0 when a norm is 0."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def divided(a: Column | str, by: Column) -> Column:
    """Array over a number that is worked out once per row; inside a lambda it would be once per element."""
    return F.zip_with(a, F.array_repeat(by, F.size(a)), lambda x, n: x.cast("double") / n)


def unit(a: Column | str) -> Column:
    """Vector scaled to length 1; a zero vector stays as it is."""
    n = norm(a)
    return divided(a, F.when(n > 0, n).otherwise(F.lit(1.0)))


def sigmoid_normalise(scores: Column | str) -> Column:
    """Array of logistic values divided by their sum."""
    squashed = F.transform(scores, lambda x: 1.0 / (1.0 + F.exp(-x)))
    return divided(squashed, F.aggregate(squashed, F.lit(0.0), lambda acc, x: acc + x))


def json_features(col: str) -> Column:
    """``array<struct<namespace, feature, value>>``: numeric fields go to the default namespace,
    the numeric fields of a nested object to one of its own; everything else is ignored."""
    kind = "array<struct<namespace:string,feature:string,value:double>>"
    top = F.coalesce(F.map_entries(F.from_json(col, "map<string,string>")), F.array().cast("array<struct<key:string,value:string>>"))

    def is_object(v: Column) -> Column:
        return F.ltrim(v).startswith("{")

    flat = F.transform(
        F.filter(top, lambda e: ~is_object(e.value) & e.value.try_cast("double").isNotNull()),
        lambda e: F.struct(F.lit("").alias("namespace"), e.key.alias("feature"), e.value.try_cast("double").alias("value")),
    )
    nested = F.flatten(
        F.transform(
            F.filter(top, lambda e: is_object(e.value)),
            lambda e: F.transform(
                F.filter(
                    F.coalesce(F.map_entries(F.from_json(e.value, "map<string,string>")), F.array().cast("array<struct<key:string,value:string>>")),
                    lambda x: x.value.try_cast("double").isNotNull(),
                ),
                lambda x: F.struct(e.key.alias("namespace"), x.key.alias("feature"), x.value.try_cast("double").alias("value")),
            ),
        )
    )
    return F.concat(flat.cast(kind), nested.cast(kind))


def base_url(url: str | Column) -> Column:
    """``protocol://host/path`` of a URL."""
    u = F.col(url) if isinstance(url, str) else url
    return F.concat(
        F.try_parse_url(u, F.lit("PROTOCOL")),
        F.lit("://"),
        F.try_parse_url(u, F.lit("HOST")),
        F.coalesce(F.try_parse_url(u, F.lit("PATH")), F.lit("")),
    )
