"""Attributes and tags of web pages; pages are parsed in batches inside tasks, everything after is columns."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewell.functions.html import Page
from tidewell.functions.scalars import base_url, publish_date

# Attributes of a page and the two outcomes.
FIELDS = ["title", "image", "lead", "published", "link", "body", "category", "sub_category"]
SUCCEEDED, FAILED = "EXTRACTION_SUCCEEDED", "EXTRACTION_FAILED"


def _image(page: Page, selector: str | None, default: str) -> str:
    hit = page.first(selector)
    if hit:
        for name in ("content", "src", "href"):
            if (hit[0].get(name) or "").strip():
                return hit[0][name].strip()
    return default


#: Pages of a batch that are read at once.
PAGES = 64


def _read(pages: DataFrame, columns: list[str], fn: Callable[..., list], fields: dict[str, str]) -> DataFrame:
    """``page_id`` and the row that ``fn`` makes of the other columns of a page, a few pages at a time: a batch may hold 10,000 whole ones."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                part = batch.slice(at, PAGES)
                rows = [fn(*x) for x in zip(*(part.column(c).to_pylist() for c in columns))]
                values = [pa.array(x, pa.string() if kind == "string" else pa.list_(pa.string())) for kind, x in zip(fields.values(), zip(*rows))]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), *values], names=["page_id", *fields])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    return pages.select(F.col("page_id").cast("long"), *columns).mapInArrow(run, f"page_id long, {schema}")


def _raw(html: str, url: str, sel: dict[str, str], default_image: str, category_fn) -> dict[str, str]:
    page = Page(html, list(sel.values()))

    def either(name: str) -> str:
        return page.content(sel.get(name)) or page.text(sel.get(name))

    category = category_fn(html, url) if category_fn else either("category")
    return {
        "title": either("title"),
        "image": _image(page, sel.get("image"), default_image),
        "lead": either("lead"),
        "published": either("published"),
        "link": page.content(sel.get("link")) or (page.first(sel.get("link")) or [{}])[0].get("href", ""),
        "body": page.text(sel.get("body")),
        "category": (category or "").upper(),
        "sub_category": either("sub_category").upper(),
    }


def page_attributes(
    pages: DataFrame,
    selectors: dict[str, str] | None = None,
    default_image: str = "",
    required: list[str] = ("title",),
    category_fn: Callable[[str, str], str] | None = None,
    attribute_list: list[dict] | None = None,
) -> DataFrame:
    """Attributes per page with ``status`` and the ``missing`` required ones. ``pages``: ``page_id, url, html``.

    Title, lead, date and category come from the selected element's ``content`` or its text; the image from
    ``content``, ``src``, ``href`` or a default. With ``attribute_list`` the configured attributes are extracted
    instead: ``name, kind, selector, arg, default, required``.
    """
    if attribute_list is not None:
        return _configured(pages, attribute_list)
    sel = dict(selectors or {})

    def read(html, url):
        row = _raw(html, url, sel, default_image, category_fn)
        return [url, *(row[f] for f in FIELDS)]

    raw = _read(pages, ["html", "url"], read, dict.fromkeys(["url", *FIELDS], "string"))
    out = raw.withColumn("domain", F.try_parse_url("url", F.lit("HOST"))).withColumn("published", publish_date("published"))
    missing = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(r).cast("string")), F.lit("")) == "", F.lit(r)) for r in required]))
    return out.withColumn("missing", missing).withColumn("status", F.when(F.size("missing") == 0, SUCCEEDED).otherwise(FAILED))


# Extractors by name: ``fn(page, selector, arg, url) -> text``.
EXTRACTORS: dict[str, Callable[[Page, str, str | None, str], str]] = {
    "content": lambda page, sel, arg, url: page.content(sel),
    "text": lambda page, sel, arg, url: page.text(sel),
    "attribute": lambda page, sel, arg, url: (page.first(sel) or [{}])[0].get(arg, ""),
    "list": lambda page, sel, arg, url: (arg or ",").join(page.all_texts(sel)),
    "url": lambda page, sel, arg, url: url,
}


def _configured(pages: DataFrame, attributes: list[dict]) -> DataFrame:
    names = [a["name"] for a in attributes]
    extract = {a["kind"]: EXTRACTORS[a["kind"]] for a in attributes}

    def read(html, url):
        page = Page(html, [a.get("selector", "") for a in attributes])
        return [(extract[a["kind"]](page, a.get("selector", ""), a.get("arg"), url) or "").strip() for a in attributes]

    raw = _read(pages, ["html", "url"], read, dict.fromkeys(names, "string"))
    filled = raw.withColumns({a["name"]: F.when(F.col(a["name"]) == "", F.lit(a.get("default", ""))).otherwise(F.col(a["name"])) for a in attributes})
    needed = [F.when(F.col(a["name"]) == "", F.lit(a["name"])) for a in attributes if a.get("required")]
    missing = F.array_compact(F.array(*needed)) if needed else F.array().cast("array<string>")
    return filled.withColumn("missing", missing).withColumn("status", F.when(F.size("missing") == 0, SUCCEEDED).otherwise(FAILED))


def page_tags(pages: DataFrame, selector: str, title_selector: str = "title") -> DataFrame:
    """Distinct tags per page: the first element's comma-separated ``content``, else all elements' texts; plus adjacent
    tag pairs that occur as a phrase in the title."""

    def read(html):
        page = Page(html, [selector, title_selector])
        content = page.content(selector)
        return [page.content(title_selector) or page.text(title_selector), content.split(",") if content else page.all_texts(selector)]

    raw = _read(pages, ["html"], read, {"title": "string", "raw": "array<string>"})
    parts = raw.select("page_id", F.lower("title").alias("title"), F.transform("raw", lambda t: F.lower(F.trim(t))).alias("parts"))
    shifted = F.slice("parts", F.lit(2), F.greatest(F.size("parts") - 1, F.lit(0)))
    pairs = F.zip_with("parts", shifted, lambda a, b: F.when((a != "") & (b != ""), F.concat(a, F.lit(" "), b)))
    phrases = F.filter(F.array_compact(pairs), lambda p: F.contains(F.col("title"), p))
    return parts.select("page_id", F.array_union("parts", phrases).alias("tags"))


def page_base_urls(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", base_url("url").alias("base"))
