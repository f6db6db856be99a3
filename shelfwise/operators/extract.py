"""Listing pages to records, driven by a table of per-source rules.

A rule splits a page where items start and reads each field of an item with
one pattern. The rules are as many rows as there are kinds of sources, and are
joined to the pages as a broadcast table.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import or_missing, strip_tags
from shelfwise.schema import MISSING


class Rule(NamedTuple):
    """Patterns of one source; None where the source never shows the field."""

    source: str
    base_url: str | None
    item: str
    name: str
    price: str | None
    rating: str | None
    image_url: str | None
    product_url: str | None
    price_prefix: str = ""
    max_items: int | None = None
    keyword: str | None = None


def _open(tag: str, attribute: str) -> str:
    return rf"<{tag}\b[^>]*\b{attribute}"


def _classed(tag: str, name: str) -> str:
    """Start of an element that has `name` among its classes."""
    return rf"""<{tag}\b[^>]*\bclass=["'](?:[^"']*\s)?{name}(?=[\s"'])"""


_ATTR = r"""=["']([^"']*)["']"""
_IMG = r"<img\b[^>]*\bsrc" + _ATTR
_LINK = r"<a\b[^>]*\bhref" + _ATTR

# Site addresses, element and class names, and the article limits.
SITE_RULES = [
    Rule("Amazon", "https://www.amazon.in",
         _open("[a-z]+", r"""data-component-type=["']s-search-result["']"""),
         r"(?s)<h2\b[^>]*>\s*<a\b[^>]*>\s*<span\b[^>]*>(.*?)</span>",
         rf"(?s){_classed('[a-z]+', 'a-price-whole')}[^>]*>(.*?)</",
         rf"(?s){_classed('[a-z]+', 'a-icon-alt')}[^>]*>(.*?)</",
         _classed("img", "s-image") + r"[^>]*\bsrc" + _ATTR,
         r"(?s)<h2\b[^>]*>\s*<a\b[^>]*\bhref" + _ATTR, price_prefix="₹"),
    Rule("Flipkart", "https://www.flipkart.com",
         _open("div", "data-id="),
         r"<a\b[^>]*\btitle" + _ATTR,
         rf"(?s){_classed('div', '(?:_30jeq3|_1_WHN1)')}[^>]*>(.*?)</div>",
         rf"(?s){_classed('div', '_3LWZlK')}[^>]*>(.*?)</",
         _IMG,
         r"<a\b(?=[^>]*\btitle=)[^>]*\bhref" + _ATTR),
    Rule("Myntra", "https://www.myntra.com",
         _classed("li", "product-base"),
         rf"(?s)(?:{_classed('h3', 'product-brand')}|{_classed('h4', 'product-product')})[^>]*>(.*?)</h[34]>",
         rf"(?s){_classed('span', 'product-discountedPrice')}[^>]*>(.*?)</span>",
         rf"(?s){_classed('span', 'product-rating')}[^>]*>(.*?)</span>",
         _classed("img", "product-image") + r"[^>]*\bsrc" + _ATTR,
         _LINK),
    Rule("Vogue", "https://www.vogue.in",
         rf"(?:<article\b|{_classed('[a-z]+', '(?:article-item|story-card)')})",
         rf"(?s)(?:<h[123]\b|{_classed('[a-z]+', '(?:headline|title)')})[^>]*>(.*?)</",
         None, None, _IMG, _LINK, max_items=15, keyword="fashion"),
    Rule("H&M", "https://www2.hm.com",
         _classed("article", "item"),
         rf"(?s)(?:<h3\b|{_classed('[a-z]+', 'item-heading')})[^>]*>(.*?)</(?!a\b)",
         rf"(?s){_classed('[a-z]+', 'price')}[^>]*>(.*?)</",
         None, _IMG, _LINK),
]


def rules_table(spark: SparkSession, rules=SITE_RULES) -> DataFrame:
    """The rules as a literal table, with `rule_` before the field names."""
    columns = {f"rule_{f}": pa.array([getattr(r, f) for r in rules],
                                     pa.int32() if f == "max_items" else pa.string())
               for f in Rule._fields}
    return spark.createDataFrame(pa.table(columns))


def with_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Join every page to the rule of its source; `skipped_pages` lists pages whose source has none.

    `rules` comes from a literal list of sources, which bounds its size.
    """
    return pages.join(F.broadcast(rules), F.col("source") == F.col("rule_source"))


# The part of an item that lies in its element: tokens start at the opening and closing tags of the element's name.
_ELEMENT = """if(item rlike '^<[A-Za-z]', aggregate(
    split(item, concat('(?i)(?=</?', regexp_extract(item, '^<([A-Za-z][A-Za-z0-9-]*)', 1), '[\\\\s/>])')),
    named_struct('depth', 0, 'text', '', 'closed', false),
    (a, t) -> if(a.closed, a, named_struct(
        'depth', a.depth + if(startswith(t, '</'), -1, 1),
        'text', concat(a.text, if(startswith(t, '</') and a.depth = 1, regexp_extract(t, '^[^>]*>?', 0), t)),
        'closed', startswith(t, '</') and a.depth = 1)),
    a -> a.text), item)"""


def explode_items(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per item, with its 0-based place on the page.

    An item is the element that its start mark opens, up to the tag that closes
    it; where that is missing, it ends at the next start mark. Pages without
    items give no rows; `skipped_pages` lists them.
    """
    marked = with_rules(pages, rules)
    # The blank makes sure that the first piece is what precedes the first mark.
    pieces = F.expr("split(concat(' ', html), concat('(?=', rule_item, ')'))")
    items = F.slice(pieces, 2, 2**31 - 1)
    keep = [c for c in marked.columns if c != "html"]
    cut = marked.select(*keep, F.posexplode(items).alias("pos", "item"))
    return cut.withColumn("item", F.expr(_ELEMENT))


def skipped_pages(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages that give no item, with the `reason`: their source has no rule, or its rule finds none."""
    marked = pages.join(F.broadcast(rules), F.col("source") == F.col("rule_source"), "left")
    found = F.coalesce(F.expr("html rlike rule_item"), F.lit(False))
    reason = F.when(F.col("rule_source").isNull(), "no rule").otherwise("no item")
    return marked.where(~found).select(*pages.columns, reason.alias("reason"))


def resolve_links(df: DataFrame, base: str, href: str, out: str) -> DataFrame:
    """Add the absolute form of link `href` found on page `base` (RFC 3986, section 5).

    Both are columns, and `base` holds absolute URLs. Each part of the URLs is
    a step of its own, so none is worked out twice.
    """
    steps = {
        "__bare": f"substring_index(substring_index({base}, '#', 1), '?', 1)",
        "__scheme": "substring_index(__bare, '://', 1)",
        "__rest": "substr(__bare, length(__scheme) + 4)",
        "__host": "substring_index(__rest, '/', 1)",
        "__dir": "regexp_replace(substr(__rest, length(__host) + 1), '[^/]*$', '')",
        "__link": f"substring_index(substring_index({href}, '#', 1), '?', 1)",
        "__path": """case when startswith(__link, '/') then __link
            when __dir = '' then concat('/', __link) else concat(__dir, __link) end""",
        # A path that ends in a dot segment names a folder.
        "__segments": """case when contains(__path, '/.')
            then split(regexp_replace(__path, '/([.]{1,2})$', '/$1/'), '/') end""",
        "__merged": """case when __segments is null then __path else array_join(aggregate(
            __segments, cast(array() as array<string>), (kept, part) -> case
              when part = '.' then kept
              when part = '..' then if(size(kept) > 1, slice(kept, 1, size(kept) - 1), kept)
              else array_append(kept, part) end), '/') end""",
        "__resolved": f"""case
            when {href} = '' then {base}
            when startswith({href}, '//') then concat(__scheme, ':', {href})
            when startswith({href}, '?') then concat(__bare, {href})
            when startswith({href}, '#') then concat(substring_index({base}, '#', 1), {href})
            when not startswith({href}, '/') and {href} rlike '^[A-Za-z][A-Za-z0-9+.-]*:' then {href}
            else concat(__scheme, '://', __host, __merged, substr({href}, length(__link) + 1)) end""",
    }
    staged = df.selectExpr("*", *[f"{sql} as {name}" for name, sql in steps.items()])
    return staged.select(*df.columns, F.col("__resolved").alias(out))


def _field(name: str):
    """First match of the rule's pattern in the item; NULL without one."""
    return F.expr(f"case when item rlike rule_{name} then regexp_extract(item, rule_{name}, 1) end")


def extract_fields(items: DataFrame) -> DataFrame:
    """Item text to (name, price, rating, image_url, product_url, source)."""
    base = F.coalesce("rule_base_url", "url") if "url" in items.columns else F.col("rule_base_url")
    kept = [c for c in items.columns if not c.startswith("rule_") and c != "item"]
    limits = ["rule_max_items", "rule_keyword"]
    # Patterns are matched here once; the next step only combines their texts.
    raw = items.select(*kept, *limits, base.alias("__base"), "rule_price_prefix", *[
        strip_tags(_field(f)).alias(f"__{f}")
        for f in ("name", "price", "rating", "image_url", "product_url")])
    return resolve_links(raw, "__base", "__product_url", "__link").select(
        *kept,
        or_missing(F.col("__name")).alias("name"),
        or_missing(F.concat("rule_price_prefix", "__price")).alias("price"),
        or_missing(F.col("__rating")).alias("rating"),
        or_missing(F.col("__image_url")).alias("image_url"),
        or_missing(F.col("__link")).alias("product_url"),
        *limits,
    )


def apply_item_limits(records: DataFrame) -> DataFrame:
    """First the source's item limit per page, then its keyword."""
    within = F.col("rule_max_items").isNull() | (F.col("pos") < F.col("rule_max_items"))
    wanted = F.col("rule_keyword").isNull() | F.contains(F.lower("name"), F.col("rule_keyword"))
    return records.where(within).where(wanted).drop("rule_max_items", "rule_keyword")


def harvest(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages (page_id, url, html, source) to named product records."""
    records = apply_item_limits(extract_fields(explode_items(pages, rules)))
    return records.where(F.col("name") != MISSING)


def page_links(pages: DataFrame) -> DataFrame:
    """Every link of every page, in order, resolved against the page's URL."""
    found = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    links = pages.select("page_id", "url", F.posexplode(found).alias("pos", "href"))
    return resolve_links(links, "url", "href", "link")
