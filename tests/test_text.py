import math
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import text
from shelfwise.operators.extract import resolve_links
from shelfwise.schema import NULL_TOKENS


def values(spark, column_of, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column_of(F.col("v"))).collect()]


def test_every_null_token_is_missing(spark):
    assert values(spark, text.normalize_missing, NULL_TOKENS) == [None] * len(NULL_TOKENS)
    assert values(spark, text.normalize_missing, ["Nile", "0", " ", None]) == ["Nile", "0", " ", None]


def test_rating_is_the_first_number(spark):
    given = ["4.3 out of 5 stars", "4", "Rated\n3.5\n(20)", "none", "", None, "5.", ".5"]
    assert values(spark, text.clean_rating, given) == ["4.3", "4", "3.5", None, None, None, "5.", "5"]


def test_price_keeps_its_sign(spark):
    assert values(spark, text.clean_price, ["₹1,23,456", "₹99", None]) == ["₹123456", "₹99", None]


def test_coercion_follows_the_numeric_reader(spark):
    given = ["4.5", " 4.5 ", "4.5d", "4.5f", "4.5D", "nan", "NaN", "abc", "", None, "1e3", "-2", "+3", "."]
    assert values(spark, lambda c: text.coerce_numeric(c, 3.0), given) == [
        4.5, 4.5, 3.0, 3.0, 3.0, 3.0, 3.0, 3.0, 3.0, 3.0, 1000.0, -2.0, 3.0, 3.0]
    assert values(spark, lambda c: text.coerce_numeric(c, 0.0), ["inf", "x"]) == [math.inf, 0.0]


def test_counts_truncate_and_reject_infinity(spark):
    given = ["7.9", "-7.9", "inf", "-inf", "many", None, "1e30"]
    assert values(spark, lambda c: text.coerce_count(c, 10), given) == [7, -7, 10, 10, 10, 10, 10]


def test_fixed_digits(spark):
    assert values(spark, lambda c: text.fixed_digits(c, 2), [0.876, 4.0], "double") == ["0.88", "4.00"]


def test_file_name(spark):
    assert values(spark, text.file_name, ["file:/a/b/c.jpg", "c.png"]) == ["c.jpg", "c.png"]


def test_optional_link(spark):
    assert values(spark, lambda c: text.optional_link(c, "Go"), ["http://x/p", "N/A", "", None]) == [
        "[Go](http://x/p)", None, None, None]


def test_strip_tags_decodes_once(spark):
    assert values(spark, text.strip_tags, [" <b>A &amp; B</b> ", "&amp;lt;", "x &lt;y&gt;"]) == [
        "A & B", "&lt;", "x <y>"]


HREFS = ["http://other.com/x", "//cdn.com/a.png", "/a/b", "/a/../b/./c", "c.html", "../up/x", "./y",
         "?q=1", "#frag", "", "x/../../z?k=/../v#f", "mailto:a@b.c", "..", ".", "/..", "/a/..", "g;x=1/./y"]
BASES = ["https://shop.example.com/list/page.html?term=a/b#top", "https://shop.example.com",
         "http://h.com/d/", "http://h.com/a/b/c/d"]


@pytest.mark.parametrize("base", BASES)
def test_links_resolve_like_the_standard_library(spark, base):
    links = spark.createDataFrame([(base, h) for h in HREFS], "page string, href string")
    found = {r["href"]: r["link"] for r in resolve_links(links, "page", "href", "link").collect()}
    assert found == {h: urljoin(base, h) for h in HREFS}
