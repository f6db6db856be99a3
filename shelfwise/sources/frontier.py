"""The crawl plan: which listing URLs a harvest visits."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Site(NamedTuple):
    """One listing site. Sites that are not paged show a single page."""

    site: str
    prefix: str
    blank: str
    suffix: str
    max_pages: int
    paged: bool


# Search URLs of the harvested sites, and the one article page.
SITES = [
    Site("Amazon", "https://www.amazon.in/s?k=", "+", "&rh=n%3A1571271031", 2, True),
    Site("Flipkart", "https://www.flipkart.com/search?q=", "%20", "", 2, True),
    Site("Myntra", "https://www.myntra.com/", "-", "", 1, False),
    Site("H&M", "https://www2.hm.com/en_in/search-results.html?q=", "%20", "", 1, False),
]
ARTICLE_SITE = "Vogue"
ARTICLE_URL = "https://www.vogue.in/fashion"


def term_sites(terms: DataFrame, sites=SITES) -> DataFrame:
    """Every search term at every site.

    The site list is a literal, so each term expands in place without a join.
    """
    plans = F.array(*[
        F.struct(F.lit(s.site).alias("site"), F.lit(s.prefix).alias("prefix"),
                 F.lit(s.blank).alias("blank"), F.lit(s.suffix).alias("suffix"),
                 F.lit(s.max_pages if s.paged else 1).alias("max_pages"),
                 F.lit(s.paged).alias("paged"))
        for s in sites
    ])
    return terms.select("term", F.inline(plans))


def crawl_frontier(terms: DataFrame, sites=SITES) -> DataFrame:
    """Listing URLs as (site, term, page, url), one row per page to fetch."""
    paged = term_sites(terms, sites).withColumn(
        "page", F.explode(F.sequence(F.lit(1), F.col("max_pages"))))
    url = F.concat(
        "prefix", F.replace("term", F.lit(" "), F.col("blank")), "suffix",
        F.when(F.col("paged"), F.concat(F.lit("&page="), F.col("page").cast("string")))
        .otherwise(""),
    )
    return paged.select("site", "term", "page", url.alias("url"))


def article_page(spark: SparkSession) -> DataFrame:
    """The one page that a harvest visits once, whatever its terms."""
    return spark.range(1).select(
        F.lit(ARTICLE_SITE).alias("site"), F.lit(None).cast("string").alias("term"),
        F.lit(1).alias("page"), F.lit(ARTICLE_URL).alias("url"))


def full_frontier(terms: DataFrame, sites=SITES) -> DataFrame:
    """All URLs of a harvest: listings of every term, then the article page."""
    return crawl_frontier(terms, sites).unionByName(article_page(terms.sparkSession))
