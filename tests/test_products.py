import pytest
import os

from pyspark.sql import functions as F

from shelfwise.operators import aggregate, clean
from shelfwise.schema import PRODUCT, SUMMARY
from shelfwise.session import fresh_path
from shelfwise.sinks import files
from shelfwise.sources.frontier import ARTICLE_URL, crawl_frontier, full_frontier
from shelfwise.sources.products import add_default_column, read_products

CSV = '''name,price,rating,image_url,product_url,source
Shirt,"₹1,299",4.3 out of 5 stars,https://i/1.jpg,https://p/1,Amazon
"Two
lines","₹99",None,,null,Flipkart
"Quote ""Q"" shirt",N/A,NaN,NA,https://p/3,Myntra
'''


def products(spark, rows):
    return spark.createDataFrame(
        rows, "product_id long, name string, price string, rating string, source string")


ROWS = [
    (3, "Shirt", "₹1,000", "4.1 of 5", "Amazon"),
    (1, "Shirt", "₹2,000", "3", "Amazon"),
    (2, "Shirt", "₹3", None, "Flipkart"),
    (4, "N/A", "₹4", "2", "Amazon"),
    (5, "N/A", "₹4", "2", "Amazon"),
]


def test_csv_reader_takes_all_null_tokens_quotes_and_line_breaks(spark, tmp_path):
    path = os.path.join(tmp_path, "products.csv")
    with open(path, "w", encoding="utf-8") as out:
        out.write(CSV)
    rows = read_products(spark, path).collect()
    assert [r["name"] for r in rows] == ["Shirt", "Two\nlines", 'Quote "Q" shirt']
    assert [r["rating"] for r in rows] == ["4.3 out of 5 stars", None, None]
    assert [r["image_url"] for r in rows] == ["https://i/1.jpg", None, None]
    assert rows[1]["product_url"] is None and rows[2]["price"] is None


def test_csv_round_trip_keeps_text_and_vectors(spark):
    path = fresh_path(spark, "csv")
    df = spark.createDataFrame([("a,b", 'say "x"', [1.0, 2.0] * 800), ("l\nm", None, None)],
                               "name string, note string, v array<double>")
    files.write_csv(df, path)
    back = {r["name"]: r for r in read_products(spark, path).collect()}
    assert back["a,b"]["note"] == 'say "x"' and back["l\nm"]["note"] is None
    assert back["a,b"]["v"].count(",") == 1599  # nothing elided


def test_default_column_is_added_only_when_absent(spark):
    df = products(spark, ROWS)
    assert {r[0] for r in add_default_column(df, "no_of_reviews", 10).select("no_of_reviews").collect()} == {10}
    assert add_default_column(df, "price", "0").columns == df.columns


def test_clean_keeps_the_first_by_key(spark):
    rows = clean.clean_products(products(spark, ROWS)).orderBy("product_id").collect()
    assert [(r["product_id"], r["price"], r["rating"]) for r in rows] == [(1, "₹2000", "3"), (2, "₹3", None)]


def test_dedup_is_idempotent_and_ignores_partitioning(spark):
    df = products(spark, ROWS)
    once = clean.dedup_products(df)
    assert sorted(once.collect()) == sorted(clean.dedup_products(once).collect())
    assert sorted(once.collect()) == sorted(clean.dedup_products(df.repartition(7)).collect())


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = products(spark, ROWS).repartition(2)
    plan = clean.dedup_products(df)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(name"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_empty_input(spark):
    none = products(spark, [])
    assert clean.clean_products(none).count() == 0
    assert aggregate.total_count(none).first()["total"] == 0
    doc = aggregate.summary_document(none, ["a"]).first()
    assert doc["total_products"] == 0 and doc["sources"] == {}


def test_union_keeps_every_row_and_fills_absent_fields(spark):
    a = spark.createDataFrame([("x", "1")], "name string, price string")
    b = spark.createDataFrame([("x",), ("x",)], "name string")
    both = clean.union_sources(a, b, a)
    assert both.count() == 4 and both.where("price is null").count() == 2


def test_bad_records_are_split_with_a_reason(spark):
    checks = {"name": F.col("name") != "N/A", "rating": F.col("rating").isNotNull()}
    good, bad = clean.split_bad_records(products(spark, ROWS), checks)
    assert {r["product_id"] for r in good.collect()} == {1, 3}
    assert {(r["product_id"], r["reject_reason"]) for r in bad.collect()} == {
        (2, "rating"), (4, "name"), (5, "name")}


def test_null_check_counts_as_failed(spark):
    df = spark.createDataFrame([(1, None)], "product_id int, name string")
    _, bad = clean.split_bad_records(df, {"name": F.col("name") != "N/A"})
    assert bad.first()["reject_reason"] == "name"


def test_manifest(spark):
    df = spark.createDataFrame([(1, "https://a"), (2, "ftp://a"), (3, None), (4, "N/A")],
                               "product_id int, image_url string")
    rows = {r["product_id"]: (r["action"], r["file_name"]) for r in clean.image_manifest(df).collect()}
    assert rows == {1: ("fetch", "1.jpg"), 2: ("skip", None), 3: ("skip", None), 4: ("skip", None)}


def test_limit_comes_before_the_keyword(spark):
    df = spark.createDataFrame([(1, "News"), (2, "FASHION week"), (3, "fashion")], "i int, title string")
    kept = clean.limit_then_keyword(df, ["i"], 2, "title", "fashion").collect()
    assert [r["i"] for r in kept] == [2]


def test_full_crawl_plan(spark):
    from shelfwise.schema import SEARCH_TERMS
    terms = spark.createDataFrame([(t,) for t in SEARCH_TERMS], "term string")
    urls = {r["url"] for r in crawl_frontier(terms).collect()}
    assert len(urls) == 30
    assert "https://www.amazon.in/s?k=mens+shirts&rh=n%3A1571271031&page=2" in urls
    assert "https://www.myntra.com/casual-wear" in urls and ARTICLE_URL not in urls
    every = full_frontier(terms)
    assert every.count() == 31 and every.where("term is null").first()["url"] == ARTICLE_URL


def test_summary_document_shape(spark):
    doc = aggregate.summary_document(products(spark, ROWS), ["a", "b"])
    assert doc.schema.simpleString() == SUMMARY.simpleString()
    row = doc.first()
    assert row["sources"] == {"Amazon": 4, "Flipkart": 1} and row["total_products"] == 5
    assert len(row["scraping_timestamp"]) == 19


def test_product_schema_names():
    assert PRODUCT.names == ["name", "price", "rating", "image_url", "product_url", "source"]


def test_headers_that_differ_are_an_error_or_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("product_id,name,price\n1,shirt,9\n")
    (tmp_path / "b.csv").write_text("price,name,product_id\n99,dress,7\n5,hat,8\n")
    path = f"{tmp_path}/*.csv"
    for multi_line in (True, False):
        with pytest.raises(Exception, match="(?i)header"):
            read_products(spark, path, multi_line).collect()
        rows = {r["product_id"]: (r["name"], r["price"]) for r in read_products(spark, path, multi_line, by_name=True).collect()}
        assert rows == {"1": ("shirt", "9"), "7": ("dress", "99"), "8": ("hat", "5")}
