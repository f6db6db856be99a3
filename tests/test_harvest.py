import pytest
from pyspark.sql import functions as F

from shelfwise.session import fresh_path
from shelfwise.sources import harvest


@pytest.mark.parametrize("url,want", [
    ("HTTP://Shop.Example.com:80", "http://shop.example.com/"),
    ("https://shop.example.com:443/A/b?z=1&a=2#top", "https://shop.example.com/A/b?a=2&z=1"),
    ("https://shop.example.com:8443/?", "https://shop.example.com:8443/"),
    (" https://x.y/p?&q=1& ", "https://x.y/p?q=1"), ("/relative?b&a", "/relative?a&b"), (None, None)])
def test_one_spelling(spark, url, want):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(harvest.normalized_url(F.col("url"))).first()[0] == want


def test_second_harvest_plans_the_difference(spark):
    path, urls = fresh_path(spark, "ledger"), "url string, term string"
    ledger = harvest.open_ledger(spark, "ledger_test", path, 4)
    plan = spark.createDataFrame([("http://a/1", "x"), ("HTTP://A/1#f", "y"), ("http://a/2", "x"), ("http://a/3", "x")], urls)
    first = harvest.due_urls(plan, ledger).collect()
    assert sorted((r["url"], r["attempts"]) for r in first) == [("HTTP://A/1#f", 0), ("http://a/2", 0), ("http://a/3", 0)]

    def fetched(*rows):
        harvest.record_fetches(spark.createDataFrame(rows, "url string, status string"), "ledger_test", path, 4)
        found = harvest.due_urls(plan, harvest.open_ledger(spark, "ledger_test", path, 4)).collect()
        return sorted((r["url"], r["attempts"]) for r in found)

    assert fetched(("http://A/1", "ok"), ("http://a/2", "failed")) == [("http://a/2", 1), ("http://a/3", 0)]
    assert fetched(("http://a/2", "failed"), ("http://a/3", None)) == [("http://a/2", 2), ("http://a/3", 1)]
    assert fetched(("http://a/2", "failed"), ("http://a/3", "ok")) == []
    again = harvest.open_ledger(spark, "ledger_again", path, 4)  # as another session would
    assert harvest.due_urls(plan, again).count() == 0 and again.count() == 6
    for name in ("ledger_test", "ledger_again"):
        spark.sql(f"drop table {name}")


def test_the_ledger_is_not_shuffled(spark):
    path = fresh_path(spark, "ledger")
    fetches = spark.range(50).selectExpr("concat('http://a/', id) as url", "'ok' as status")
    harvest.record_fetches(fetches, "ledger_plan", path, 4)
    plan = spark.range(100).selectExpr("concat('http://a/', id) as url")
    due = harvest.due_urls(plan, spark.table("ledger_plan"))
    text = due._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and due.count() == 50  # that of the plan
    spark.sql("drop table ledger_plan")
