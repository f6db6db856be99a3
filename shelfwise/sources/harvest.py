"""Harvests that fetch only what is due: the crawl plan against a ledger of earlier fetches.

The ledger has a row per fetch, bucketed by normalised URL, so comparing a plan
with it moves the plan to the ledger's buckets and never the ledger, of which
only narrow columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.clean import first_per_key

MAX_ATTEMPTS = 3
_COLUMNS = "url_key string, status string"


def normalized_url(url: Column) -> Column:
    """One spelling per page: scheme and host in lower case, no default port, no fragment, parameters in order."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    base = F.lower(F.regexp_extract(plain, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1))
    base = F.regexp_replace(F.regexp_replace(base, "^(http://.*):80$", "$1"), "^(https://.*):443$", "$1")
    rest = F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path, query = F.split_part(rest, F.lit("?"), F.lit(1)), F.regexp_extract(rest, "[?](.*)$", 1)
    ordered = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: p != "")), "&")
    return F.concat(base, F.when(path == "", "/").otherwise(path),
                    F.when(ordered == "", "").otherwise(F.concat(F.lit("?"), ordered)))


def record_fetches(fetches: DataFrame, table: str, path: str, buckets: int) -> None:
    """Append (url, status) of a harvest to the ledger; the status of a page that is held is `ok`."""
    rows = fetches.select(normalized_url(F.col("url")).alias("url_key"), "status").repartition(buckets, "url_key")
    (rows.write.mode("append").bucketBy(buckets, "url_key").option("path", path).saveAsTable(table))


def open_ledger(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """The ledger in `path`, also one of another session or one without fetches yet."""
    if not spark.catalog.tableExists(table):
        place = path.replace("'", "\\'")
        spark.sql(f"create table {table} ({_COLUMNS}) using parquet "
                  f"clustered by (url_key) into {int(buckets)} buckets location '{place}'")
    return spark.table(table)


def due_urls(frontier: DataFrame, ledger: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Rows of the plan whose page is not held and has not failed `max_attempts` times, with `attempts` so far.

    Rows of one page are one, that of the smallest URL as it is spelled.
    """
    wanted = first_per_key(frontier.withColumn("url_key", normalized_url(F.col("url"))), ["url_key"], ["url"])
    known = ledger.groupBy("url_key").agg(F.max((F.col("status") == "ok").cast("int")).alias("held"),
                                          F.count(F.lit(1)).alias("attempts"))
    return (wanted.join(known, "url_key", "left")
            .withColumn("attempts", F.coalesce("attempts", F.lit(0)))
            .where((F.coalesce("held", F.lit(0)) == 0) & (F.col("attempts") < max_attempts))
            .drop("held", "url_key"))
