"""The given tables seen as catalogue data.

The tables are generic; each function states how one of them plays a part of
the data model. Whole tables are used throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.extract import Rule
from shelfwise.operators.imaging import encode_png
from shelfwise.session import fresh_path
from shelfwise.sinks.files import write_binary_files
from shelfwise.sources.pages import host_of, scan_pages

IMAGE_WIDTH, IMAGE_HEIGHT = 640, 480
TILE = 8  # side of the pictures made from 64-element vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def product_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as harvested products: mixed spellings, gaps and duplicates.

    Reviews are the line items of a part, counted before the join so that a
    part with very many of them costs one row.
    """
    reviews = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return parts.join(reviews, F.col("p_partkey") == F.col("l_partkey"), "left").selectExpr(
        "p_partkey as product_id",
        "case when p_partkey % 50 = 0 then 'N/A' else p_name end as name",
        """case when p_partkey % 13 = 0 then 'N/A'
             else concat('₹1,', cast(p_partkey % 900 + 100 as string)) end as price""",
        """case p_partkey % 6 when 0 then 'N/A'
             when 1 then concat(cast(1 + p_partkey % 4 as string), '.',
                                cast(p_partkey % 10 as string), ' out of 5 stars')
             when 2 then concat(cast(1 + p_partkey % 4 as string), '.',
                                cast(p_partkey % 10 as string))
             when 3 then cast(1 + p_partkey % 5 as string)
             when 4 then '' else null end as rating""",
        """case p_partkey % 11 when 0 then null when 1 then 'n/a'
             else cast(n as string) end as no_of_reviews""",
        """case p_partkey % 7 when 0 then null when 1 then 'N/A'
             when 2 then concat('ftp://img.example.com/', cast(p_partkey as string))
             else concat('https://img.example.com/', cast(p_partkey as string), '.jpg')
             end as image_url""",
        """case p_partkey % 4 when 0 then null when 1 then 'N/A'
             else concat('https://shop.example.com/p/', cast(p_partkey as string))
             end as product_url""",
        """case p_partkey % 5 when 0 then 'Amazon' when 1 then 'Flipkart' when 2 then 'Myntra'
             when 3 then 'H&M' else 'Vogue' end as source""",
    )


def search_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product name as a search term."""
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("term")).distinct()


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as detections: the user is the image, the event id the order."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id as image_id", "event_id as seq",
        """case event_id % 6 when 0 then 'person' when 1 then 'T-Shirt' when 2 then 'laptop'
             when 3 then 'car' when 4 then 'Blouse' else 'dog' end as class_name""",
        "(event_id * 37 % 101) / 100D as confidence",
        """array((event_id * 13 % 640) + 0.5D, (event_id * 29 % 480) + 0.5D,
                 (event_id * 13 % 640) + 0.5D + event_id * 7 % 200,
                 (event_id * 29 % 480) + 0.5D + event_id * 11 % 200) as bbox""",
    )


def detected_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("image_id")).distinct()


def input_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the images a run was given; most have no detections."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("image_id"))


def image_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How reading each image ended; most that were read have no detections."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as image_id",
        "case when c_custkey % 17 = 0 then 'unreadable' when c_custkey % 19 = 0 then null else 'ok' end as status")


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as small pictures in the layout of decoded images."""
    def byte(shift: int) -> str:
        return f"lpad(hex((cast(floor((cast(e as double) + 1) * 127.5D) as bigint) + {shift}) % 256), 2, '0')"

    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id as image_id", f"{TILE} as height", f"{TILE} as width", "3 as nChannels",
        f"""unhex(array_join(transform(embedding,
              e -> concat({byte(0)}, {byte(85)}, {byte(170)})), '')) as data""",
    )


def tile_files(spark: SparkSession, sf_dir: str) -> str:
    """The pictures of `tiles` as files named by product and crop: the folder they are in.

    Some products have a second crop, and some first crops cannot be decoded.
    """
    def named(rows: DataFrame, ordinal: int) -> DataFrame:
        return rows.withColumn("file_name", F.format_string(f"tile_%d_{ordinal}.png", "image_id"))

    folder = fresh_path(spark, "tile-files")
    whole = named(tiles(spark, sf_dir), 0)
    broken = whole.where("image_id % 17 = 0").selectExpr("file_name", "encode('no picture', 'UTF-8') as content")
    content = (encode_png(whole.where("image_id % 17 <> 0")).unionByName(broken)
               .unionByName(encode_png(named(tiles(spark, sf_dir).where("image_id % 3 = 0"), 1))))
    write_binary_files(content, folder).count()
    return folder


def tile_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections small enough for the pictures of `tiles`."""
    return detections(spark, sf_dir).withColumn("bbox", F.expr(
        """array(seq % 8 + 0D, seq * 3 % 8 + 0D,
                 seq % 8 + seq * 5 % 7 + 0D, seq * 3 % 8 + seq * 3 % 5 + 0D)"""))


def page_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a source, which is the kind of host they come from."""
    pages = scan_pages(spark, f"{sf_dir}/pages.parquet")
    kind = F.regexp_extract(host_of(F.col("url")), "^(www|blog|m)[.]", 1)
    return pages.withColumn("source", F.when(kind == "", "bare").otherwise(kind))


# One rule per kind of host: navigation entries, articles or paragraphs.
PAGE_RULES = [
    Rule("www", None, "<li>", "<a [^>]*>([^<]*)</a>", None, None, None, '<a href="([^"]*)"'),
    Rule("blog", None, "<article>", "<h1>([^<]*)</h1>", "([0-9]+)", None, None, None,
         price_prefix="₹"),
    Rule("m", None, "<li>", "<a [^>]*>([^<]*)</a>", None, None, None, '<a href="([^"]*)"',
         max_items=4, keyword="th"),
    Rule("bare", None, "<p>", "^<p>(?:<b>)?([^<.]+)", None, "([0-9]+[.]?[0-9]*)", None, None),
]


def union_inputs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Five tables as five harvests, each with the fields its kind shows."""
    def harvest(of: str, source: str, **fields: str) -> DataFrame:
        shown = [f"{sql} as {field}" for field, sql in fields.items()]
        return table(spark, sf_dir, of).selectExpr(*shown, f"'{source}' as source")

    return [
        harvest("part", "Amazon", name="p_name",
                price="concat('₹', cast(p_size as string))",
                rating="cast(p_size % 5 + 1 as string)",
                product_url="concat('/p/', cast(p_partkey as string))"),
        harvest("supplier", "Flipkart", name="s_name",
                price="concat('₹', cast(s_nationkey as string))",
                rating="cast(s_nationkey % 5 as string)",
                image_url="concat('/i/', cast(s_suppkey as string))"),
        harvest("customer", "Myntra", name="c_name",
                price="concat('₹', cast(c_nationkey as string))", rating="c_mktsegment",
                image_url="concat('/i/', cast(c_custkey as string))"),
        harvest("pages", "Vogue", name="regexp_extract(html, '<title>([^<]*)</title>', 1)",
                product_url="url"),
        harvest("documents", "H&M", name="concat(source, '/', cast(doc_id as string))",
                price="cast(n_chars as string)"),
    ]
