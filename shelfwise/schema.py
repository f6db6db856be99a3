"""Record types and the fixed values that define the data model."""

from pyspark.sql import types as T

PRODUCT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("product_url", T.StringType()),
    T.StructField("source", T.StringType()),
])

DETECTION = T.StructType([
    T.StructField("class_name", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("bbox", T.ArrayType(T.DoubleType())),
])

IMAGE_METADATA = T.StructType([
    T.StructField("original_image", T.StringType()),
    T.StructField("detections", T.ArrayType(DETECTION)),
    T.StructField("cropped_count", T.LongType()),
])

SUMMARY = T.StructType([
    T.StructField("total_products", T.LongType()),
    T.StructField("sources", T.MapType(T.StringType(), T.LongType())),
    T.StructField("scraping_timestamp", T.StringType()),
    T.StructField("search_terms", T.ArrayType(T.StringType())),
])

# Pixel rows: the fields of Spark's `image` source plus a key.
IMAGE = T.StructType([
    T.StructField("image_id", T.LongType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("nChannels", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
])

# Fixed value: the text that stands for a missing field in harvested records.
MISSING = "N/A"

# The tokens a CSV reader of the pandas family takes as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Words that mark a detected class as apparel, and the class of
# people, who are taken to wear some.
APPAREL_KEYWORDS = ["shirt", "top", "clothing", "tshirt", "blouse", "jersey"]
PERSON_CLASS = "person"

# Acceptance threshold, box padding, and defaults.
MIN_CONFIDENCE = 0.3
BOX_PADDING = 20
TRAINING_RATING = 3.0
SERVING_RATING = 0.0
DEFAULT_REVIEWS = 10

# File endings taken as images; the flat listing knows no gif.
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "gif", "bmp"]
FLAT_IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "bmp"]

# The search terms of a full harvest.
SEARCH_TERMS = [
    "mens shirts", "womens dresses", "casual wear", "formal wear", "summer collection",
]
