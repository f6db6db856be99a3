"""One named query per operator, each over the whole of the given tables.

Numbers that come from floating point are rounded to six decimals and counts
are `bigint`, so results compare by value with another engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.boxes import padded_box
from shelfwise.functions.scores import popularity
from shelfwise.functions.text import clean_rating, coerce_numeric, optional_link, or_missing
from shelfwise.functions.vectors import cosine
from shelfwise.functions.vectors import flatten
from shelfwise.operators import aggregate, clean, detect, encoders, extract, imaging, inverted_lists, matching, models
from shelfwise.operators import ordinals, pixel_store, recommend, score, similarity, trends, vector_store
from shelfwise.plans import bindings as b
from shelfwise.plans import catalogue, pictures
from shelfwise.schema import IMAGE_METADATA, SEARCH_TERMS, SUMMARY, TRAINING_RATING
from shelfwise.session import fresh_path, materialize, shuffle_partitions
from shelfwise.sinks import files
from shelfwise.sources import frontier, harvest
from shelfwise.sources.images import decode_images, product_of_crop, scan_images
from shelfwise.sources.models import load_model
from shelfwise.sources.pages import host_of, scan_pages
from shelfwise.sources.products import add_default_column, read_products
from shelfwise.streaming.catalogue import CurrentCatalogue, publish, stream_recommend_current
from shelfwise.streaming.dedup import stream_dedup, stream_first_after_gap
from shelfwise.streaming.recommend import stream_recommend

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(key: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[key] = fn
        return fn
    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def r6(column) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def big(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def _clean(spark, sf):
    return clean.clean_products(b.product_raw(spark, sf))


def _vectors(spark, sf):
    return b.table(spark, sf, "embeddings")


def _product_vectors(spark, sf):
    return _vectors(spark, sf).select(F.col("vec_id").alias("product_id"), "embedding", "label")


def _crops(spark, sf):
    return detect.accepted_crops(b.detections(spark, sf), F.lit(b.IMAGE_WIDTH),
                                 F.lit(b.IMAGE_HEIGHT))


# --- sources ---------------------------------------------------------------

@query("read_products")
def _read_products_csv(spark, sf):
    path = fresh_path(spark, "products-csv")
    files.write_csv(b.product_raw(spark, sf), path)
    return read_products(spark, path).withColumn("product_id", big("product_id"))


@query("read_products_by_name")
def _read_products_by_name(spark, sf):
    """Two harvests of which one has its columns in another order, and one column less."""
    path = fresh_path(spark, "products-csv")
    raw = b.product_raw(spark, sf)
    files.write_csv(raw.where("product_id % 2 = 0"), f"{path}/even")
    files.write_csv(raw.where("product_id % 2 = 1").select(*reversed(raw.columns)).drop("no_of_reviews"), f"{path}/odd")
    read = read_products(spark, f"{path}/*/*.csv", by_name=True)
    return read.select(big("product_id").alias("product_id"), "name", "price", "no_of_reviews", "source")


@query("scan_pages")
def _scan_listing_pages(spark, sf):
    pages = scan_pages(spark, f"{sf}/pages.parquet")
    return pages.select("page_id", host_of(F.col("url")).alias("host"),
                        big(F.length("html")).alias("n_chars"))


@query("crawl_frontier")
def _crawl_frontier(spark, sf):
    plan = frontier.full_frontier(b.search_terms(spark, sf))
    return plan.withColumn("page", big("page"))


@query("due_urls")
def _due_urls(spark, sf):
    """First pages were fetched: held, but for one site that failed, at long terms too often."""
    table, path, buckets = f"ledger_{uuid.uuid4().hex}", fresh_path(spark, "ledger"), shuffle_partitions(spark)
    plan = materialize(frontier.crawl_frontier(b.search_terms(spark, sf)), "frontier")
    status = F.when(F.col("site") == "Myntra", "failed").otherwise("ok")
    first = plan.where("page = 1").withColumn("status", status)
    harvest.record_fetches(first, table, path, buckets)
    for _ in range(2):
        harvest.record_fetches(first.where("status = 'failed' and length(term) > 12"), table, path, buckets)
    due = harvest.due_urls(plan, harvest.open_ledger(spark, table, path, buckets))
    return due.select("site", "term", big("page").alias("page"), "url", big("attempts").alias("attempts"))


@query("cross_frontier")
def _cross_frontier(spark, sf):
    return frontier.term_sites(b.search_terms(spark, sf)).select("term", "site", "paged")


@query("load_model")
def _load_model(spark, sf):
    """A line fitted on one feature, saved, loaded and applied."""
    path = fresh_path(spark, "model")
    scored = score.score_popularity(catalogue.product_table(b.product_raw(spark, sf)),
                                    TRAINING_RATING)
    rows = models.with_features(matching.join_products_images(
        scored, _product_vectors(spark, sf)).select(
        "product_id", "popularity", F.array(F.col("label").cast("double")).alias("embedding")))
    files.save_model(models.fit_popularity(rows, kind="linear"), path)
    predicted = models.predict_popularity(rows, load_model(path))
    return predicted.select("product_id", r6("predicted").alias("predicted"))


# --- extraction ------------------------------------------------------------

def _rules(spark):
    return extract.rules_table(spark, b.PAGE_RULES)


@query("explode_items")
def _explode_items(spark, sf):
    items = extract.explode_items(b.page_sources(spark, sf), _rules(spark))
    return items.select("page_id", "source", big("pos").alias("pos"),
                        big(F.length("item")).alias("n_chars"))


@query("skipped_pages")
def _skipped_pages(spark, sf):
    some = extract.rules_table(spark, [r for r in b.PAGE_RULES if r.source != "m"])
    return extract.skipped_pages(b.page_sources(spark, sf), some).select("page_id", "source", "reason")


@query("extract_fields")
def _extract_fields(spark, sf):
    items = extract.explode_items(b.page_sources(spark, sf), _rules(spark))
    return extract.extract_fields(items).select(
        "page_id", "source", big("pos").alias("pos"), "name", "price", "rating",
        "image_url", "product_url")


@query("limit_then_keyword")
def _limit_then_keyword(spark, sf):
    records = extract.harvest(b.page_sources(spark, sf), _rules(spark))
    return records.select("page_id", "source", big("pos").alias("pos"), "name", "product_url")


@query("resolve_url")
def _resolve_url(spark, sf):
    links = extract.page_links(scan_pages(spark, f"{sf}/pages.parquet"))
    return links.select("page_id", big("pos").alias("pos"), "href", "link")


@query("bad_record_isolation")
def _bad_record_isolation(spark, sf):
    raw = b.product_raw(spark, sf)
    tagged = clean.tag_bad_records(raw, {
        "no name": F.col("name") != "N/A",
        "no price": F.col("price") != "N/A",
        "no rating": clean_rating(F.col("rating")).isNotNull(),
        "no image": F.col("image_url").startswith("http"),
    })
    return tagged.select("product_id", "reject_reason")


@query("broadcast_rules")
def _broadcast_rules(spark, sf):
    ruled = extract.with_rules(b.page_sources(spark, sf), _rules(spark))
    return ruled.select("page_id", "source", "rule_item", big("rule_max_items").alias("max_items"))


# --- projections and filters -----------------------------------------------

@query("filter_named")
def _filter_named(spark, sf):
    return clean.filter_named(b.product_raw(spark, sf)).select("product_id", "name", "source")


@query("image_manifest")
def _image_manifest(spark, sf):
    return clean.image_manifest(b.product_raw(spark, sf))


@query("filter_detections")
def _filter_detections(spark, sf):
    kept = detect.filter_detections(b.detections(spark, sf))
    return kept.select("image_id", "seq", "class_name", "confidence")


@query("filter_nonempty_crop")
def _filter_nonempty_crop(spark, sf):
    boxed = detect.crop_boxes(b.detections(spark, sf), F.lit(b.IMAGE_WIDTH),
                              F.lit(b.IMAGE_HEIGHT), padding=0)
    return boxed.select("image_id", "seq", "box.x1", "box.y1", "box.x2", "box.y2")


def _flawed_vectors(spark, sf):
    """Vectors of which some hold NaN or infinity, with some scores missing."""
    return _vectors(spark, sf).selectExpr(
        "vec_id", "label",
        """transform(embedding, (x, i) -> cast(case
             when vec_id % 7 = 0 and i = vec_id % 64 then 'NaN'
             when vec_id % 11 = 0 and i = vec_id % 64 then '-Infinity'
             else x end as float)) as embedding""",
        "case when vec_id % 13 = 0 then null else cast(label as double) end as score")


@query("finite_vectors")
def _finite_vectors(spark, sf):
    return similarity.finite_vectors(_flawed_vectors(spark, sf)).select("vec_id", "label")


@query("filter_finite")
def _filter_finite(spark, sf):
    kept = similarity.finite_vectors(_flawed_vectors(spark, sf), score="score")
    return kept.select("vec_id", "score")


@query("valid_only")
def _valid_only(spark, sf):
    valid = matching.products_with_images(_clean(spark, sf), _product_vectors(spark, sf))
    return valid.select("product_id", "name", "rating")


@query("add_default_column")
def _add_default_reviews(spark, sf):
    harvested = b.product_raw(spark, sf).drop("no_of_reviews")
    full = add_default_column(harvested, "no_of_reviews", 10)
    return full.select("product_id", big("no_of_reviews").alias("no_of_reviews"))


@query("optional_link")
def _optional_product_link(spark, sf):
    raw = b.product_raw(spark, sf)
    return raw.select("product_id", optional_link(F.col("product_url")).alias("link"))


# --- joins -----------------------------------------------------------------

@query("join_products_images")
def _join_products_images(spark, sf):
    parts = b.table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), "p_name")
    joined = matching.join_products_images(parts, _product_vectors(spark, sf))
    return joined.select("product_id", "p_name", "label")


@query("semi_products_with_images")
def _semi_products_with_images(spark, sf):
    parts = b.table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), "p_name")
    return matching.products_with_images(parts, _product_vectors(spark, sf))


@query("anti_failed_images")
def _anti_failed_images(spark, sf):
    return detect.failed_images(b.input_images(spark, sf), detect.processed_images(b.image_status(spark, sf)))


@query("cross_query_catalogue")
def _cross_query_catalogue(spark, sf):
    vectors = _vectors(spark, sf)
    centers = trends.centroids(vectors, "label")
    scores = similarity.similarity_scores(centers, vectors, query_key="label",
                                          candidate_key="vec_id")
    return scores.select(F.col("query_id").alias("label"), F.col("candidate_id").alias("vec_id"),
                         "similarity")


@query("join_scalar_stats")
def _join_scalar_stats(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    scaled = score.scale_minmax(orders, "o_totalprice", "scaled")
    return scaled.select("o_orderkey", r6("scaled").alias("scaled"))


# --- aggregations ----------------------------------------------------------

@query("source_counts")
def _source_counts(spark, sf):
    return aggregate.source_counts(_clean(spark, sf))


@query("total_count")
def _total_count(spark, sf):
    return aggregate.total_count(_clean(spark, sf))


@query("minmax_stats")
def _minmax_stats(spark, sf):
    scored = score.score_popularity(_clean(spark, sf), TRAINING_RATING, scale=False)
    return score.minmax_stats(scored, "popularity").select(
        r6("low").alias("low"), r6("high").alias("high"))


@query("detection_totals")
def _detection_totals(spark, sf):
    return detect.detection_totals(b.input_images(spark, sf), detect.processed_images(b.image_status(spark, sf)),
                                   _crops(spark, sf))


@query("detections_per_image")
def _detections_per_image(spark, sf):
    numbered = detect.crop_ordinal(_crops(spark, sf))
    docs = detect.detections_per_image(b.detected_images(spark, sf), numbered, chunk_size=16)
    listed = F.array_join(F.transform("detections", lambda d: F.concat(
        d["class_name"], F.lit("@"), big(F.round(d["confidence"] * 100)).cast("string"))), ",")
    return docs.select("image_id", "chunk", "cropped_count", listed.alias("detections"))


@query("summary_document")
def _summary_document(spark, sf):
    doc = aggregate.summary_document(_clean(spark, sf), SEARCH_TERMS, stamped=False)
    return doc.select("total_products", F.to_json("sources").alias("sources"),
                      F.to_json("search_terms").alias("search_terms"))


@query("dedup_products")
def _dedup_products(spark, sf):
    kept = clean.dedup_products(b.product_raw(spark, sf))
    return kept.select("product_id", "name", "source")


@query("image_stats")
def _image_stats(spark, sf):
    stats = imaging.image_stats(b.tiles(spark, sf))
    names = ["mean_blue", "mean_green", "mean_red", "brightness"]
    return stats.select("image_id", big("width").alias("width"), big("height").alias("height"),
                        "aspect_ratio", "area", *[r6(n).alias(n) for n in names])


@query("regression_metrics")
def _regression_metrics(spark, sf):
    scored = score.score_popularity(catalogue.product_table(b.product_raw(spark, sf)),
                                    TRAINING_RATING)
    guess = scored.groupBy("source").agg(F.avg("popularity").alias("prediction"))
    errors = aggregate.regression_metrics(scored.join(guess, "source"), "popularity")
    return errors.select(r6("mse").alias("mse"), r6("mae").alias("mae"))


@query("centroids")
def _centroids(spark, sf):
    means = trends.centroids(_vectors(spark, sf), "label")
    return means.select("label", F.posexplode("embedding").alias("pos", "mean")).select(
        "label", big("pos").alias("pos"), r6("mean").alias("mean"))


# --- ordinals and rankings -------------------------------------------------

@query("crop_ordinal")
def _crop_ordinal(spark, sf):
    return detect.crop_ordinal(_crops(spark, sf)).select("image_id", "seq", "crop_ordinal")


@query("first_crop")
def _first_crop(spark, sf):
    return detect.first_crop(_crops(spark, sf)).select("image_id", "seq", "class_name")


@query("running_totals")
def _running_totals(spark, sf):
    found = F.regexp_count("html", F.lit("<a href="))
    counted = b.page_sources(spark, sf).select("page_id", "source", big(found).alias("n"))
    total = ordinals.running_total(counted, "n", ["page_id"], name="total_so_far")
    return total.select("page_id", "source", "n", "total_so_far")


@query("running_totals_by_source")
def _running_totals_by_source(spark, sf):
    found = F.regexp_count("html", F.lit("<a href="))
    counted = b.page_sources(spark, sf).select("page_id", "source", big(found).alias("n"))
    return ordinals.group_running_total(counted, "n", ["page_id"], ["source"], "source_total")


@query("crop_ordinal_of_heavy_images")
def _crop_ordinal_of_heavy_images(spark, sf):
    return ordinals.group_ordinal(_crops(spark, sf), ["image_id"], [F.col("seq")], "crop_ordinal",
                                  heavy_rows=3).select("image_id", "seq", "crop_ordinal")


@query("running_totals_of_heavy_sources")
def _running_totals_of_heavy_sources(spark, sf):
    found = F.regexp_count("html", F.lit("<a href="))
    counted = b.page_sources(spark, sf).select("page_id", "source", big(found).alias("n"))
    return ordinals.group_running_total(counted, "n", [F.desc("page_id")], ["source"], "source_total", heavy_rows=5)


@query("row_ordinal")
def _row_ordinal(spark, sf):
    events = b.table(spark, sf, "events").select("user_id", "event_id")
    return ordinals.row_ordinal(events, ["user_id", "event_id"])


@query("rank_by_popularity")
def _rank_by_popularity(spark, sf):
    ranked = score.score_popularity(catalogue.product_table(b.product_raw(spark, sf)),
                                    TRAINING_RATING)
    numbered = ordinals.row_ordinal(
        ranked.select("product_id", "name", "popularity"),
        [F.desc("popularity"), F.asc("product_id")], name="rank")
    return numbered.withColumn("popularity", r6("popularity"))


@query("topk_similar")
def _topk_similar(spark, sf):
    vectors = _vectors(spark, sf).select("vec_id", "embedding")
    hits = similarity.topk_similar(vectors, vectors, 5, query_key="vec_id",
                                   candidate_key="vec_id", exclude_self=True)
    return hits.withColumn("rank", big("rank"))


@query("topk_similar_grid")
def _topk_similar_grid(spark, sf):
    """Limits so small that both sides count as large and are cut into blocks."""
    vectors = _vectors(spark, sf).select("vec_id", "embedding")
    hits = similarity.topk_similar(vectors, vectors, 5, query_key="vec_id", candidate_key="vec_id",
                                   exclude_self=True, broadcast_rows=16, block_rows=100)
    return hits.withColumn("rank", big("rank"))


@query("topk_similar_few_queries")
def _topk_similar_few_queries(spark, sf):
    """A catalogue that counts as large, streamed past few queries."""
    vectors = _vectors(spark, sf)
    hits = similarity.topk_similar(trends.centroids(vectors, "label"), vectors, 5, query_key="label",
                                   candidate_key="vec_id", broadcast_rows=64)
    return hits.withColumn("rank", big("rank"))


@query("topk_by_lists")
def _topk_by_lists(spark, sf):
    """The catalogue in inverted lists, of which each query sees as many as a trial asked for."""
    vectors = _vectors(spark, sf).select("vec_id", "embedding")
    hits = inverted_lists.topk_by_lists(vectors, inverted_lists.build_lists(vectors, "vec_id"), 5,
                                        query_key="vec_id", exclude_self=True)
    return hits.withColumn("rank", big("rank"))


@query("topk_by_all_lists")
def _topk_by_all_lists(spark, sf):
    """Every list is looked into: the rows of the exact form, by way of tiles and blocks."""
    vectors = _vectors(spark, sf).select("vec_id", "embedding")
    lists = inverted_lists.build_lists(vectors, "vec_id", lists=8, tile_rows=50)
    hits = inverted_lists.topk_by_lists(vectors, lists, 5, probes=lists.count, query_key="vec_id",
                                        exclude_self=True, block_rows=100)
    return hits.withColumn("rank", big("rank"))


@query("sample_head")
def _sample_head(spark, sf):
    return clean.sample_head(_clean(spark, sf), ["product_id"]).select("product_id", "name")


@query("union_sources")
def _union_sources(spark, sf):
    return clean.union_sources(*b.union_inputs(spark, sf)).select(
        "name", *[or_missing(F.col(c)).alias(c)
                  for c in ("price", "rating", "image_url", "product_url")], "source")


# --- scalars ---------------------------------------------------------------

@query("clean_products")
def _clean_products(spark, sf):
    return _clean(spark, sf).select("product_id", "name", "price", "rating", "no_of_reviews",
                                       "image_url", "source")


@query("coerce_scores")
def _coerce_scores(spark, sf):
    numbers = score.coerce_scores(b.product_raw(spark, sf), TRAINING_RATING)
    return numbers.select("product_id", "rating", "no_of_reviews")


@query("coerce_numeric")
def _coerce_event_values(spark, sf):
    events = b.table(spark, sf, "events")
    return events.select("event_id", coerce_numeric(clean_rating(F.col("props")), 3.0).alias("r"))


@query("popularity_metric")
def _popularity_metric(spark, sf):
    lines = b.table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("s"))
    return lines.select("l_partkey", r6(popularity(F.col("n"), F.col("s"))).alias("popularity"))


@query("popularity")
def _popularity_score(spark, sf):
    scored = score.score_popularity(catalogue.product_table(b.product_raw(spark, sf)),
                                    TRAINING_RATING)
    return scored.select("product_id", F.col("no_of_reviews").alias("n"),
                         F.col("rating").alias("s"), r6("popularity").alias("popularity"))


@query("pad_and_clip_box")
def _pad_and_clip_box(spark, sf):
    box = padded_box(F.col("bbox"), F.lit(b.IMAGE_WIDTH), F.lit(b.IMAGE_HEIGHT))
    return b.detections(spark, sf).select("image_id", "seq", box.alias("box")).select(
        "image_id", "seq", "box.x1", "box.y1", "box.x2", "box.y2")


@query("crop_boxes")
def _crop_boxes(spark, sf):
    numbered = detect.crop_ordinal(_crops(spark, sf))
    return numbered.select("image_id", "seq", "class_name", "box.x1", "box.y1", "box.x2",
                           "box.y2", "crop_ordinal")


@query("cosine_pairs")
def _cosine_pairs(spark, sf):
    vectors = _vectors(spark, sf).select("vec_id", "embedding")
    after = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return vectors.join(after, "vec_id").select(
        "vec_id", r6(cosine(F.col("embedding"), F.col("next"))).alias("similarity"))


@query("expand_vector")
def _expand_vector(spark, sf):
    wide = similarity.expand_vector(_vectors(spark, sf).select("vec_id", "embedding"), 64)
    return wide.select("vec_id", *[F.col(f"feature_{i}").cast("double").alias(f"feature_{i}")
                                   for i in range(64)])


# --- images ----------------------------------------------------------------

def _tile_crops(spark, sf):
    crops = detect.accepted_crops(b.tile_detections(spark, sf), F.lit(b.TILE), F.lit(b.TILE),
                                  padding=1)
    return detect.crop_ordinal(crops)


@query("crop_images")
def _crop_images(spark, sf):
    cut = imaging.crop_images(b.tiles(spark, sf), _tile_crops(spark, sf))
    return cut.select("image_id", "crop_ordinal", big("height").alias("height"),
                      big("width").alias("width"), F.hex("data").alias("data"))


@query("crop_stored_images")
def _crop_stored_images(spark, sf):
    buckets = shuffle_partitions(spark)
    store = pixel_store.write_pixel_store(b.tiles(spark, sf), f"tiles_{uuid.uuid4().hex}",
                                          fresh_path(spark, "pixels"), buckets)
    cut = pixel_store.crop_stored_images(store, materialize(_tile_crops(spark, sf), "boxes"), buckets)
    return cut.select("image_id", "crop_ordinal", big("height").alias("height"),
                      big("width").alias("width"), F.hex("data").alias("data"))


@query("scan_images")
def _scan_images(spark, sf):
    found = scan_images(spark, b.tile_files(spark, sf))
    key = product_of_crop(F.col("file_name"))
    return found.select("file_name", key["product_id"].alias("product_id"), key["crop_ordinal"].alias("crop_ordinal"))


@query("decode_images")
def _decode_images(spark, sf):
    found = decode_images(spark, b.tile_files(spark, sf))
    return found.select("file_name", "status", big("height").alias("height"), big("width").alias("width"),
                        F.hex("data").alias("data"))


@query("first_crop_vectors")
def _first_crop_vectors(spark, sf):
    found = pictures.product_pictures(spark, b.tile_files(spark, sf), imaging.flat_encoder, b.TILE, b.TILE)
    total = F.aggregate(F.col("embedding"), F.lit(0.0), lambda a, x: a + x)
    return found.status.join(found.vectors, "product_id", "left").select(
        "file_name", "status", "product_id", r6(total).alias("total"))


@query("training_rows_from_pictures")
def _training_rows_from_pictures(spark, sf):
    products = catalogue.product_table(b.product_raw(spark, sf))
    rows = pictures.training_rows_from_pictures(products, b.tile_files(spark, sf), imaging.flat_encoder, b.TILE, b.TILE)
    total = F.aggregate(F.col("embedding"), F.lit(0.0), lambda a, x: a + x)
    return rows.select("product_id", r6("popularity").alias("popularity"), r6(total).alias("total"), "is_train")


@query("refresh_vectors")
def _refresh_vectors(spark, sf):
    """All tiles but some, then all of them, some with other pixels, then the same again."""
    store, tiles = fresh_path(spark, "vectors"), b.tiles(spark, sf)
    turned = F.concat(F.substring("data", 2, 1 << 20), F.substring("data", 1, 1))
    now = tiles.withColumn("data", F.when(F.col("image_id") % 5 == 0, turned).otherwise(F.col("data")))
    for images in (tiles.where("image_id % 7 <> 3"), now, now):
        vector_store.refresh_vectors(images, store, "flat", imaging.flat_encoder, b.TILE, b.TILE)
    rows = vector_store.stored_vectors(spark, store, "flat")
    first = rows.agg(F.min("run")).scalar()
    return rows.select("image_id", big(F.when(F.col("run") == first, 1).otherwise(2)).alias("run"),
                       r6(F.get("embedding", F.lit(0)).cast("double")).alias("first_value"))


@query("embed_images")
def _embed_images(spark, sf):
    vectors = imaging.embed_images(b.tiles(spark, sf), imaging.flat_encoder, b.TILE, b.TILE)
    values = vectors.select("image_id", F.posexplode("embedding").alias("pos", "value"))
    return values.select("image_id", big("pos").alias("pos"),
                         r6(F.col("value").cast("double")).alias("value"))


@query("embed_images_grid")
def _embed_images_grid(spark, sf):
    # A tile grows a thousandfold when it is resized: spread them before that.
    vectors = imaging.embed_images(b.tiles(spark, sf), partitions=shuffle_partitions(spark))
    return vectors.select("image_id", big(F.size("embedding")).alias("width"),
                          r6(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)).alias("total"))


@query("fit_embedding")
def _fit_embedding(spark, sf):
    vectors = _vectors(spark, sf)
    model = models.fit_embedding(vectors, 8)
    return models.encode(vectors, model).select("vec_id", F.to_json("encoded").alias("encoded"))


@query("reconstruction_error")
def _reconstruction_error(spark, sf):
    vectors = _vectors(spark, sf)
    model = models.fit_embedding(vectors, 8)
    return models.reconstruction_error(vectors, model, "vec_id").select(
        "vec_id", r6("mse").alias("mse"))


@query("fit_image_encoder")
def _fit_image_encoder(spark, sf):
    tiles = b.tiles(spark, sf)
    encoder = encoders.fit_image_encoder(tiles, 8, b.TILE, b.TILE)
    restored = encoders.image_errors(tiles, encoder, b.TILE, b.TILE)
    return imaging.embed_images(tiles, encoder, b.TILE, b.TILE).join(restored, "image_id").select(
        "image_id", big(F.size("embedding")).alias("width"), r6("mse").alias("mse"))


@query("flatten")
def _flatten(spark, sf):
    rows = F.transform(F.sequence(F.lit(0), F.lit(b.TILE - 1)), lambda i: F.slice("embedding", i * b.TILE + 1, b.TILE))
    flat = flatten(F.transform(rows, lambda row: F.reverse(row)))
    return _vectors(spark, sf).select("vec_id", F.posexplode(flat).alias("pos", "value")).select(
        "vec_id", big("pos").alias("pos"), F.col("value").cast("double").alias("value"))


# --- models ----------------------------------------------------------------

def _training_rows(spark, sf):
    products = catalogue.product_table(b.product_raw(spark, sf))
    return catalogue.training_rows(products, _product_vectors(spark, sf))


@query("positional_split")
def _positional_split(spark, sf):
    vectors = _vectors(spark, sf).select("vec_id", "label")
    return models.positional_split(vectors, ["vec_id"])


@query("fit_popularity")
def _fit_popularity(spark, sf):
    rows = _training_rows(spark, sf)
    model = models.fit_popularity(rows.where("is_train"))
    scored = models.predict_popularity(rows, model)
    return aggregate.regression_metrics(scored, "popularity", "predicted", by=["is_train"])


@query("predict_popularity")
def _predict_popularity(spark, sf):
    rows = _training_rows(spark, sf)
    model = models.fit_popularity(rows.where("is_train"), kind="linear", regParam=0.1)
    every = models.with_features(_product_vectors(spark, sf))
    return models.predict_popularity(every, model).select("product_id", "predicted")


@query("early_stopping")
def _early_stopping(spark, sf):
    rows = _training_rows(spark, sf)
    rows = rows.withColumn("held_out", ~F.col("is_train"))
    model = models.fit_popularity(rows, validation="held_out", maxIter=20)
    scored = models.predict_popularity(rows, model).withColumn(
        "trees", F.lit(models.kept_trees(model)))
    return aggregate.regression_metrics(scored, "popularity", "predicted", by=["held_out", "trees"])


@query("cluster_products")
def _cluster_products(spark, sf):
    vectors = _vectors(spark, sf)
    model = trends.fit_clusters(vectors, 5)
    clustered = trends.cluster_products(vectors, model)
    return clustered.select("vec_id", "cluster")


@query("trend_labels")
def _trend_labels(spark, sf):
    return trends.trend_labels(_vectors(spark, sf), "label")


@query("assign_nearest")
def _assign_nearest(spark, sf):
    vectors = _vectors(spark, sf).select("vec_id", "embedding", "label")
    centers = trends.centroids(vectors, "label")
    return trends.assign_nearest(vectors, centers, "vec_id", "label")


# --- recommendations -------------------------------------------------------

def _serving(spark, sf):
    products = materialize(_clean(spark, sf).select("product_id", "name", "rating"), "products")
    return recommend.serving_catalogue(products, _product_vectors(spark, sf))


@query("project_result")
def _project_result(spark, sf):
    shown = _serving(spark, sf)
    centers = trends.centroids(_vectors(spark, sf), "label")
    hits = similarity.topk_similar(centers, shown, 5, query_key="label", candidate_key="product_id")
    found = recommend.project_result(hits, shown)
    return found.select(F.col("query_id").alias("label"), big("rank").alias("rank"), "product_id",
                        "name", "rating", "similarity")


@query("recommend")
def _recommend_similar(spark, sf):
    found = recommend.recommend(_vectors(spark, sf), _serving(spark, sf), query_key="vec_id")
    return found.select("query_id", big("rank").alias("rank"), "product_id", "name", "rating",
                        "similarity")


@query("recommend_with_popularity")
def _recommend_with_popularity(spark, sf):
    rows = _training_rows(spark, sf)
    model = models.fit_popularity(rows, kind="linear", regParam=0.1)
    products = materialize(_clean(spark, sf).select("product_id", "name", "rating"), "products")
    shown = materialize(recommend.serving_catalogue(
        products, _product_vectors(spark, sf), model=model), "serving")
    found = recommend.recommend(_vectors(spark, sf), shown, query_key="vec_id", model=model)
    return found.select("query_id", "rank", "product_id", "name", "rating", "similarity",
                        "popularity", "query_popularity")


# --- streams ---------------------------------------------------------------

def _stream(spark, sf, name):
    """A table as a file stream; the pattern fits one file and a folder alike."""
    schema = b.table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parquet*")


@query("stream_recommend")
def _stream_recommend_similar(spark, sf):
    vectors = _vectors(spark, sf).select("vec_id", "embedding")
    out, state = fresh_path(spark, "stream-hits"), fresh_path(spark, "stream-state")
    stream_recommend(_stream(spark, sf, "embeddings"), vectors, out, state, query_key="vec_id",
                     candidate_key="vec_id", exclude_self=True).awaitTermination()
    return spark.read.parquet(out).select("query_id", big("rank").alias("rank"), "candidate_id",
                                          "similarity")


@query("stream_dedup")
def _stream_dedup_events(spark, sf):
    out, state = fresh_path(spark, "stream-kept"), fresh_path(spark, "stream-state")
    source = fresh_path(spark, "stream-events")
    events = b.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    for part in [*(F.col("event_id") % 4 == i for i in range(-3, 4)), F.col("event_id").isNull()]:
        rows = events.where(part)
        if rows.isEmpty():
            continue
        rows.write.mode("append").parquet(source)  # new files are a micro-batch of the resumed stream
        stream = spark.readStream.schema(events.schema).parquet(source)
        stream_dedup(stream, out, state, ["user_id", "event_type"], ["event_id"], buckets=8).awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("stream_first_after_gap")
def _stream_first_after_gap(spark, sf):
    """Quarters of the events by time, each a run of its own that resumes from the checkpoint."""
    events = b.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    ends = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).select(F.struct("low", "high")).scalar()
    at = F.col("ts").cast("double")
    share = (at - ends["low"].cast("double")) / (ends["high"].cast("double") - ends["low"].cast("double"))
    parts = fresh_path(spark, "stream-quarters")
    events.withColumn("quarter", F.least(F.floor(share * 4), F.lit(3)).cast("int")).write.partitionBy("quarter").parquet(parts)
    source, out, state = (fresh_path(spark, n) for n in ("stream-events", "stream-gaps", "stream-state"))
    held = spark.read.parquet(parts)
    for quarter in range(4):
        held.where(F.col("quarter") == quarter).drop("quarter").write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        stream_first_after_gap(stream, out, state, ["user_id", "event_type"], "ts", "event_id", 6 * 3600).awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("stream_recommend_current")
def _stream_recommend_current(spark, sf):
    """Half of the queries against a first catalogue, the others after it was replaced."""
    vectors = _vectors(spark, sf).select("vec_id", "embedding")
    store, source, out, state = (fresh_path(spark, n) for n in ("catalogue", "queries", "stream-hits", "stream-state"))
    current = CurrentCatalogue(spark, store, "vec_id")
    for turn in range(2):
        publish(vectors.where(F.col("vec_id") % 2 == turn), store)
        vectors.where(F.floor(F.col("vec_id") / 2) % 2 == turn).write.mode("append").parquet(source)
        stream = spark.readStream.schema(vectors.schema).parquet(source)
        stream_recommend_current(stream, current, out, state, query_key="vec_id").awaitTermination()
    return spark.read.parquet(out).select("query_id", big("rank").alias("rank"), "candidate_id", "similarity",
                                          big("catalogue_version").alias("catalogue_version"))


# --- sinks -----------------------------------------------------------------

@query("write_ranked_csv")
def _write_ranked_csv(spark, sf):
    path = fresh_path(spark, "ranked-csv")
    ranked = catalogue.ranked_products(b.product_raw(spark, sf))
    files.write_csv(ranked.select("product_id", "name", r6("popularity").alias("popularity")), path)
    return read_products(spark, path).select(
        big("product_id").alias("product_id"), "name",
        F.col("popularity").cast("double").alias("popularity"))


@query("write_summary_json")
def _write_summary_json(spark, sf):
    path = fresh_path(spark, "summary-json")
    files.write_json(aggregate.summary_document(_clean(spark, sf), SEARCH_TERMS), path)
    back = spark.read.schema(SUMMARY).json(path)
    return back.select("total_products", F.explode("sources").alias("source", "n"),
                       big(F.size("search_terms")).alias("n_terms"))


@query("write_metadata_json")
def _write_metadata_json(spark, sf):
    path = fresh_path(spark, "metadata-json")
    numbered = detect.crop_ordinal(_crops(spark, sf))
    docs = detect.detections_per_image(b.detected_images(spark, sf), numbered)
    named = docs.withColumn("original_image", F.concat(F.col("image_id").cast("string"),
                                                       F.lit(".jpg")))
    files.write_json(named.select("original_image", "detections", "cropped_count", "chunk"), path)
    schema = T.StructType([*IMAGE_METADATA, T.StructField("chunk", T.LongType())])
    back = spark.read.schema(schema).json(path)
    return back.select("original_image", "cropped_count", "chunk",
                       F.inline_outer("detections")).select(
        "original_image", "cropped_count", "class_name", "confidence",
        F.element_at("bbox", 1).alias("x1"))


@query("write_crops")
def _write_crops(spark, sf):
    path = fresh_path(spark, "crops")
    files.write_table(imaging.crop_images(b.tiles(spark, sf), _tile_crops(spark, sf)), path)
    back = spark.read.parquet(path)
    return back.groupBy("image_id").agg(F.count(F.lit(1)).alias("crops"),
                                        F.sum(big(F.length("data"))).alias("bytes"))


@query("write_features")
def _write_features(spark, sf):
    path = fresh_path(spark, "features")
    image = F.concat(F.lit("tile_"), F.col("vec_id").cast("string"), F.lit("_0.jpg"))
    files.write_table(_vectors(spark, sf).select(image.alias("image_path"), "embedding"), path)
    back = spark.read.parquet(path)
    return back.select("image_path", big(F.size("embedding")).alias("width"),
                       F.get("embedding", F.lit(0)).cast("double").alias("feature_0"),
                       F.get("embedding", F.lit(63)).cast("double").alias("feature_63"))
