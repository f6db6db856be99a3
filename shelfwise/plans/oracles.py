"""The same queries in ANSI SQL, for an independent engine."""

from __future__ import annotations

RAW = """
rv as (select l_partkey k, count(*) n from lineitem group by l_partkey),
product_raw as (
  select p_partkey product_id,
    case when p_partkey % 50 = 0 then 'N/A' else p_name end as name,
    case when p_partkey % 13 = 0 then 'N/A'
      else concat('₹1,', cast(p_partkey % 900 + 100 as varchar)) end as price,
    case p_partkey % 6 when 0 then 'N/A'
      when 1 then concat(cast(1 + p_partkey % 4 as varchar), '.', cast(p_partkey % 10 as varchar), ' out of 5 stars')
      when 2 then concat(cast(1 + p_partkey % 4 as varchar), '.', cast(p_partkey % 10 as varchar))
      when 3 then cast(1 + p_partkey % 5 as varchar) when 4 then '' else null end as rating,
    case p_partkey % 11 when 0 then null when 1 then 'n/a' else cast(n as varchar) end as no_of_reviews,
    case p_partkey % 7 when 0 then null when 1 then 'N/A'
      when 2 then concat('ftp://img.example.com/', cast(p_partkey as varchar))
      else concat('https://img.example.com/', cast(p_partkey as varchar), '.jpg') end as image_url,
    case p_partkey % 4 when 0 then null when 1 then 'N/A'
      else concat('https://shop.example.com/p/', cast(p_partkey as varchar)) end as product_url,
    case p_partkey % 5 when 0 then 'Amazon' when 1 then 'Flipkart' when 2 then 'Myntra'
      when 3 then 'H&M' else 'Vogue' end as source
  from part left join rv on p_partkey = k)"""

CLEAN = RAW + """,
product_clean as (
  select product_id, name, replace(price, ',', '') price,
    nullif(regexp_extract(rating, '([0-9]+[.]?[0-9]*)', 1), '') rating,
    no_of_reviews, image_url, product_url, source
  from (select *, row_number() over (partition by name, source order by product_id) rn
        from product_raw) d
  where rn = 1 and name <> 'N/A')"""

SCORED = CLEAN + """,
c as (select product_id, name, source, coalesce(try_cast(rating as double), 3.0::double) s,
        cast(trunc(coalesce(try_cast(no_of_reviews as double), 10)) as bigint) n
      from product_clean),
m as (select *, s * (15 + n) / (n + 5 * s + 1e-5::double) pop from c),
x as (select min(pop) lo, max(pop) hi from m),
scored as (select product_id, name, source, s, n, pop,
             case when hi = lo then 0::double else (pop - lo) / (hi - lo) end popularity
           from m cross join x)"""

DET = """
det as (
  select user_id image_id, event_id seq,
    case event_id % 6 when 0 then 'person' when 1 then 'T-Shirt' when 2 then 'laptop'
      when 3 then 'car' when 4 then 'Blouse' else 'dog' end class_name,
    (event_id * 37 % 101) / 100::double confidence,
    (event_id * 13 % 640) + 0.5::double x1, (event_id * 29 % 480) + 0.5::double y1,
    (event_id * 7 % 200) bw, (event_id * 11 % 200) bh
  from events)"""

MATCH = "regexp_matches(lower(class_name), 'shirt|top|clothing|tshirt|blouse|jersey|person') and confidence > 0.3"


def _box(pad: int, width: int = 640, height: int = 480) -> str:
    return f"""greatest(0, cast(trunc(x1 - {pad}) as int)) x1, greatest(0, cast(trunc(y1 - {pad}) as int)) y1,
      least({width}, cast(trunc(x1 + bw + {pad}) as int)) x2, least({height}, cast(trunc(y1 + bh + {pad}) as int)) y2"""


CROPS = DET + f""",
crops as (
  select *, row_number() over (partition by image_id order by seq) - 1 crop_ordinal
  from (select image_id, seq, class_name, confidence, x1 raw_x1, {_box(20)} from det where {MATCH}) d
  where x2 > x1 and y2 > y1)"""

CENTERS = """
means as (
  select label, pos, avg(x::double) m
  from (select label, unnest(embedding) x, generate_subscripts(embedding, 1) pos from embeddings) e
  group by label, pos),
centers as (select label, list(m order by pos) v from means group by label)"""

SOURCES = """
pg as (
  select page_id, url, html,
    case when regexp_matches(url, '^[a-z]+://www[.]') then 'www'
      when regexp_matches(url, '^[a-z]+://blog[.]') then 'blog'
      when regexp_matches(url, '^[a-z]+://m[.]') then 'm' else 'bare' end source
  from pages)"""

ITEMS = SOURCES + """,
marked as (
  select *, case source when 'blog' then '<article>' when 'bare' then '<p>' else '<li>' end mark
  from pg),
pieces as (select *, string_split(html, mark)[2:] parts from marked),
uncut as (
  select page_id, url, source, replace(mark, '<', '</') closing, generate_subscripts(parts, 1) - 1 pos,
    concat(mark, unnest(parts)) whole
  from pieces),
items as (
  select *, case when contains(whole, closing) then left(whole, strpos(whole, closing) + length(closing) - 1)
    else whole end item
  from uncut)"""


def _unescape(text: str) -> str:
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                         ("&nbsp;", " "), ("&amp;", "&")]:
        text = f"replace({text}, '{entity}', '{char}')"
    return f"trim(regexp_replace({text}, '[\\s\u00a0]+', ' ', 'g'), ' ')"


def _missing(pattern: str) -> str:
    return (f"case when regexp_matches(item, '{pattern}') "
            f"then {_unescape(f"regexp_extract(item, '{pattern}', 1)")} else 'N/A' end")


ORIGIN = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"

FIELDS = ITEMS + f""",
fields as (
  select page_id, source, pos,
    case source when 'blog' then {_missing('<h1>([^<]*)</h1>')}
      when 'bare' then {_missing('^<p>(?:<b>)?([^<.]+)')}
      else {_missing('<a [^>]*>([^<]*)</a>')} end as name,
    case when source = 'blog' and regexp_matches(item, '[0-9]')
      then concat('₹', regexp_extract(item, '([0-9]+)', 1)) else 'N/A' end price,
    case when source = 'bare' and regexp_matches(item, '[0-9]')
      then regexp_extract(item, '([0-9]+[.]?[0-9]*)', 1) else 'N/A' end rating,
    'N/A' image_url,
    case when source in ('m', 'www') and regexp_matches(item, '<a href="/')
      then concat({ORIGIN}, {_unescape("regexp_extract(item, '<a href=\"([^\"]*)\"', 1)")})
      else 'N/A' end product_url
  from items)"""

BYTE = "(cast(floor((e::double + 1) * 127.5::double) as bigint) + {}) % 256"

TILES = f"""
tiles as (
  select vec_id image_id, list_transform(embedding, lambda e: {BYTE.format(0)}) b,
    list_transform(embedding, lambda e: {BYTE.format(85)}) g,
    list_transform(embedding, lambda e: {BYTE.format(170)}) r
  from embeddings)"""

TILE_CROPS = TILES + f""",
tdet as (
  select user_id image_id, event_id seq,
    case event_id % 6 when 0 then 'person' when 1 then 'T-Shirt' when 2 then 'laptop'
      when 3 then 'car' when 4 then 'Blouse' else 'dog' end class_name,
    (event_id * 37 % 101) / 100::double confidence,
    event_id % 8 + 0::double x1, event_id * 3 % 8 + 0::double y1,
    event_id * 5 % 7 bw, event_id * 3 % 5 bh
  from events),
tcrops as (
  select *, row_number() over (partition by image_id order by seq) - 1 crop_ordinal
  from (select image_id, seq, {_box(1, 8, 8)} from tdet where {MATCH}) d
  where x2 > x1 and y2 > y1)"""

TILE_FILES = TILES + """,
files as (
  select image_id product_id, 0 crop_ordinal, image_id % 17 <> 0 sound, b, g, r from tiles
  union all select image_id, 1, true, b, g, r from tiles where image_id % 3 = 0),
named as (
  select *, concat('tile_', cast(product_id as varchar), '_', cast(crop_ordinal as varchar), '.png') file_name
  from files)"""

TILE_TOTAL = """list_sum(list_transform(list_concat(b, list_concat(g, r)),
                lambda v: (v / 255::double)::float::double))"""

TOPK = """
hits as (
  select *, row_number() over (partition by query_id order by similarity desc, candidate_id) rank
  from (select a.vec_id query_id, b.vec_id candidate_id,
          round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) similarity
        from embeddings a join embeddings b on a.vec_id <> b.vec_id) s)"""

SERVING = CLEAN + """,
serving as (
  select product_id, name, coalesce(try_cast(rating as double), 0::double) rating, embedding
  from product_clean join embeddings on product_id = vec_id)"""

_TOPK_HITS = f"with {TOPK} select query_id, rank, candidate_id, similarity from hits where rank <= 5"

_PAGE_COUNTS = SOURCES + """,
counted as (
  select page_id, source, len(string_split(html, '<a href=')) - 1 n from pg)"""


def oracle_sql() -> dict[str, str]:
    missing = "nullif(nullif(nullif({0}, 'N/A'), 'n/a'), '') {0}"
    return {
        "read_products": f"with {RAW} select product_id, " + ", ".join(
            missing.format(c) for c in ("name", "price", "rating", "no_of_reviews", "image_url",
                                        "product_url", "source")) + " from product_raw",
        "read_products_by_name": f"with {RAW} select product_id, " + ", ".join(
            missing.format(c) for c in ("name", "price", "source")) + """,
              case when product_id % 2 = 0 then nullif(nullif(nullif(no_of_reviews, 'N/A'), 'n/a'), '') end no_of_reviews
            from product_raw""",
        "load_model": f"""with {SCORED},
            joined as (select product_id, popularity, label::double x
              from scored join embeddings on product_id = vec_id),
            fit as (select regr_slope(popularity, x) a, regr_intercept(popularity, x) b from joined)
            select product_id, round(a * x + b, 6) predicted from joined cross join fit""",
        "scan_pages": """select page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) host,
            length(html) n_chars from pages""",
        "crawl_frontier": """
            select site, term, cast(page as bigint) page,
              concat(prefix, replace(term, ' ', blank), suffix,
                case when paged then concat('&page=', cast(page as varchar)) else '' end) url
            from (values ('Amazon', 'https://www.amazon.in/s?k=', '+', '&rh=n%3A1571271031', 2, true),
              ('Flipkart', 'https://www.flipkart.com/search?q=', '%20', '', 2, true),
              ('Myntra', 'https://www.myntra.com/', '-', '', 1, false),
              ('H&M', 'https://www2.hm.com/en_in/search-results.html?q=', '%20', '', 1, false)
            ) s(site, prefix, blank, suffix, max_pages, paged)
            cross join (select distinct p_name term from part) t
            cross join (values (1), (2)) p(page) where page <= max_pages
            union all select 'Vogue', null, 1, 'https://www.vogue.in/fashion'""",
        "due_urls": """
            select site, term, cast(page as bigint) page,
              concat(prefix, replace(term, ' ', blank), suffix,
                case when paged then concat('&page=', cast(page as varchar)) else '' end) url,
              case when site = 'Myntra' then 1::bigint else 0::bigint end attempts
            from (values ('Amazon', 'https://www.amazon.in/s?k=', '+', '&rh=n%3A1571271031', 2, true),
              ('Flipkart', 'https://www.flipkart.com/search?q=', '%20', '', 2, true),
              ('Myntra', 'https://www.myntra.com/', '-', '', 1, false)
            ) s(site, prefix, blank, suffix, max_pages, paged)
            cross join (select distinct p_name term from part) t
            cross join (values (1), (2)) p(page)
            where page <= max_pages and (page = 2 or site = 'Myntra' and length(term) <= 12)""",
        "cross_frontier": """select term, site, paged
            from (values ('Amazon', true), ('Flipkart', true), ('Myntra', false), ('H&M', false)) s(site, paged)
            cross join (select distinct p_name term from part) t""",
        "explode_items": f"""with {ITEMS} select page_id, source, pos, length(item) n_chars from items""",
        "skipped_pages": f"""with {ITEMS} select page_id, source,
              case when source = 'm' then 'no rule' else 'no item' end reason
            from marked where source = 'm' or not contains(html, mark)""",
        "extract_fields": f"with {FIELDS} select * from fields",
        "limit_then_keyword": f"""with {FIELDS} select page_id, source, pos, name, product_url from fields
            where name <> 'N/A' and (source <> 'm' or (pos < 4 and contains(lower(name), 'th')))""",
        "resolve_url": f"""
            select page_id, pos, href, case when regexp_matches(href, '^[a-z]+://') then href
              when href like '/%' then concat({ORIGIN}, href) end link
            from (select page_id, url, unnest(l) href, generate_subscripts(l, 1) - 1 pos
                  from (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) l from pages) a) b""",
        "bad_record_isolation": f"""with {RAW} select product_id,
              case when name = 'N/A' then 'no name' when price = 'N/A' then 'no price'
                when rating is null or not regexp_matches(rating, '[0-9]') then 'no rating'
                when image_url is null or image_url not like 'http%' then 'no image' end reject_reason
            from product_raw""",
        "broadcast_rules": f"""with {SOURCES} select page_id, source,
              case source when 'blog' then '<article>' when 'bare' then '<p>' else '<li>' end rule_item,
              cast(case when source = 'm' then 4 end as bigint) max_items from pg""",
        "filter_named": f"with {RAW} select product_id, name, source from product_raw where name <> 'N/A'",
        "image_manifest": f"""with {RAW} select product_id, image_url,
              case when image_url like 'http%' then 'fetch' else 'skip' end as action,
              case when image_url like 'http%' then concat(cast(product_id as varchar), '.jpg') end file_name
            from product_raw""",
        "filter_detections": f"with {DET} select image_id, seq, class_name, confidence from det where {MATCH}",
        "filter_nonempty_crop": f"""with {DET} select * from (select image_id, seq, {_box(0)} from det) d
            where x2 > x1 and y2 > y1""",
        "finite_vectors": """select vec_id, label from embeddings
            where vec_id % 7 <> 0 and vec_id % 11 <> 0""",
        "filter_finite": """select vec_id, label::double score from embeddings
            where vec_id % 7 <> 0 and vec_id % 11 <> 0 and vec_id % 13 <> 0""",
        "valid_only": f"""with {CLEAN} select product_id, name, rating from product_clean
            where product_id in (select vec_id from embeddings)""",
        "add_default_column": "select p_partkey product_id, cast(10 as bigint) no_of_reviews from part",
        "optional_link": f"""with {RAW} select product_id,
              case when product_url <> 'N/A' then concat('[View product](', product_url, ')') end link
            from product_raw""",
        "join_products_images": """select p_partkey product_id, p_name, label
            from part join embeddings on p_partkey = vec_id""",
        "semi_products_with_images": """select p_partkey product_id, p_name from part
            where p_partkey in (select vec_id from embeddings)""",
        "anti_failed_images": """select c_custkey image_id from customer
            where c_custkey % 17 = 0 or c_custkey % 19 = 0""",
        "cross_query_catalogue": f"""with {CENTERS} select c.label::bigint as label, vec_id,
              round(list_cosine_similarity(c.v, embedding::double[]), 6) similarity
            from centers c cross join embeddings e""",
        "join_scalar_stats": """select o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) scaled
            from orders cross join (select min(o_totalprice) lo, max(o_totalprice) hi from orders) x""",
        "source_counts": f"with {CLEAN} select source, count(*) n from product_clean group by source",
        "total_count": f"with {CLEAN} select count(*) total from product_clean",
        "minmax_stats": f"with {SCORED} select round(min(pop), 6) low, round(max(pop), 6) high from scored",
        "detection_totals": f"""with {CROPS},
            read as (select c_custkey % 17 <> 0 and c_custkey % 19 <> 0 ok from customer)
            select count(*) filter (ok) processed_images, (select count(*) from crops) total_detections,
              (select count(*) from crops) cropped_count, count(*) filter (not ok) failed_images
            from read""",
        "detections_per_image": f"""with {CROPS},
            images as (select distinct user_id image_id from events),
            counts as (select image_id, count(*) n from crops group by image_id),
            chunks as (select image_id, crop_ordinal // 16 chunk,
                string_agg(concat(class_name, '@', cast(cast(round(confidence * 100) as bigint) as varchar)),
                           ',' order by seq) detections
              from crops group by image_id, crop_ordinal // 16)
            select i.image_id, coalesce(chunk, 0) chunk, coalesce(n, 0) cropped_count,
              coalesce(detections, '') detections
            from images i left join counts c on i.image_id = c.image_id
              left join chunks k on i.image_id = k.image_id""",
        "summary_document": f"""with {CLEAN},
            counts as (select source, count(*) n from product_clean group by source)
            select cast(sum(n) as bigint) total_products,
              concat('{{', string_agg(concat('"', source, '":', cast(n as varchar)), ',' order by source), '}}') sources,
              '["mens shirts","womens dresses","casual wear","formal wear","summer collection"]' search_terms
            from counts""",
        "dedup_products": f"""with {RAW} select product_id, name, source
            from (select *, row_number() over (partition by name, source order by product_id) rn from product_raw) d
            where rn = 1""",
        "image_stats": f"""with {TILES} select image_id, 8::bigint width, 8::bigint height,
              1::double aspect_ratio, 64::bigint area, round(list_avg(b), 6) mean_blue,
              round(list_avg(g), 6) mean_green, round(list_avg(r), 6) mean_red,
              round(list_avg(list_transform(range(1, 65),
                lambda i: (114 * b[i] + 587 * g[i] + 299 * r[i] + 500) // 1000)), 6) brightness
            from tiles""",
        "regression_metrics": f"""with {SCORED},
            guess as (select source, avg(popularity) p from scored group by source)
            select round(avg((p - popularity) * (p - popularity)), 6) mse,
              round(avg(abs(p - popularity)), 6) mae
            from scored join guess on scored.source = guess.source""",
        "centroids": f"""with {CENTERS} select label, cast(pos - 1 as bigint) pos, round(m, 6) mean from means""",
        "crop_ordinal": f"with {CROPS} select image_id, seq, crop_ordinal from crops",
        "crop_ordinal_of_heavy_images": f"with {CROPS} select image_id, seq, crop_ordinal from crops",
        "first_crop": f"with {CROPS} select image_id, seq, class_name from crops where crop_ordinal = 0",
        "running_totals": f"""with {_PAGE_COUNTS} select page_id, source, n::bigint n,
              cast(sum(n) over (order by page_id) as bigint) total_so_far from counted""",
        "running_totals_by_source": f"""with {_PAGE_COUNTS} select page_id, source, n::bigint n,
              cast(sum(n) over (partition by source order by page_id) as bigint) source_total from counted""",
        "running_totals_of_heavy_sources": f"""with {_PAGE_COUNTS} select page_id, source, n::bigint n,
              cast(sum(n) over (partition by source order by page_id desc) as bigint) source_total from counted""",
        "row_ordinal": """select user_id, event_id,
              row_number() over (order by user_id, event_id) - 1 ordinal from events""",
        "rank_by_popularity": f"""with {SCORED} select product_id, name, round(popularity, 6) popularity,
              row_number() over (order by popularity desc, product_id) - 1 rank from scored""",
        "topk_similar": _TOPK_HITS,
        "topk_similar_grid": _TOPK_HITS,
        "topk_by_all_lists": _TOPK_HITS,
        "topk_similar_few_queries": f"""with {CENTERS}
            select query_id, rank, candidate_id, similarity from (
              select *, row_number() over (partition by query_id order by similarity desc, candidate_id) rank from (
                select c.label::bigint query_id, vec_id candidate_id,
                  round(list_cosine_similarity(c.v, embedding::double[]), 6) similarity
                from centers c cross join embeddings e) s) r
            where rank <= 5""",
        "sample_head": f"with {CLEAN} select product_id, name from product_clean order by product_id limit 5",
        "union_sources": """
            select p_name as name, concat('₹', cast(p_size as varchar)) price,
              cast(p_size % 5 + 1 as varchar) rating, 'N/A' image_url,
              concat('/p/', cast(p_partkey as varchar)) product_url, 'Amazon' source from part
            union all select s_name, concat('₹', cast(s_nationkey as varchar)),
              cast(s_nationkey % 5 as varchar), concat('/i/', cast(s_suppkey as varchar)), 'N/A', 'Flipkart' from supplier
            union all select c_name, concat('₹', cast(c_nationkey as varchar)), c_mktsegment,
              concat('/i/', cast(c_custkey as varchar)), 'N/A', 'Myntra' from customer
            union all select regexp_extract(html, '<title>([^<]*)</title>', 1), 'N/A', 'N/A', 'N/A', url, 'Vogue' from pages
            union all select concat(source, '/', cast(doc_id as varchar)), cast(n_chars as varchar),
              'N/A', 'N/A', 'N/A', 'H&M' from documents""",
        "clean_products": f"""with {CLEAN} select product_id, name, price, rating, no_of_reviews,
              image_url, source from product_clean""",
        "coerce_scores": f"""with {RAW} select product_id,
              coalesce(try_cast(rating as double), 3::double) rating,
              cast(trunc(coalesce(try_cast(no_of_reviews as double), 10)) as bigint) no_of_reviews
            from product_raw""",
        "coerce_numeric": """select event_id,
              coalesce(try_cast(regexp_extract(props, '([0-9]+[.]?[0-9]*)', 1) as double), 3.0::double) r from events""",
        "popularity_metric": """select l_partkey, round(s * (15 + n) / (n + 5 * s + 1e-5::double), 6) popularity
            from (select l_partkey, count(*) n, avg(l_quantity) s from lineitem group by l_partkey) t""",
        "popularity": f"with {SCORED} select product_id, n, s, round(popularity, 6) popularity from scored",
        "pad_and_clip_box": f"with {DET} select image_id, seq, {_box(20)} from det",
        "crop_boxes": f"""with {CROPS} select image_id, seq, class_name, x1, y1, x2, y2, crop_ordinal from crops""",
        "cosine_pairs": """select a.vec_id, round(list_cosine_similarity(a.embedding::double[],
              b.embedding::double[]), 6) similarity
            from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""",
        "expand_vector": "select vec_id, " + ", ".join(
            f"embedding[{i + 1}]::double feature_{i}" for i in range(64)) + " from embeddings",
        "crop_images": f"""with {TILE_CROPS} select c.image_id, crop_ordinal,
              cast(y2 - y1 as bigint) height, cast(x2 - x1 as bigint) width,
              list_aggregate(list_transform(range(y1, y2), lambda y:
                list_aggregate(list_transform(range(x1, x2), lambda x:
                  printf('%02X%02X%02X', b[y * 8 + x + 1], g[y * 8 + x + 1], r[y * 8 + x + 1])),
                'string_agg', '')), 'string_agg', '') as data
            from tcrops c join tiles t on c.image_id = t.image_id""",
        "crop_stored_images": f"""with {TILE_CROPS} select c.image_id, crop_ordinal,
              cast(y2 - y1 as bigint) height, cast(x2 - x1 as bigint) width,
              list_aggregate(list_transform(range(y1, y2), lambda y:
                list_aggregate(list_transform(range(x1, x2), lambda x:
                  printf('%02X%02X%02X', b[y * 8 + x + 1], g[y * 8 + x + 1], r[y * 8 + x + 1])),
                'string_agg', '')), 'string_agg', '') as data
            from tcrops c join tiles t on c.image_id = t.image_id""",
        "scan_images": f"""with {TILE_FILES} select file_name, product_id, crop_ordinal::bigint crop_ordinal from named""",
        "decode_images": f"""with {TILE_FILES}
            select file_name, case when sound then 'ok' else 'failed' end status,
              case when sound then 8::bigint end height, case when sound then 8::bigint end width,
              case when sound then list_aggregate(list_transform(range(1, 65),
                lambda i: printf('%02X%02X%02X', b[i], g[i], r[i])), 'string_agg', '') end as data
            from named""",
        "first_crop_vectors": f"""with {TILE_FILES}
            select file_name, case when sound then 'ok' else 'failed' end status, product_id,
              case when sound then round({TILE_TOTAL}, 6) end total
            from named where crop_ordinal = 0""",
        "training_rows_from_pictures": f"""with {CLEAN}, {TILES},
            c as (select product_id, coalesce(try_cast(rating as double), 3.0::double) s,
                cast(trunc(coalesce(try_cast(no_of_reviews as double), 10)) as bigint) n,
                round({TILE_TOTAL}, 6) total
              from product_clean join tiles on product_id = image_id where product_id % 17 <> 0),
            m as (select *, s * (15 + n) / (n + 5 * s + 1e-5::double) pop from c),
            x as (select min(pop) lo, max(pop) hi from m)
            select product_id, round(case when hi = lo then 0::double else (pop - lo) / (hi - lo) end, 6) popularity,
              total, row_number() over (order by product_id) - 1 < floor(0.8::double * count(*) over ()) is_train
            from m cross join x""",
        "refresh_vectors": f"""with {TILES}
            select image_id, case when image_id % 5 = 0 or image_id % 7 = 3 then 2::bigint else 1::bigint end run,
              round((case when image_id % 5 = 0 then g[1] else b[1] end / 255::double)::float::double, 6) first_value
            from tiles""",
        "flatten": """select vec_id, cast(pos as bigint) pos, embedding[pos // 8 * 8 + 8 - pos % 8]::double as value
            from (select vec_id, embedding, unnest(range(0, 64)) pos from embeddings) e""",
        "embed_images": f"""with {TILES},
            flat as (select image_id, unnest(range(0, 192)) pos, b, g, r from tiles)
            select image_id, pos, round((case pos % 3 when 0 then b[pos // 3 + 1]
                when 1 then g[pos // 3 + 1] else r[pos // 3 + 1] end / 255::double)::float::double, 6) as value
            from flat""",
        "positional_split": """select vec_id, label, ordinal < floor(0.85::double * n) is_train
            from (select vec_id, label, row_number() over (order by vec_id) - 1 ordinal, count(*) over () n
                  from embeddings) t""",
        "trend_labels": """with sizes as (select label, count(*) n from embeddings group by label),
            ends as (select max(n) hi, min(n) lo from sizes)
            select label, n, case when n = hi then 'popular' when n = lo then 'lagging' else 'steady' end trend
            from sizes cross join ends""",
        "assign_nearest": f"""with {CENTERS}
            select vec_id, label::bigint as label, distance from (
              select *, row_number() over (partition by vec_id order by distance, label) rn
              from (select vec_id, c.label, round(list_sum(list_transform(range(1, 65),
                      lambda i: (embedding[i]::double - v[i]) * (embedding[i]::double - v[i]))), 6) distance
                    from embeddings cross join centers c) d) r
            where rn = 1""",
        "project_result": f"""with {SERVING}, {CENTERS}
            select label::bigint as label, rank, product_id, name, rating, similarity from (
              select *, row_number() over (partition by label order by similarity desc, product_id) rank
              from (select c.label, product_id, name, rating,
                      round(list_cosine_similarity(c.v, embedding::double[]), 6) similarity
                    from centers c cross join serving) s) r
            where rank <= 5""",
        "recommend": f"""with {SERVING}
            select query_id, rank, product_id, name, rating, similarity from (
              select *, row_number() over (partition by query_id order by similarity desc, product_id) rank
              from (select q.vec_id query_id, product_id, name, rating,
                      round(list_cosine_similarity(q.embedding::double[], p.embedding::double[]), 6) similarity
                    from embeddings q cross join serving p) s) r
            where rank <= 5""",
        "stream_recommend": _TOPK_HITS,
        "stream_dedup": """select event_id, user_id, event_type from (
              select *, row_number() over (partition by user_id, event_type
                order by event_id % 4, event_id) rn from events) e
            where rn = 1""",
        "stream_first_after_gap": """select event_id, user_id, event_type from (
              select *, lag(ts) over (partition by user_id, event_type order by ts, event_id) seen from events) e
            where seen is null or ts - seen > interval 6 hours""",
        "stream_recommend_current": """
            select query_id, rank, candidate_id, similarity, catalogue_version from (
              select *, row_number() over (partition by query_id order by similarity desc, candidate_id) rank
              from (select a.vec_id query_id, b.vec_id candidate_id, a.vec_id // 2 % 2 + 1 catalogue_version,
                      round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) similarity
                    from embeddings a join embeddings b on b.vec_id % 2 = a.vec_id // 2 % 2) s) r
            where rank <= 5""",
        "write_ranked_csv": f"with {SCORED} select product_id, name, round(popularity, 6) popularity from scored",
        "write_summary_json": f"""with {CLEAN} select cast(sum(count(*)) over () as bigint) total_products,
              source, count(*) n, cast(5 as bigint) n_terms from product_clean group by source""",
        "write_metadata_json": f"""with {CROPS},
            images as (select distinct user_id image_id from events),
            counts as (select image_id, count(*) n from crops group by image_id)
            select concat(cast(i.image_id as varchar), '.jpg') original_image, coalesce(n, 0) cropped_count,
              class_name, confidence, raw_x1 x1
            from images i left join counts c on i.image_id = c.image_id
              left join crops k on i.image_id = k.image_id""",
        "write_crops": f"""with {TILE_CROPS} select image_id, count(*) crops,
              cast(sum((x2 - x1) * (y2 - y1) * 3) as bigint) bytes
            from tcrops where image_id in (select vec_id from embeddings) group by image_id""",
        "write_features": """select concat('tile_', cast(vec_id as varchar), '_0.jpg') image_path,
              cast(len(embedding) as bigint) width, embedding[1]::double feature_0,
              embedding[64]::double feature_63 from embeddings""",
    }
