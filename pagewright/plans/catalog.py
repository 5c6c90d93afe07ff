"""Queries over the supplied tables, one per operator. Each takes (spark, folder).

Columns are bound to roles: a document is a review of the product that ``source`` names, a part is a
product, an event is a page of a run. Where the tables hold no markup of a kind, it is built from
their columns, row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.functions import html as hx
from pagewright.functions import surface
from pagewright.functions import text as tx
from pagewright.operators import clean, features, hierarchy, jsonwalk, log, pages as pg, sketches, temporal
from pagewright.operators.hotkeys import number_rows
from pagewright.plans import jobs
from pagewright.sources import incremental, io, pagefiles
from pagewright.streaming import cuts, windows

WHEN = "2026-01-01T00:00:00+00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Parts in a task at most, where markup is built for each of them and read again.
PARTS_AT_ONCE = 20_000


def dealt_parts(spark: SparkSession, folder: str) -> DataFrame:
    """part for building pages. The table takes a few bytes a row, so a few tasks read all of it, which would then
    parse all the pages; its rows are dealt out while they are small."""
    part = table(spark, folder, "part")
    return part.repartition(max(2 * spark.sparkContext.defaultParallelism, -(-part.count() // PARTS_AT_ONCE)))


def reviews(spark, folder) -> DataFrame:
    """documents as raw reviews."""
    return table(spark, folder, "documents").selectExpr(
        "doc_id AS ord",
        "source AS product_id",
        "text AS review_text",
        "cast(doc_id % 97 AS string) AS review_time_display",
        "cast(doc_id % 5 + 1 AS int) AS star_rating",
        "CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE lang END AS variant_text",
    )


def products(spark, folder) -> DataFrame:
    """Products: the sources of the documents, and brands nobody reviewed."""
    docs = table(spark, folder, "documents").groupBy(F.col("source").alias("product_id")).agg(
        F.max("lang").alias("category_breadcrumb"),
        F.concat(F.lit("Rp"), (F.sum("n_chars") * 10).cast("string")).alias("price_display"),
        F.concat(F.count("*").cast("string"), F.lit(" sold")).alias("sold_count_display"),
    )
    brands = table(spark, folder, "part").groupBy(F.col("p_brand").alias("product_id")).agg(
        F.max("p_type").alias("category_breadcrumb"),
        F.concat(F.lit("Rp"), (F.sum("p_size") * 100).cast("string")).alias("price_display"),
        F.concat(F.count("*").cast("string"), F.lit(" sold")).alias("sold_count_display"),
    )
    return docs.unionByName(brands)


def clean_reviews(spark, folder) -> DataFrame:
    base = table(spark, folder, "documents").selectExpr(
        "doc_id * 2 AS ord", "source AS product_id", "text AS review_text",
        "cast(doc_id % 7 AS string) AS review_time_display",
        "CASE WHEN doc_id % 11 = 0 THEN 'n/a' ELSE cast(doc_id % 5 + 1 AS string) END AS star_rating",
        "concat(lang, ' ', source) AS reviewer_name_masked",
        "doc_id % 2 = 0 AS media_flag", "doc_id % 3 = 0 AS seller_reply_flag",
    )
    copies = base.withColumns(
        {
            "ord": F.col("ord") + 1,
            "review_text": F.concat(F.lit("\t "), F.replace("review_text", F.lit(" "), F.lit("  ")), F.lit("\n")),
        }
    )
    return clean.clean_reviews(base.unionByName(copies), "ord")


def clean_products(spark, folder) -> DataFrame:
    rows = table(spark, folder, "part").selectExpr(
        "p_partkey AS ord", "concat(' ', p_brand) AS product_id", "concat(p_type, ' ') AS product_url",
        "concat('  ', p_name) AS title", "p_type AS category_breadcrumb",
        "concat(cast(p_size AS string), ',5 ') AS rating_avg_display",
    )
    return clean.clean_products(rows, "ord")


def keep_first(spark, folder) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderstatus")
    return clean.keep_first(rows, ["o_custkey", "o_orderpriority"], "o_orderkey")


def review_features(spark, folder) -> DataFrame:
    return features.build_review_features(reviews(spark, folder), "ord")


def emoji_runs(spark, folder) -> DataFrame:
    """Emoji runs of the documents, with runs of one to three and lone ones set before and behind each text."""
    text = "concat(repeat('\U0001f600', doc_id % 4), text, repeat('\u2600\u2708', doc_id % 3), 'a\U0001f680b\U0001f9ff ')"
    rows = table(spark, folder, "documents").selectExpr("doc_id", f"{text} AS text")
    return rows.select("doc_id", tx.emoji_count(F.col("text")).alias("emoji_count"))


def review_order(spark, folder) -> DataFrame:
    return features.review_order(reviews(spark, folder).drop("review_text"), "ord")


def input_order(spark, folder) -> DataFrame:
    rows = table(spark, folder, "conversations").selectExpr("conv_id * 1000 + turn AS ord", "text AS review_text")
    return features.review_order(rows, "ord")


def product_rollup(spark, folder) -> DataFrame:
    return features.product_rollup(features.text_features(reviews(spark, folder)))


def product_metadata(spark, folder) -> DataFrame:
    return features.product_metadata(products(spark, folder), "price_display")


def product_aggregates(spark, folder) -> DataFrame:
    return features.build_product_aggregates(reviews(spark, folder), products(spark, folder), "price_display")


def density(spark, folder) -> DataFrame:
    counts = table(spark, folder, "conversations").groupBy(F.col("conv_id").alias("product_id"))
    return features.with_density(counts.agg(F.count("*").alias("review_count")))


def price_bands(spark, folder) -> DataFrame:
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "concat('Rp', cast(cast(o_totalprice * 4 AS decimal(18, 2)) AS string)) AS price_display"
    )
    return rows.withColumn("price_band", tx.price_band(F.col("price_display")))


def sold_bands(spark, folder) -> DataFrame:
    sold = table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").cast("bigint").cast("string").alias("sold_count_display")
    )
    return sold.withColumn("sold_count_band", tx.sold_band(F.col("sold_count_display")))


def template_keys(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", tx.template_key(tx.normalize_text(F.col("text"))).alias("template_key"))


def numbers(spark, folder) -> DataFrame:
    rows = table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "CASE c_custkey % 4 WHEN 0 THEN concat(' ', cast(c_custkey AS string), ',25 ')"
        " WHEN 1 THEN c_name WHEN 2 THEN concat(cast(c_custkey AS string), 'd')"
        " ELSE concat('-', cast(c_custkey AS string), 'e1') END AS shown",
    )
    shown = F.col("shown")
    return rows.select(
        "c_custkey",
        tx.to_numeric_string(shown).alias("numeric_string"),
        F.coalesce(tx.to_number(tx.to_numeric_string(shown)), F.lit(-0.5)).alias("number"),
        tx.digits_and_dots(shown).alias("digits"),
    )


def mask_names(spark, folder) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey", tx.mask_identifier(F.col("c_name")).alias("masked"),
        tx.mask_identifier(F.col("c_nationkey").cast("string")).alias("short_masked"),
    )


def hash_text(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", tx.stable_hash(F.col("text")).alias("hash"))


def product_ids(spark, folder) -> DataFrame:
    urls = table(spark, folder, "pages").selectExpr(
        "page_id",
        "CASE page_id % 4 WHEN 0 THEN concat(regexp_replace(url, '[?#].*', ''), '?x=1&itemid=i', page_id)"
        " WHEN 1 THEN concat(regexp_replace(url, '[?#].*', ''), '?product_id=a%20b+', page_id, '#itemid=3')"
        " WHEN 2 THEN regexp_replace(url, '[0-9]', '') ELSE url END AS url",
    )
    return urls.select("page_id", hx.extract_product_id(F.col("url")).alias("product_id"))


def visible_text(spark, folder) -> DataFrame:
    html = F.col("html")
    return table(spark, folder, "pages").select(
        "page_id", hx.visible_text(html).alias("visible_text"), hx.block_text(html).alias("block_text"),
        hx.snapshot_title(html).alias("title"), hx.block_title(html).alias("block_title"),
    )


def unescape_text(spark, folder) -> DataFrame:
    """Each document with its specials escaped by name or by number, then read back."""
    escaped = (
        "replace(replace(replace(replace(text, '&', '&amp;'), 't', '&#116;'), 'n', '&#x6E;'), 'o', '&ocirc;')"
    )
    docs = table(spark, folder, "documents").selectExpr("doc_id", f"{escaped} AS html")
    return docs.select("doc_id", hx.unescape_html(F.col("html")).alias("text"))


def _block_pages(spark, folder) -> DataFrame:
    return table(spark, folder, "pages").selectExpr(
        "page_id",
        "CASE page_id % 7 WHEN 1 THEN replace(html, '<title>', '<title>Captcha ')"
        " WHEN 2 THEN replace(html, '</body>', 'Access Denied</body>') WHEN 3 THEN ' '"
        " WHEN 4 THEN replace(html, '<title>', '<title>Please Login ') ELSE html END AS html",
        "CASE WHEN page_id % 7 = 5 THEN 403 ELSE 200 END AS status_code",
        "CASE WHEN page_id % 7 = 6 THEN concat(url, '/buyer/login') ELSE url END AS final_url",
    )


def block_inspection(spark, folder) -> DataFrame:
    return pg.inspect_blocks(_block_pages(spark, folder)).drop("html", "status_code", "final_url")


def block_reasons(spark, folder) -> DataFrame:
    return pg.block_reason(_block_pages(spark, folder), [404], ["denied", " Captcha "])


def _link_pages(spark, folder) -> DataFrame:
    return table(spark, folder, "pages").withColumn("html", F.expr("replace(html, 'href=\"/a', 'href=\"/a?page=')"))


def link_discovery(spark, folder) -> DataFrame:
    return pg.discover_links(_link_pages(spark, folder), 5)


def resolved_urls(spark, folder) -> DataFrame:
    links = table(spark, folder, "pages").select(
        "page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(hx.HREF), F.lit(1))).alias("pos", "href")
    )
    return links.select(
        "page_id", "pos",
        hx.resolve_url(F.col("url"), F.col("href")).alias("rooted"),
        hx.resolve_url(F.col("url"), F.concat(F.lit("../x/./y"), F.col("href"))).alias("dotted"),
        hx.resolve_url(F.col("url"), F.concat(F.lit("?q="), F.col("href"))).alias("query"),
    )


def meta_tags(spark, folder) -> DataFrame:
    pages = table(spark, folder, "part").selectExpr(
        "p_partkey AS page_id",
        "concat('<meta property=\"og:title\" content=\"', p_name, ' &lt;', p_size, '&gt;\">',"
        " '<META name=\"Brand\" content=\"x\"><meta charset=\"u\" name=\"brand\" content=\" ', p_brand, ' \">') AS html",
    )
    return pg.meta_map(pages).select(
        "page_id", F.size("meta").alias("n"), F.col("meta")["og:title"].alias("title"), F.col("meta")["brand"].alias("brand")
    )


def product_pages(spark, folder) -> DataFrame:
    """A product page per part; three shapes that differ in where the fields stand."""
    return dealt_parts(spark, folder).selectExpr(
        "p_partkey AS page_id",
        "concat('https://shop.example/item-i.7.', p_partkey) AS url",
        """concat('<html><head><title>', p_name, ' page</title>',
          CASE p_partkey % 3
          WHEN 0 THEN concat('<meta property="og:title" content="', p_name, '">',
            '<meta property="og:category" content="', p_type, '">',
            '<script type="application/ld+json">{"@type":"Product","name":"other","aggregateRating":{"ratingValue":',
            p_size, ',"reviewCount":"', p_size * 2, '"},"offers":{"price":', p_size * 1000, '},"brand":{"name":"', p_brand,
            '"}}</script>')
          WHEN 1 THEN concat('<script>window.__STATE__ = {"a":{"price_min":1,"price":"', p_size, '"},"b":{"price":7},',
            '"shop":"', p_brand, '","sold":', p_size, ',"rating":{"x":1},"rating_star":4.5,"cmt_count":0};</script>')
          ELSE concat('<script type="application/ld+json">{"@type":"BreadcrumbList","itemListElement":[{"name":"',
            p_brand, '"},{"name":""},{"name":" ', p_type, '"}]}</script><script>{"Stock":true,"location":null}</script>')
          END, '</head><body></body></html>') AS html""",
    )


def product_snapshot(spark, folder) -> DataFrame:
    return pg.parse_product_snapshots(product_pages(spark, folder), WHEN).select(
        "page_id", "product_id", "title", "category_breadcrumb", "price_display", "sold_count_display",
        "rating_avg_display", "rating_count_display", "shop_name", "stock_display", "shop_location",
        "required_field_completeness", "parse_status",
    )


def seed_category(spark, folder) -> DataFrame:
    snapshots = pg.parse_product_snapshots(product_pages(spark, folder), WHEN).select("page_id", "product_url")
    seeds = table(spark, folder, "supplier").selectExpr(
        "concat('https://shop.example/item-i.7.', s_suppkey) AS product_url", "s_name AS category_quota"
    )
    return pg.carry_seed_category(snapshots, seeds).select("page_id", "seed_category_quota")


def json_blobs(spark, folder) -> DataFrame:
    return pg.json_blobs(product_pages(spark, folder))


def _tree_pages(spark, folder) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS page_id",
        "concat('<script>{\"name\":\"', p_name, '\",\"size\":[', p_size, ',{\"brand\":\"', p_brand, '\"}],\"z\":null}</script>') AS html",
    )


def _node_rows(nodes) -> DataFrame:
    return nodes.select(
        "page_id", "pos", F.coalesce("key", F.lit("-")).alias("key"), "kind", F.coalesce("text", F.lit("-")).alias("text"), "size"
    )


def json_nodes(spark, folder) -> DataFrame:
    """Nodes of a small tree per part: pos, key, kind, text."""
    return _node_rows(pg.json_nodes(_tree_pages(spark, folder)))


def json_walk(spark, folder) -> DataFrame:
    """:func:`json_nodes` by the recursive query."""
    return _node_rows(jsonwalk.json_nodes(_tree_pages(spark, folder)))


def json_walk_find(spark, folder) -> DataFrame:
    """:func:`deep_find` by the recursive query; containers without blanks."""
    found = jsonwalk.deep_find(product_pages(spark, folder), ["NAME", "price", "itemListElement"])
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("blob", "path"))
    return found.select("page_id", nth.alias("nth"), "kind", "value")


def deep_find(spark, folder) -> DataFrame:
    found = pg.deep_find(product_pages(spark, folder), ["NAME", "price", "itemListElement"])
    return found.select("page_id", F.row_number().over(Window.partitionBy("page_id").orderBy("pos")).alias("nth"), "kind", "value")


def review_pages(spark, folder) -> DataFrame:
    """Pages with up to eight documents each as embedded reviews."""
    rows = table(spark, folder, "documents").selectExpr(
        "doc_id div 8 AS page_id", "doc_id",
        "to_json(struct(text AS comment, doc_id % 5 + 1 AS rating_star, cast(doc_id % 3 AS string) AS ctime,"
        " lang AS author, array(source) AS images, doc_id % 2 AS seller_reply)) AS item",
    )
    grouped = rows.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("doc_id", "item"))).alias("items"))
    return grouped.selectExpr(
        "page_id", "concat('https://shop.example/d-i.1.', page_id) AS url",
        "concat('<html><body><script>{\"data\":{\"ratings\":[', array_join(transform(items, i -> i.item), ','),"
        " ']}}</script></body></html>') AS html",
    )


_REVIEW = ("page_id", "review_ord", "product_id", "review_text", "star_rating", "review_time_display",
           "reviewer_name_masked", "media_flag", "seller_reply_flag", "image_count", "video_flag")


def reviews_html(spark, folder) -> DataFrame:
    return pg.parse_reviews(review_pages(spark, folder), WHEN).select(*_REVIEW)


def review_candidates(spark, folder) -> DataFrame:
    return pg.review_candidates(review_pages(spark, folder))


def reviews_payload(spark, folder) -> DataFrame:
    """One captured payload per conversation turn."""
    payloads = table(spark, folder, "conversations").selectExpr(
        "conv_id", "turn", "concat('https://shop.example/c-i.2.', conv_id) AS url",
        "to_json(struct(turn AS page, array(struct(text AS content, role AS username, turn AS score),"
        " struct(text AS content, role AS username, turn AS score)) AS Review_List)) AS payload",
    )
    return pg.parse_payload_reviews(payloads, WHEN).select(
        "conv_id", "turn", "product_id", "review_text", "star_rating", "reviewer_name_masked", "response_hash"
    )


def reviews_rendered(spark, folder) -> DataFrame:
    pages = table(spark, folder, "part").selectExpr(
        "p_partkey AS page_id", "concat('https://shop.example/r-i.3.', p_partkey) AS url",
        "concat('<div class=\"x\">no</div><div class=\"item-rating\"><b>', p_name, '</b> &amp; ', p_size % 5 + 1, ' star 2024-01-0',"
        " p_size % 9 + 1, ' variasi: ', p_brand, ' | ', p_size, ' helpful <img src=\"a\"><IMG src=\"b\"></div>',"
        " '<div data-testid=\"review\">', p_size, '/5</div>', '<div id=\"q\" class=\"my-review\">Seller reply ', p_type, '</div>') AS html",
    )
    return pg.parse_rendered_reviews(pages, WHEN).select(
        "page_id", "review_ord", "review_text", F.coalesce("star_rating", F.lit("-")).alias("star_rating"),
        F.coalesce("review_time_display", F.lit("-")).alias("review_time_display"),
        F.coalesce("variant_text", F.lit("-")).alias("variant_text"),
        F.coalesce("helpful_count_display", F.lit("-")).alias("helpful_count_display"),
        "image_count", "media_flag", "seller_reply_flag",
    )


def shell_pages(spark, folder) -> DataFrame:
    pages = table(spark, folder, "pages").withColumn(
        "html", F.expr("CASE WHEN page_id % 3 = 0 THEN replace(html, '<article>', '<article id=\"main\">') ELSE html END")
    )
    return pg.detect_shell_pages(pages)


def page_log(spark, folder) -> DataFrame:
    """events as pages of runs: a run per day, a seed per user class, two seeds per product."""
    return table(spark, folder, "events").selectExpr(
        "date_format(ts, 'yyyy-MM-dd') AS run", "(user_id % 6) * 10000000000 + event_id AS seq",
        "user_id % 6 AS seed", "user_id % 3 AS product_id", "event_id AS page_no",
        "CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE cast(value AS bigint) % 20 END AS n",
        "CASE WHEN event_id % 211 = 210 THEN concat('status_', 403 + event_id % 2) END AS stop_reason",
        "event_type = 'error' AS is_empty",
    )


_LOG = ("run", "seq", "seed", "product_id", "n")


def streak_cut(spark, folder) -> DataFrame:
    return log.streak_cut(page_log(spark, folder), 3).select(*_LOG)


def review_cap(spark, folder) -> DataFrame:
    return log.review_cap_cut(page_log(spark, folder), 100).select(*_LOG)


def stop_fast(spark, folder) -> DataFrame:
    return log.stop_fast_cut(page_log(spark, folder)).select(*_LOG)


def ordered_cuts(spark, folder) -> DataFrame:
    cut = log.review_cap_cut(log.streak_cut(page_log(spark, folder), 3), 100)
    return log.stop_fast_cut(cut).select(*_LOG)


def budget(spark, folder) -> DataFrame:
    return log.budget_cut(page_log(spark, folder), 50).select(*_LOG, "over_budget")


def empty_streak(spark, folder) -> DataFrame:
    return log.empty_payload_streak(page_log(spark, folder)).select("run", "seq", "consecutive_empty_payloads")


def run_summary(spark, folder) -> DataFrame:
    return log.run_summary(page_log(spark, folder)).withColumn("stop_reason", F.coalesce("stop_reason", F.lit("-")))


def source_choice(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents").selectExpr("doc_id div 3 AS seed", "doc_id", "n_chars")
    shells = docs.filter("seed % 2 = 0").select("seed")
    payload = docs.filter("n_chars % 3 = 0").drop("n_chars")
    cards = docs.filter("n_chars % 3 = 1").drop("n_chars")
    embedded = docs.filter("n_chars % 3 = 2").drop("n_chars")
    return log.choose_source(shells, payload, cards, embedded)


def payload_numbers(spark, folder) -> DataFrame:
    rows = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS seed", "l_linenumber AS payload_no", "l_quantity AS quantity"
    )
    return log.number_payloads(rows)


def link_match(spark, folder) -> DataFrame:
    links = pg.discover_links(_link_pages(spark, folder), 5).withColumnRenamed("page_id", "seed")
    stored = table(spark, folder, "pages").select("page_id", "url")
    return log.match_links(links, stored).select("seed", "page_no", "link", "page_id")


def missing_links(spark, folder) -> DataFrame:
    links = pg.discover_links(_link_pages(spark, folder), 5).withColumnRenamed("page_id", "seed")
    return log.missing_links(links, table(spark, folder, "pages")).select("seed", "page_no", "link")


def seed_template(spark, folder) -> DataFrame:
    brands = table(spark, folder, "part").select(F.col("p_brand").alias("category")).distinct()
    return io.seed_template(brands, 9, "2026-01-01")


def seeds(spark, folder) -> DataFrame:
    """Customers as seeds, written as CSV files of unequal size and loaded again; every third has no URL."""
    rows = table(spark, folder, "customer").selectExpr(
        "c_custkey", "floor(log2(c_custkey + 1)) AS part",
        "CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE concat(' https://shop.example/', c_custkey, ' ') END AS product_url",
        "c_mktsegment AS category_quota", "concat('\"', c_name, '\"', ',\n', c_custkey) AS chosen_reason",
        "'2026-01-01' AS seed_date",
    )
    path = io.scratch_path(spark, "seeds")
    dealt = rows.repartitionByRange(5, "part").sortWithinPartitions("c_custkey")
    io.write_csv(dealt.drop("c_custkey", "part"), path)
    return io.load_seeds(spark, path)


def export_round_trip(spark, folder) -> DataFrame:
    """Documents exported and read back from the CSV copy."""
    path = io.scratch_path(spark, "export") + ".parquet"
    result = io.export_table(table(spark, folder, "documents"), path)
    return io.read_csv(spark, result["csv_fallback_path"]).selectExpr(
        "cast(doc_id AS bigint) AS doc_id", "text", "lang", "source", "cast(n_chars AS bigint) AS n_chars"
    )


def manifest_round_trip(spark, folder) -> DataFrame:
    """The verdict on every page as manifest rows, appended as JSON and read back."""
    judged = pg.inspect_blocks(_block_pages(spark, folder)).withColumn("source_url", F.col("page_id").cast("string"))
    path = io.scratch_path(spark, "manifest")
    io.append_manifest(jobs.manifest_rows(judged, "product_snapshot", WHEN), path)
    return io.read_manifest(spark, path).select(
        "source_url", "stage", "status_code", F.coalesce("stop_reason", F.lit("-")).alias("stop_reason")
    )


def page_file_round_trip(spark, folder) -> DataFrame:
    """Every page as a file of its own, read back with the numbers in its name."""
    pages = table(spark, folder, "pages").selectExpr(
        "'review_harvest' AS stage", "cast(page_id AS int) AS product_idx", "1 AS page_no", "html"
    )
    path = io.scratch_path(spark, "pages")
    io.write_page_files(pages, path)
    return io.read_page_files(spark, path)


def _files_to_pages(spark, part) -> DataFrame:
    part = number_rows(part.select("p_partkey", "p_name", "p_type"), ["p_partkey"], "ord", 0)
    first = part.selectExpr(
        "'review_harvest' AS stage", "cast(ord AS int) AS product_idx", "1 AS page_no",
        "concat('<p>', p_name, '</p><a href=\"/r?page=', p_partkey, '\">more</a>') AS html",
    )
    second = part.selectExpr("'review_harvest'", "cast(ord AS int)", "2", "concat('<p>', p_type, '</p>')")
    path = io.scratch_path(spark, "files")
    io.write_page_files(first.union(second), path)
    seeds_ = part.selectExpr("ord", "concat('https://shop.example/f-i.4.', p_partkey) AS product_url")
    log_rows = seeds_.selectExpr(
        "product_url AS source_url", "concat(product_url, '?seen') AS final_url", "200 AS status_code",
    )
    io.append_manifest(jobs.manifest_rows(log_rows, "review_harvest", WHEN), f"{path}-log")
    pages = io.stored_pages(io.read_page_files(spark, path), io.read_manifest(spark, f"{path}-log"), seeds_)
    return pages.select("product_idx", "page_no", "url", "final_url", F.coalesce("status_code", F.lit(0)).alias("status_code"), "html")


def all_files_to_pages(spark, folder) -> DataFrame:
    """Page, payload and rendered files with their manifest and seeds, read back as the tables of the
    jobs: which URL each file was read from, and what was captured for whom."""
    return _files_to_pages(spark, table(spark, folder, "part"))


def _captured_files(spark, turns) -> DataFrame:
    turns = turns.select("conv_id", "turn", "role")
    body = F.to_json(F.struct(F.concat(F.lit("api/"), F.col("turn")).alias("source_url"), F.struct("role", "turn").alias("payload")))
    path = io.scratch_path(spark, "captured")
    files = turns.select(F.col("conv_id").alias("product_idx"), (F.col("turn") + 1).alias("payload_no"), body.alias("body"))
    io.write_payload_files(files, path)
    seeds_ = turns.select(F.col("conv_id").alias("ord")).distinct().withColumn("product_url", F.concat(F.lit("u/"), "ord"))
    return io.captured_for(io.read_payload_files(spark, path), seeds_).select("product_url", "payload_no", "source_url", "payload")


def all_captured_files(spark, folder) -> DataFrame:
    """One payload file per conversation turn, read back with the product of its seed."""
    return _captured_files(spark, table(spark, folder, "conversations"))


def snapshot_job(spark, folder) -> DataFrame:
    pages = product_pages(spark, folder).selectExpr("page_id", "url", "url AS final_url", "200 AS status_code", "html")
    seeds_ = pages.selectExpr("page_id AS ord", "url AS product_url", "'x' AS category_quota")
    found = jobs.snapshot_products(seeds_, pages, WHEN)["products"]
    return found.select("ord", "product_id", "title", "parse_status", "seed_category_quota")


def _harvest_inputs(spark, folder):
    """Six kinds of products: three pages of reviews; a review after three empty pages; shell pages with
    a payload, with a card, with nothing; a link without a stored page. Product 1200 is blocked on its
    second page. Every first page is stored twice."""
    part = dealt_parts(spark, folder).selectExpr(
        "p_partkey AS k", "p_partkey % 6 AS kind", "concat('https://shop.example/h-i.5.', p_partkey) AS u", "p_name", "p_brand", "p_type"
    )
    page = lambda reviews, links: (
        f"concat('<html><title>t</title><body>', repeat('word ', 100), {links}, '<script>{{\"reviews\":[', {reviews}, ']}}</script></body></html>')"
    )
    review = lambda text: f"concat('{{\"text\":\"', {text}, '\",\"star\":5}}')"
    links = lambda last: f"array_join(transform(sequence(2, {last}), n -> concat('<a href=\"', u, '?page=', n, '\">x</a>')), '')"
    shell = "'<html><body><div id=\"main\"></div><script>window.__ASSETS__ = 1</script></body></html>'"
    first = part.selectExpr("k", "kind", "u", "u AS url", "1 AS no", "'x' AS y", f"""CASE
        WHEN kind = 0 THEN {page(review("p_name"), links(3))} WHEN kind = 1 THEN {page(review("p_name"), links(5))}
        WHEN kind = 5 THEN {page(review("p_name"), links(3))} ELSE {shell} END AS html""")
    later = part.filter("kind IN (0, 1, 5)").selectExpr("*", "explode(sequence(2, CASE kind WHEN 0 THEN 3 WHEN 1 THEN 5 ELSE 2 END)) AS no")
    later = later.selectExpr("k", "kind", "u", "concat(u, '?page=', no) AS url", "no", "'x' AS y", f"""CASE
        WHEN kind = 0 AND no = 2 THEN {page("concat(" + review("p_brand") + ", ',', " + review("p_type") + ")", "''")}
        WHEN kind = 1 AND no < 5 THEN {page("''", "''")} ELSE {page(review("concat(p_name, ' ', no)"), "''")} END AS html""")
    both = first.unionByName(later).unionByName(first.withColumn("no", F.lit(9)))
    pages = both.selectExpr(
        "k * 10 + no AS page_id", "url", "url AS final_url", "CASE WHEN k = 1200 AND no = 2 THEN 403 ELSE 200 END AS status_code", "html"
    )
    payloads = part.filter("kind = 2").selectExpr(
        "u AS product_url", "1 AS payload_no", "'api' AS source_url",
        "concat('{\"data\":{\"ratings\":[{\"comment\":\"', p_type, '\",\"rating_star\":4,\"ctime\":\"x\"}]}}') AS payload",
    )
    rendered = part.filter("kind = 3").selectExpr(
        "u AS product_url", "u AS source_url", "concat('<div class=\"review-card\">5 star ', p_name, ' 2024-01-05</div>') AS html"
    )
    return part.selectExpr("k AS ord", "u AS product_url"), pages, payloads, rendered


def _harvested(spark, folder) -> dict[str, DataFrame]:
    seeds_, pages, payloads, rendered = _harvest_inputs(spark, folder)
    return jobs.harvest_reviews(seeds_, pages, WHEN, payloads, rendered, max_empty_pages=3)


def harvest_job(spark, folder) -> DataFrame:
    found = _harvested(spark, folder)["reviews"]
    return found.select("seed", "page_no", "review_ord", "product_id", "review_page", "review_text", "source_url")


def harvest_dropped(spark, folder) -> DataFrame:
    """Pages that the limit on empty pages cut, and links without a stored page."""
    found = _harvested(spark, folder)
    gone = found["dropped"].selectExpr("seed", "url", "'dropped' AS why")
    return gone.unionByName(found["missing"].selectExpr("seed", "product_url AS url", "'missing' AS why"))


def plain_harvest(spark, folder) -> DataFrame:
    """The documents as embedded reviews of pages, harvested without any limit."""
    pages = review_pages(spark, folder).selectExpr("page_id", "url", "url AS final_url", "200 AS status_code", "html")
    seeds_ = pages.selectExpr("page_id AS ord", "url AS product_url")
    found = jobs.harvest_reviews(seeds_, pages, WHEN)["reviews"]
    return found.select("seed", "page_no", "review_ord", "product_id", "review_page", "review_text", "source_url")


def _interim(spark, folder) -> tuple[str, str]:
    interim, processed = io.scratch_path(spark, "interim"), io.scratch_path(spark, "processed")
    named = products(spark, folder).withColumn("product_url", F.concat(F.lit("https://shop.example/"), "product_id"))
    io.write_stage(number_rows(named, ["product_id"], "ord"), f"{interim}/product_snapshots.parquet")
    io.write_stage(reviews(spark, folder), f"{interim}/reviews_raw.parquet")
    jobs.clean_validate(spark, interim, processed)
    return interim, processed


def clean_job(spark, folder) -> DataFrame:
    _, processed = _interim(spark, folder)
    return spark.read.parquet(f"{processed}/reviews.parquet")


def stage_manifest(spark, folder) -> DataFrame:
    """The counts that the cleaning job wrote into its manifest."""
    _, processed = _interim(spark, folder)
    return spark.read.json(f"{processed}/crawl_manifest.json").select("products_rows", "reviews_rows")


def features_job_reviews(spark, folder) -> DataFrame:
    """The review features that the feature job stores."""
    _, processed = _interim(spark, folder)
    jobs.metadata_features(spark, processed)
    return spark.read.parquet(f"{processed}/review_features.parquet").select(
        "ord", "product_id", "review_time_display", "relative_review_order", "text_length", "short_review_flag"
    )


def features_job(spark, folder) -> DataFrame:
    _, processed = _interim(spark, folder)
    jobs.metadata_features(spark, processed)
    return spark.read.parquet(f"{processed}/product_aggregates.parquet")


def asof_orders(spark, folder) -> DataFrame:
    """The latest order of a customer at or before each of their events. Order dates are brought into the
    month of the events."""
    events = table(spark, folder, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    orders = table(spark, folder, "orders").selectExpr(
        "o_custkey AS user_id", "o_orderkey", "o_totalprice",
        "timestamp'2024-01-01' + make_dt_interval(datediff(o_orderdate, '1995-01-01') % 30) AS ordered",
    )
    found = temporal.asof_join(events, orders, "user_id", "ts", "ordered", right_order=["o_orderkey"])
    return found.select("event_id", "user_id", "o_orderkey", "o_totalprice", F.unix_micros("ordered").alias("ordered"))


def asof_recent(spark, folder) -> DataFrame:
    """Page views with the last click of the user strictly before them, three days old at most."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("clicked"), F.col("event_id").alias("click_id"))
    views = events.filter("event_type = 'view'").select("event_id", "user_id", "ts")
    found = temporal.asof_join(views, clicks, "user_id", "ts", "clicked", ["click_id"], tolerance="3 days", exact=False, how="inner")
    return found.select("event_id", "click_id", F.unix_micros("clicked").alias("clicked"))


def _visits(spark, folder) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    return temporal.sessions(events, "user_id", "ts", "12 hours", order=["event_id"], cents=cents)


def visits(spark, folder) -> DataFrame:
    """Sessions of users: events less than twelve hours apart."""
    return _visits(spark, folder).select(
        "user_id", "session", F.unix_micros("session_start").alias("session_start"), F.unix_micros("session_end").alias("session_end"), "n_rows", "cents"
    )


def overlapping_visits(spark, folder) -> DataFrame:
    """Pairs of visits of one region that overlap in time."""
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("region"))
    home = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey").join(nation, "c_nationkey")
    placed = _visits(spark, folder).join(home.drop("c_nationkey"), "user_id").select("region", "user_id", "session", "session_start", "session_end")
    pairs = temporal.overlapping(placed, "region", "session_start", "session_end", ["user_id", "session"])
    both = F.unix_micros(F.least("session_end", "session_end_b")) - F.unix_micros("session_start_b")
    return pairs.select("region", "user_id", "session", "user_id_b", "session_b", both.alias("micros"))


def incremental_keep_first(spark, folder) -> DataFrame:
    """The first document of each text and language from a store into which the documents came in three
    batches, the latest ones first."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text", "n_chars")
    store = incremental.create_store(spark, io.scratch_path(spark, "store"), docs.schema, ["text", "lang"], "doc_id", slices=16, buckets=4)
    for batch in (2, 0, 1):
        incremental.merge(store, docs.filter(F.col("doc_id") % 3 == batch))
    return store.read().select("doc_id", "source", "lang", "n_chars")


def incremental_clean(spark, folder) -> DataFrame:
    """Cleaned reviews kept up to date in a store: two harvests, the second one with all of the first."""
    raw = reviews(spark, folder)
    store = jobs.review_store(spark, io.scratch_path(spark, "store"), raw, slices=16, buckets=4)
    jobs.merge_reviews(store, raw.filter("ord % 2 = 1"))
    jobs.merge_reviews(store, raw)
    return store.read()


def _page_folder(spark, folder) -> str:
    """All pages and conversation turns as files of one folder, by the data source."""
    path = io.scratch_path(spark, "source")
    pages = table(spark, folder, "pages").selectExpr(
        "'page' AS kind", "'review_harvest' AS stage", "cast(page_id AS int) AS product_idx", "1 AS page_no", "html AS body"
    )
    body = F.to_json(F.struct(F.concat(F.lit("api/"), F.col("turn")).alias("source_url"), F.struct("role", "turn").alias("payload")))
    turns = table(spark, folder, "conversations").select(
        F.lit("payload").alias("kind"), F.lit("review_harvest").alias("stage"), F.col("conv_id").cast("int").alias("product_idx"),
        (F.col("turn") + 1).cast("int").alias("page_no"), body.alias("body"),
    )
    pagefiles.write_files(pages.unionByName(turns), path)
    return path


def page_source(spark, folder) -> DataFrame:
    """The pages of a folder of page files, read by the data source."""
    path = _page_folder(spark, folder)
    return pagefiles.page_rows(spark, path)


def payload_source(spark, folder) -> DataFrame:
    """The payloads of the same folder; page files are not opened."""
    return pagefiles.payload_rows(spark, _page_folder(spark, folder))


def breadcrumb_levels(spark, folder) -> DataFrame:
    """Parts per level of their type, band of size and in total: how many, how many brands, the dear ones."""
    parts = table(spark, folder, "part").selectExpr(
        "replace(p_type, ' ', ' > ') AS path", "CASE WHEN p_size < 20 THEN 'small' WHEN p_size < 40 THEN 'medium' END AS band", "p_brand", "p_retailprice"
    )
    found = hierarchy.level_rollup(parts, "path", "band", {"brands": F.col("p_brand")}, {"dear": F.col("p_retailprice") > 950})
    return found.withColumn("dear", F.round("dear", 9))


def sketched_events(spark, folder) -> DataFrame:
    """Events per kind from states that were kept per kind and day: the exact number, and whether the merged
    distinct count of users and the merged median are within their bounds."""
    events = table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    path = io.scratch_path(spark, "states")
    states = sketches.sketch_states(events, ["event_type", "day"], {"users": F.col("user_id")}, {"value": F.col("value")})
    sketches.append_states(states, path, "day")
    merged = sketches.estimates(sketches.merge_states(spark.read.parquet(path), ["event_type"]))
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users_exact"))
    below = events.join(merged.select("event_type", "value_p50"), "event_type").groupBy("event_type").agg(
        F.avg((F.col("value") <= F.col("value_p50")).cast("double")).alias("rank")
    )
    found = merged.join(exact, "event_type").join(below, "event_type")
    return found.select(
        "event_type", "n_rows", "users_exact",
        (F.abs(F.col("users") / F.col("users_exact") - 1) < 0.049).alias("users_close"), (F.abs(F.col("rank") - 0.5) < 0.0275).alias("median_close"),
    )


def _growing(spark, rows, name, parts=3):
    """``rows`` (with ts) as dated files in a folder that grows in ``parts`` steps; yields a stream after each."""
    path, schema = io.scratch_path(spark, name), rows.schema
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    for part in range(parts):
        now = rows.filter(F.least(F.greatest(day, F.lit(0)) * parts / 30, F.lit(parts - 1)).cast("int") == part)
        now.withColumn("day", F.col("ts").cast("date")).repartition(4, "day").write.mode("append").partitionBy("day").parquet(path)
        yield cuts.read_folder(spark, path, schema)


def stream_streak_cut(spark, folder) -> DataFrame:
    """The streak cut of each product's page log, kept up over a folder of dated files with two restarts."""
    log_rows = table(spark, folder, "events").selectExpr(
        "user_id % 30 AS seed", "event_id AS page_no", "event_type IN ('error', 'signup') AS empty", "cast(ts AS timestamp) AS ts"
    )
    out, checkpoint = io.scratch_path(spark, "cut"), io.scratch_path(spark, "checkpoint")
    for stream in _growing(spark, log_rows, "log"):
        windows.run_available(cuts.with_streaks(stream, "seed", "page_no", "empty", "ts", 4), out, checkpoint)
    return spark.read.parquet(out).filter("kept").select("seed", "page_no", "streak")


def stream_windows(spark, folder) -> DataFrame:
    """Events per kind in windows of six hours every three, as far as they are final, with one restart."""
    events = table(spark, folder, "events").selectExpr("event_type", "event_id", "cast(ts AS timestamp) AS ts")
    out, checkpoint = io.scratch_path(spark, "windows"), io.scratch_path(spark, "checkpoint")
    for stream in _growing(spark, events, "events", 2):
        found = windows.windowed(stream, "ts", "6 hours", ["event_type"], "3 hours", "1 day", first_id=F.min("event_id"))
        windows.run_available(found, out, checkpoint)
    done = spark.read.parquet(out)
    return done.select(F.unix_micros("window_start").alias("window_start"), "event_type", "n_rows", "first_id")


def sql_scalars(spark, folder) -> DataFrame:
    """The library's functions called from SQL text."""
    surface.register(spark)
    return spark.sql(
        "SELECT c_custkey, mask_identifier(c_name) AS masked, normalize_text(c_mktsegment) AS segment, extract_product_id(concat('https://s.example/x-i.1.', c_custkey)) AS product FROM {c}",
        c=table(spark, folder, "customer"),
    )


def sql_reviews(spark, folder) -> DataFrame:
    """Review rows of payloads after LATERAL: one payload per conversation turn, with the review twice over."""
    surface.register(spark)
    review = F.struct(F.col("text").alias("content"), F.col("turn").alias("score"), F.col("role").alias("username"))
    payload = F.to_json(F.struct(F.struct(F.array(review, review).alias("ratings")).alias("data")))
    turns = table(spark, folder, "conversations").select("conv_id", "turn", payload.alias("payload"))
    return spark.sql("SELECT conv_id, turn, r.review_text, r.star_rating, r.reviewer_name_masked FROM {t}, LATERAL review_rows(payload) AS r", t=turns)


QUERIES = {
    fn.__name__: fn
    for fn in (
        clean_reviews, clean_products, keep_first, review_features, review_order, input_order, product_rollup,
        product_metadata, product_aggregates, density, price_bands, sold_bands, template_keys, numbers,
        mask_names, hash_text, product_ids, visible_text, unescape_text, block_inspection, block_reasons,
        link_discovery, resolved_urls, meta_tags, product_snapshot, seed_category, json_blobs, json_nodes,
        deep_find, reviews_html, review_candidates, reviews_payload, reviews_rendered, shell_pages,
        streak_cut, review_cap, stop_fast, ordered_cuts, budget, empty_streak, run_summary, source_choice,
        payload_numbers, link_match, missing_links, seed_template, seeds, export_round_trip,
        manifest_round_trip, page_file_round_trip, all_files_to_pages, all_captured_files, snapshot_job, harvest_job,
        harvest_dropped, plain_harvest, clean_job, stage_manifest, features_job, features_job_reviews,
        asof_orders, asof_recent, visits, overlapping_visits, incremental_keep_first, incremental_clean,
        json_walk, json_walk_find, page_source, payload_source, breadcrumb_levels, sketched_events,
        stream_streak_cut, stream_windows, sql_scalars, sql_reviews, emoji_runs,
    )
}
