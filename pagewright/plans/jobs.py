"""The four end-to-end jobs over stored pages and stage tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import html as hx
from pagewright.operators import clean, features, log, pages as pg
from pagewright.operators.hotkeys import number_rows
from pagewright.schemas import CRAWL_MANIFEST, PRODUCT_SNAPSHOTS, REVIEWS_RAW
from pagewright.sources import incremental, io
from pagewright.sources.storage import stored


def manifest_rows(rows: DataFrame, stage: str, scrape_time: str) -> DataFrame:
    """Log rows in manifest form; fetch measures that were not stored are NULL."""
    known = rows.withColumns({"stage": F.lit(stage), "scrape_time": F.lit(scrape_time)})
    return known.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in known.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in CRAWL_MANIFEST
        ]
    )


def snapshot_products(
    seeds: DataFrame,
    pages: DataFrame,
    scrape_time: str,
    stop_on_status=pg.STOP_STATUS,
    stop_on_keywords=None,
) -> dict[str, DataFrame]:
    """Product snapshots of the seeds' stored pages, up to the first blocked page.

    Pages are those of the product stage where they have a ``stage``; of several with one URL the one
    with the smallest page_id counts. Returns ``products``, ``manifest`` (the blocked page included),
    ``summary`` and ``missing`` (seeds without a stored page). ``seeds`` carry their order in ``ord``.
    """
    judged = pg.inspect_blocks(_of_stage(pages, "product_snapshot"), stop_on_status, stop_on_keywords)
    parsed = pg.parse_product_snapshots(judged, scrape_time).drop("page_no", "stage")
    # the narrow pass over the pages runs once; only its small result is joined and cut
    found = stored(clean.keep_first(parsed, ["product_url"], "page_id"), "snapshots")
    own = ["ord", "product_url", *(["category_quota"] if "category_quota" in seeds.columns else [])]
    wanted = seeds.select(*own)
    read = wanted.join(found, "product_url").withColumn("seq", F.col("ord"))
    kept = log.stop_once(read)
    columns = list(PRODUCT_SNAPSHOTS.names)
    good = kept.filter(F.col("stop_reason").isNull())
    if "category_quota" in own:
        good = good.withColumnRenamed("category_quota", "seed_category_quota")
        columns.append("seed_category_quota")
    counted = kept.select("seq", "stop_reason", F.lit(1).alias("n"))
    return {
        "products": good.select("ord", *columns),
        "manifest": manifest_rows(
            kept.withColumn("source_url", F.col("product_url")), "product_snapshot", scrape_time
        ),
        "summary": log.run_summary(counted, keys=()),
        "missing": wanted.join(found.select("product_url"), "product_url", "left_anti"),
    }


def _of_stage(pages: DataFrame, stage: str) -> DataFrame:
    return pages.filter(F.col("stage") == stage) if "stage" in pages.columns else pages


def _rows(read: DataFrame, source_url: Column) -> DataFrame:
    """Review rows of log rows that carry ``reviews`` arrays."""
    flat = read.withColumns(
        {
            "product_id": hx.extract_product_id(F.col("product_url")),
            "review_page": F.col("page_no").cast("int"),
            "source_url": source_url,
        }
    )
    kept = ["seed", "page_no", "product_id", "review_page", "source_url", "response_hash", "scrape_time"]
    flat = pg.unfold(flat, kept, F.col("reviews"), "review_ord", "r")
    taken = {"purchase_variant": F.col("r.variant_text")}
    taken |= {n: F.col(f"r.{n}") for n in flat.schema["r"].dataType.names}
    table = [taken[n].alias(n) if n in taken else F.col(n) for n in REVIEWS_RAW.names]
    return flat.select("seed", "page_no", "review_ord", *table)


def harvest_reviews(
    seeds: DataFrame,
    pages: DataFrame,
    scrape_time: str,
    payloads: DataFrame | None = None,
    rendered: DataFrame | None = None,
    max_pages_per_product: int | None = None,
    max_reviews_per_product: int | None = None,
    max_empty_pages: int | None = None,
    stop_on_status=pg.STOP_STATUS,
    stop_on_keywords=None,
    fallback_enabled: bool = True,
) -> dict[str, DataFrame]:
    """Review rows of the seeds from their stored pages.

    Pages are those of the review stage where they have a ``stage``; of several with one URL the one
    with the smallest page_id counts. ``payloads`` (product_url, payload_no, source_url, payload) and
    ``rendered`` (product_url, html, source_url) are what was captured for shell pages. Limits are off
    unless given. Returns ``reviews``, ``manifest``, ``summary``, ``missing`` (seed pages and links
    without a stored page), ``dropped`` (pages that a given limit cut) and ``skipped`` (pages with JSON
    that could not be read).
    """
    mine = _of_stage(pages, "review_harvest")
    facts = pg.page_facts(mine, scrape_time, max_pages_per_product, stop_on_status, stop_on_keywords)
    facts = facts.withColumns({"scrape_time": F.lit(scrape_time), "_stored": F.monotonically_increasing_id()})
    facts = stored(facts, "facts")
    # review arrays stay behind until it is known which pages are read
    slim = log.one_per_url(facts.drop("reviews"), "page_id")
    wanted = seeds.select(F.col("ord").alias("seed"), "product_url")
    first = wanted.join(slim.withColumn("product_url", F.col("url")), "product_url")
    first = first.withColumn("page_no", F.lit(1))

    # best source of each shell page; its rows replace the listed pages
    picked = None
    if fallback_enabled and (payloads is not None or rendered is not None):
        shells = first.filter(F.col("shell_reason").isNotNull()).select("seed", "product_url")
        empty = _rows(first.limit(0).join(facts.select("_stored", "reviews"), "_stored"), F.col("url"))
        captured, cards = empty.withColumn("payload_no", F.lit(None).cast("int")), empty
        if payloads is not None:
            own = payloads.withColumn("url", F.col("product_url")).join(shells, "product_url")
            parsed = pg.parse_payload_reviews(own.drop("page_no"), scrape_time).withColumn("page_no", F.lit(1))
            captured = log.number_payloads(stored(parsed, "payloads"))
        if rendered is not None:
            own = rendered.withColumn("url", F.col("product_url")).join(shells, "product_url")
            cards = pg.parse_rendered_reviews(own.drop("page_no"), scrape_time).withColumn("page_no", F.lit(1))
            cards = stored(cards, "cards")
        picked = log.choose_source(shells, captured, cards, cards.limit(0)).drop("source", "product_url")
        picked = stored(picked, "picked")
        found = picked.groupBy("seed").agg(F.count("*").alias("picked_rows"))
        first = first.join(found, "seed", "left")
    else:
        first = first.withColumn("picked_rows", F.lit(None).cast("long"))

    listed = first.filter(F.col("picked_rows").isNull()).select(
        "seed", "product_url", F.posexplode("links").alias("at", "link")
    )
    listed = listed.filter(F.col("at") > 0).select(
        "seed", "product_url", (F.col("at") + 1).alias("page_no"), "link"
    )
    later = log.match_links(listed, slim).withColumnRenamed("link", "url")
    later = later.withColumn("picked_rows", F.lit(None).cast("long"))

    columns = ["seed", "product_url", "page_no", "url", "final_url", "picked_rows", "n", "_stored",
               *[c for c in slim.columns if c not in ("url", "final_url", "links", "stage", "n", "_stored",
                                                      "page_id", "product_idx", "source_url", "page_no")]]
    read = log.append_rows(first.select(*columns), later.select(*columns)).withColumns(
        {
            "seq": F.struct("seed", "page_no"),
            "product_id": hx.extract_product_id(F.col("product_url")),
            "n": F.coalesce("picked_rows", "n"),
            "exempt": F.col("picked_rows").isNotNull(),
        }
    )
    read = stored(read, "read")
    cut = log.streak_cut(read, max_empty_pages, ["seed"])
    cut = log.review_cap_cut(cut, max_reviews_per_product, ["product_id"])
    kept = log.stop_once(cut)
    good = kept.filter(F.col("stop_reason").isNull())

    source = F.when(F.col("page_no") == 1, F.col("final_url")).otherwise(F.col("url"))
    own = good.filter(~F.col("exempt")).join(facts.select("_stored", "reviews"), "_stored")
    reviews = _rows(own, source)
    if picked is not None:
        reached = good.filter("exempt").select("seed")
        reviews = log.append_rows(reviews, picked.join(reached, "seed", "left_semi"))
    missing = log.append_rows(
        wanted.join(slim.select(F.col("url").alias("product_url")), "product_url", "left_anti"),
        log.missing_links(listed, slim).select("seed", F.col("link").alias("product_url")),
    )
    page = ["seed", "page_no"]
    dropped = read.select(*page, "url", "n")
    cut_off = max_empty_pages is not None or max_reviews_per_product is not None
    return {
        "reviews": reviews.select("seed", "page_no", "review_ord", *REVIEWS_RAW.names),
        "manifest": manifest_rows(kept.withColumn("source_url", F.col("url")), "review_harvest", scrape_time),
        "summary": log.run_summary(kept, keys=()),
        "missing": missing,
        "dropped": dropped.join(cut.select(*page), page, "left_anti") if cut_off else dropped.limit(0),
        "skipped": slim.filter("skipped_json > 0").select("url", "skipped_json"),
    }


def write_job(found: dict[str, DataFrame], interim: str, table: str, manifest: str) -> dict:
    """Store what a job over pages found: the stage table with its order, the summary, and the manifest
    rows, which are appended."""
    rows = found[table]
    if "ord" not in rows.columns:
        rows = number_rows(rows, ["seed", "page_no", "review_ord"], "ord", start=0)
        rows = rows.drop("seed", "page_no", "review_ord")
    name = {"products": "product_snapshots", "reviews": "reviews_raw"}[table]
    n = io.write_stage(rows, f"{interim}/{name}.parquet")
    found["summary"].coalesce(1).write.mode("overwrite").json(f"{interim}/{name}_summary.json")
    io.append_manifest(found["manifest"], manifest)
    return {"rows": n, "table": f"{interim}/{name}.parquet"}


def clean_validate(spark, interim: str, processed: str) -> dict:
    """Clean the interim tables and export them with a manifest of counts and paths. Which copy of a row
    is the first, and the order after it, is their ``ord``."""
    products = io.read_stage(spark, f"{interim}/product_snapshots", PRODUCT_SNAPSHOTS)
    reviews = io.read_stage(spark, f"{interim}/reviews_raw", REVIEWS_RAW)
    exports = {
        "product_export": io.export_table(clean.clean_products(products, "ord"), f"{processed}/products.parquet"),
        "review_export": io.export_table(clean.clean_reviews(reviews, "ord"), f"{processed}/reviews.parquet"),
    }
    counts = {
        "products_rows": exports["product_export"]["rows"],
        "reviews_rows": exports["review_export"]["rows"],
    }
    return io.write_stage_manifest(spark, {**counts, **exports}, f"{processed}/crawl_manifest.json")


def review_store(spark, path: str, reviews, **sizes) -> incremental.Store:
    """A new, empty store of cleaned reviews for raw ones with the columns of ``reviews``."""
    schema = clean.treated_reviews(reviews).schema
    keys = [c for c in clean.REVIEW_KEY if c in schema.names]
    return incremental.create_store(spark, path, schema, keys, "ord", **sizes)


def merge_reviews(store: incremental.Store, reviews) -> dict[str, int]:
    """Clean the reviews of one more harvest and merge them into the store, which then holds what
    :func:`pagewright.operators.clean.clean_reviews` gives for all harvests together. Only the new rows are
    cleaned, and only slices with a change are written."""
    return incremental.merge(store, clean.treated_reviews(reviews))


def metadata_features(spark, processed: str) -> dict:
    """Review features and product aggregates of the cleaned tables, exported with a manifest. The
    features are stored first and the aggregates read them back, so they are computed once."""
    for name in ("products", "reviews"):
        if not io.exists(spark, f"{processed}/{name}.parquet"):
            raise FileNotFoundError(f"there is no {processed}/{name}.parquet; run clean_validate before")
    products = spark.read.parquet(f"{processed}/products.parquet")
    reviews = spark.read.parquet(f"{processed}/reviews.parquet")
    review_export = io.export_table(
        features.build_review_features(reviews, "ord", stable=True), f"{processed}/review_features.parquet"
    )
    feature_rows = spark.read.parquet(f"{processed}/review_features.parquet")
    aggregates = features.assemble_aggregates(features.product_rollup(feature_rows), products, "ord")
    product_export = io.export_table(aggregates, f"{processed}/product_aggregates.parquet")
    summary = {
        "review_features_rows": review_export["rows"],
        "product_aggregates_rows": product_export["rows"],
        "review_export": review_export,
        "product_export": product_export,
    }
    return io.write_stage_manifest(spark, summary, f"{processed}/feature_manifest.json")
