"""Review features and product aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as tx
from pagewright.operators import hotkeys
from pagewright.operators.clean import ORD, column_or, keep_first, number_column, with_order
from pagewright.sources.storage import ensure_checkpoint_dir

# Product columns that go into the aggregates, and the fill value of each measure.
METADATA = (
    "product_id", "category_breadcrumb", "rating_avg_display", "rating_count_display", "price_band",
    "sold_count_band",
)
RATIOS = ("duplicate_ratio", "extreme_rating_ratio", "short_review_ratio", "near_template_ratio")


def text_features(reviews: DataFrame) -> DataFrame:
    """Add the per-row features, all of one projection; missing optional columns take defaults."""
    text = column_or(reviews, "review_text", "")
    extreme = F.lit(False)
    if "star_rating" in reviews.columns:
        extreme = tx.extreme_rating_flag(number_column(reviews, "star_rating"))
    return reviews.withColumns(
        {
            "review_text": tx.text_of(text),
            "normalized_review_text": tx.normalize_text(text),
            "text_length": tx.text_length(text),
            "emoji_count": tx.emoji_count(text),
            "repeated_char_ratio": tx.repeated_char_ratio(text),
            "exclamation_count": tx.exclamation_count(text),
            "variant_present_flag": tx.variant_present_flag(column_or(reviews, "variant_text", "")),
            "extreme_rating_flag": extreme,
            "short_review_flag": tx.short_review_flag(text),
        }
    )


def review_order(reviews: DataFrame, order_by: str | None = None, stable: bool = False) -> DataFrame:
    """Add ``relative_review_order``: 1, 2, ... per product by display time as text, ties by input
    order, NULL for a NULL product. Without both columns the rows are numbered in input order.

    ``stable`` says that the rows are the same each time they are read, as those of a stored table are. Their
    keys are then numbered without the rest, and the rows travel once, to their numbers."""
    name = "relative_review_order"
    rows, order = with_order(reviews, order_by)
    if not {"product_id", "review_time_display"} <= set(reviews.columns):
        return hotkeys.number_rows(rows, [order], name).drop(ORD)
    named = rows.filter(F.col("product_id").isNotNull())
    nameless = rows.filter(F.col("product_id").isNull()).withColumn(name, F.lit(None).cast("bigint"))
    if stable:
        return _numbered_by_key(named, ["review_time_display", order], name).unionByName(nameless).drop(ORD)
    chunks = hotkeys.chunk(named, ["product_id"], ["review_time_display", order])
    return chunks.numbered(name).done().unionByName(nameless).drop(ORD)


def _numbered_by_key(named: DataFrame, order: list[str], name: str) -> DataFrame:
    """1, 2, ... per product by ``order``, in which rows may be equal: their keys meet first, and each key knows
    how many rows come before it."""
    at = ["product_id", *order]
    keys = named.groupBy(*at).agg(F.count("*").alias("_rows"))
    before = hotkeys.chunk(keys, ["product_id"], order).running("_before", "sum", F.col("_rows"), exclusive=True).done()
    key = F.struct(*at).alias("_key")  # as one value, in which NULLs equal each other
    found = named.select("*", key).join(before.select(key, "_before"), "_key")
    inside = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))  # few rows have one key
    return found.withColumn(name, F.col("_before") + inside).drop("_key", "_before")


def build_review_features(reviews: DataFrame, order_by: str | None = None, stable: bool = False) -> DataFrame:
    """Reviews with all features. The order is computed on the raw columns, so the derived text is
    not carried through the sort; nor is one that an earlier step derived, as it is derived again.
    ``stable`` is that of :func:`review_order`."""
    derived = "normalized_review_text"
    found = text_features(review_order(reviews.drop(derived), order_by, stable))
    if derived not in reviews.columns:
        return found
    return found.select(*reviews.columns, *[c for c in found.columns if c not in reviews.columns])


def product_rollup(features: DataFrame) -> DataFrame:
    """Per product: reviews, share of repeated texts, of extreme ratings, of short reviews, and of
    texts that repeat once digits are masked.

    Three nested aggregates in place of two distinct counts: texts travel as digests, copies of a
    text meet before they are shuffled, and a product with very many reviews is spread over its
    texts until one number per text pattern is left.
    """
    template = tx.template_key(F.col("normalized_review_text"))
    digests = features.select(
        "product_id",
        F.unhex(F.sha2("normalized_review_text", 256)).alias("_text"),
        F.unhex(F.sha2(template, 256)).alias("_template"),
        F.col("extreme_rating_flag").cast("int").alias("_extreme"),
        F.col("short_review_flag").cast("int").alias("_short"),
    )
    sums = [F.sum("_n").alias("_n"), F.sum("_extreme").alias("_extreme"), F.sum("_short").alias("_short")]
    texts = digests.groupBy("product_id", "_text", "_template").agg(
        F.count("*").alias("_n"), F.sum("_extreme").alias("_extreme"), F.sum("_short").alias("_short")
    )
    templates = texts.groupBy("product_id", "_template").agg(F.count("*").alias("_texts"), *sums)
    totals = templates.groupBy("product_id").agg(
        F.count("*").alias("_templates"), F.sum("_texts").alias("_texts"), *sums
    )
    n = F.col("_n")
    return totals.select(
        "product_id",
        n.alias("review_count"),
        (1 - F.col("_texts") / n).alias("duplicate_ratio"),
        (F.col("_extreme") / n).alias("extreme_rating_ratio"),
        (F.col("_short") / n).alias("short_review_ratio"),
        (1 - F.col("_templates") / n).alias("near_template_ratio"),
    )


def product_metadata(products: DataFrame, order_by: str | None = None) -> DataFrame:
    """Known metadata columns plus price and sales bands, first row per product."""
    have = set(products.columns)
    bands = {
        "price_band": tx.price_band(F.col("price_display")) if "price_display" in have else F.lit("unknown"),
        "sold_count_band": (
            tx.sold_band(F.col("sold_count_display")) if "sold_count_display" in have else F.lit("unknown")
        ),
    }
    rows, order = with_order(products.withColumns(bands), order_by)
    kept = [c for c in METADATA if c in rows.columns]
    first = keep_first(rows.select(*kept, F.col(order).alias(ORD)), ["product_id"], ORD)
    return first.select(*kept)


def with_density(table: DataFrame) -> DataFrame:
    """Add the review count as a share of the largest one (0.0 when there are no reviews)."""
    largest = table.agg(F.max("review_count").alias("m")).scalar()
    share = F.coalesce(F.try_divide(F.col("review_count"), largest), F.lit(0.0))
    return table.withColumn("review_density_proxy", share)


def assemble_aggregates(
    rollup: DataFrame, products: DataFrame, products_order_by: str | None = None
) -> DataFrame:
    """Product metadata with its rollup, defaults for products without reviews, and the density.
    Reviews of unknown products drop out, unless no product is known at all."""
    merged = rollup
    if "product_id" in products.columns and not products.isEmpty():
        metadata = product_metadata(products, products_order_by)
        known = rollup.withColumnRenamed("product_id", "_product_id")
        same = F.col("product_id").eqNullSafe(F.col("_product_id"))
        merged = metadata.join(known, same, "left").drop("_product_id")
    merged = merged.fillna({"review_count": 0, **{ratio: 0.0 for ratio in RATIOS}})
    # one row per product; stored, because the largest count and the shares both need it
    ensure_checkpoint_dir(merged.sparkSession)
    return with_density(merged.checkpoint())


def build_product_aggregates(
    reviews: DataFrame,
    products: DataFrame,
    products_order_by: str | None = None,
) -> DataFrame:
    """Product aggregates from raw reviews and products; the review order is not needed here and so
    not computed."""
    if "product_id" not in reviews.columns:
        reviews = reviews.withColumn("product_id", F.lit(None).cast("string")).limit(0)
    return assemble_aggregates(product_rollup(text_features(reviews)), products, products_order_by)
