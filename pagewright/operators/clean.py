"""Cleaning and de-duplication of product and review tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.functions import text as tx
from pagewright.sources.storage import stored

# Which columns get which treatment, and what makes two rows the same.
PRODUCT_TEXT = ("title", "category_breadcrumb", "shop_name", "product_description", "variant_summary")
PRODUCT_NUMERIC = ("rating_avg_display", "rating_count_display", "sold_count_display")
PRODUCT_KEY = ("product_id", "product_url")
REVIEW_TEXT = ("review_text", "variant_text", "purchase_variant", "review_time_display")
REVIEW_FLAGS = ("media_flag", "seller_reply_flag")
REVIEW_KEY = ("product_id", "normalized_review_text", "review_time_display", "star_rating")

ORD = "_ord"


def with_order(df: DataFrame, order_by: str | None) -> tuple[DataFrame, str]:
    """The table with a column that holds its input order: the caller's, or the read order. The latter
    follows the files only if there is one, so a read of several files needs ``order_by``. It is written
    down, as a second pass over the plan could give other numbers."""
    if order_by is not None:
        return df, order_by
    if len(df.inputFiles()) > 1:
        raise ValueError("the table comes from several files; name the column of its order in order_by")
    return stored(df.withColumn(ORD, F.monotonically_increasing_id()), "ordered"), ORD


def column_or(df: DataFrame, name: str, default) -> Column:
    """The column when the table has it, else the default."""
    return F.col(name) if name in df.columns else F.lit(default)


def number_column(df: DataFrame, name: str) -> Column:
    """The column as double; text is parsed, invalid text is NULL."""
    kind = df.schema[name].dataType
    return F.col(name).cast("double") if isinstance(kind, T.NumericType) else tx.to_number(F.col(name))


def key_digest(keys) -> Column:
    """The keys as 32 bytes; NULL keys equal each other. Keys may be whole texts."""
    parts = [F.sha2(F.col(k).cast("string"), 256).alias(k) for k in keys]
    return F.unhex(F.sha2(F.to_json(F.struct(*parts)), 256))


def keep_first(df: DataFrame, keys, order_by: str) -> DataFrame:
    """One row per key combination, the first by ``order_by`` (NULL last); NULL keys equal each other.
    ``order_by`` tells the rows of a key apart; rows equal in both all stay.

    The smallest order per digest of the keys is a hash aggregate of fixed width, in which copies meet in
    their own partition first. The rows are then picked by (digest, order), which differ from row to row, so
    a key with very many copies is no large group anywhere and no whole row is sorted for the aggregate.
    """
    key, first = "_key_digest", "_first_order"
    keyed = df.withColumn(key, key_digest(keys))
    firsts = keyed.groupBy(F.col(key).alias("_digest")).agg(F.min(order_by).alias(first))
    same = (F.col(key) == F.col("_digest")) & F.col(order_by).eqNullSafe(F.col(first))
    return keyed.join(firsts, same, "left_semi").drop(key)


def clean_products(products: DataFrame, order_by: str | None = None) -> DataFrame:
    """Normalized product rows, first one per (product_id, product_url)."""
    have = set(products.columns)
    treated = {c: tx.normalize_text(F.col(c)) for c in PRODUCT_TEXT if c in have}
    treated |= {c: tx.strip(F.col(c).cast("string")) for c in PRODUCT_KEY if c in have}
    treated |= {c: tx.to_numeric_string(F.col(c)) for c in PRODUCT_NUMERIC if c in have}
    rows, order = with_order(products.withColumns(treated) if treated else products, order_by)
    return keep_first(rows, PRODUCT_KEY, order).drop(ORD)


def treated_reviews(reviews: DataFrame) -> DataFrame:
    """Normalized and masked review rows, copies included."""
    have = set(reviews.columns)
    treated = {c: tx.normalize_text(F.col(c)) for c in REVIEW_TEXT if c in have}
    if "reviewer_name_masked" in have:
        treated["reviewer_name_masked"] = tx.mask_identifier(F.col("reviewer_name_masked"))
    if "star_rating" in have:
        treated["star_rating"] = number_column(reviews, "star_rating")
    treated |= {c: tx.fill_flag(F.col(c)) for c in REVIEW_FLAGS if c in have}
    treated["normalized_review_text"] = tx.normalize_text(F.col("review_text"))
    return reviews.withColumns(treated)


def clean_reviews(reviews: DataFrame, order_by: str | None = None) -> DataFrame:
    """Normalized and masked review rows, first one per product, text, time and star."""
    rows, order = with_order(treated_reviews(reviews), order_by)
    # the treated text is the normalized one, so one of the two is shuffled
    keys = ["review_text" if c == "normalized_review_text" else c for c in REVIEW_KEY if c in rows.columns]
    first = keep_first(rows.drop("normalized_review_text"), keys, order)
    return first.withColumn("normalized_review_text", F.col("review_text")).select(*rows.columns).drop(ORD)
