"""Declared table schemas. Identifiers stay text so that no stage can turn them into numbers."""

from pyspark.sql import types as T


def _fields(spec: str) -> T.StructType:
    """Build a schema from ``name[:type]`` words; the type defaults to string."""
    types = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "double": T.DoubleType(),
        "boolean": T.BooleanType(),
    }
    out = T.StructType()
    for word in spec.split():
        name, _, kind = word.partition(":")
        out = out.add(name, types[kind or "string"])
    return out


PAGES = _fields(
    "page_id:long url final_url status_code:int stage product_idx:int page_no:int html"
)

PRODUCT_SNAPSHOTS = _fields(
    "product_id product_url scrape_time title category_breadcrumb price_display "
    "discount_display sold_count_display rating_avg_display rating_count_display shop_name "
    "shop_url shop_location follower_count_display stock_display variant_summary "
    "product_description parse_status required_field_completeness:double response_hash"
)

REVIEWS_RAW = _fields(
    "product_id review_page:int scrape_time review_text star_rating review_time_display "
    "variant_text media_flag:boolean seller_reply_flag:boolean reviewer_name_masked "
    "helpful_count_display purchase_variant image_count:int video_flag:boolean "
    "response_hash source_url"
)

CRAWL_MANIFEST = _fields(
    "stage source_url final_url status_code:int elapsed_s:double size_bytes:long error "
    "stop_reason stop_signal_class stop_signal_source stop_matched_text scrape_time"
)
