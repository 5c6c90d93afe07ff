"""Review page analytics on Spark."""

from pagewright.operators.clean import clean_products, clean_reviews
from pagewright.operators.features import build_product_aggregates, build_review_features
from pagewright.operators.pages import (
    detect_shell_pages,
    discover_links,
    inspect_blocks,
    parse_payload_reviews,
    parse_product_snapshots,
    parse_rendered_reviews,
    parse_reviews,
)
from pagewright.plans.jobs import (
    clean_validate,
    harvest_reviews,
    metadata_features,
    snapshot_products,
)

__all__ = [
    "build_product_aggregates",
    "build_review_features",
    "clean_products",
    "clean_reviews",
    "clean_validate",
    "detect_shell_pages",
    "discover_links",
    "harvest_reviews",
    "inspect_blocks",
    "metadata_features",
    "parse_payload_reviews",
    "parse_product_snapshots",
    "parse_rendered_reviews",
    "parse_reviews",
    "snapshot_products",
]
