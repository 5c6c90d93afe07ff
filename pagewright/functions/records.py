"""Product fields and review rows out of a page's node array (see ``jsontree``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions import html as hx
from pagewright.functions import jsontree as jt
from pagewright.functions import text as tx

# For each product field the keys that may hold it, best key first.
PRODUCT_ALIASES = {
    "title": ("title", "name", "product_name"),
    "price_display": ("price", "price_display", "price_min", "price_max"),
    "discount_display": ("discount", "discount_display", "discount_percent"),
    "sold_count_display": ("sold", "historical_sold", "sold_count"),
    "rating_avg_display": ("rating", "rating_star", "rating_avg", "rating_value"),
    "rating_count_display": ("review_count", "rating_count", "cmt_count"),
    "shop_name": ("shop_name", "seller_name", "merchant_name", "shop"),
    "shop_url": ("shop_url", "seller_url"),
    "product_description": ("description", "product_description"),
    "variant_summary": ("variation", "variant", "model_name"),
    "stock_display": ("stock", "stock_count"),
    "follower_count_display": ("follower_count", "followers"),
    "shop_location": ("shop_location", "location"),
}

# The fields that count towards completeness, and the share that makes a page "ok".
REQUIRED_FIELDS = (
    "product_id",
    "product_url",
    "scrape_time",
    "title",
    "category_breadcrumb",
    "price_display",
    "rating_avg_display",
    "rating_count_display",
    "shop_name",
)
OK_SHARE = 0.5

# Keys of a review object in order of trust, by what they mean.
TEXT_KEYS = ("comment", "comment_text", "content", "review_text", "review", "text", "message")
STAR_KEYS = ("rating_star", "rating", "score", "star")
TIME_KEYS = ("ctime", "created_at", "time", "date", "mtime")
VARIANT_KEYS = ("variation", "variant", "model_name", "purchase_variant")
REVIEWER_KEYS = ("author", "username", "buyer_username", "user_name")
HELPFUL_KEYS = ("helpful_count", "liked_count", "upvote_count")
REPLY_KEYS = ("seller_reply", "reply", "shop_reply")
IMAGE_KEYS = ("images", "image_urls")
VIDEO_KEYS = ("videos", "video_info_list")

# Keys that make an object with a text key look like a review, and keys whose list
# holds reviews.
CONTEXT_KEYS = (
    *STAR_KEYS,
    *TIME_KEYS,
    *REVIEWER_KEYS,
    "variation",
    "variant",
    "model_name",
    *IMAGE_KEYS,
    *VIDEO_KEYS,
)
CONTAINER_KEYS = ("comments", "item_rating", "ratings", "reviews", "review_list")

_USED_KEYS = (
    TEXT_KEYS + STAR_KEYS + TIME_KEYS + VARIANT_KEYS + REVIEWER_KEYS + HELPFUL_KEYS + REPLY_KEYS
    + IMAGE_KEYS + VIDEO_KEYS
)

# Patterns over the text of a rendered review card (white space already collapsed).
CARD_STAR = r"(?i)([1-5])(?:\s*/\s*5|\s*bintang|\s*star)"
CARD_VARIANT = r"(?i)(variasi|variant)[:\s]+([^\n|]+)"
CARD_TIME = r"(?iU)(\d{4}-\d{2}-\d{2}|\d{1,2}\s+\w+\s+\d{4})"
CARD_HELPFUL = r"(?iU)(\d+)\s*(orang|helpful|terbantu|like)"
CARD_REPLY = r"(?i)balasan penjual|seller reply|shop reply"
CARD_MIN_CHARS = 8


def _in(value: str, words) -> str:
    return f"{value} IN ({', '.join(repr(word) for word in words)})"


def alias_hits(nodes: str) -> Column:
    """array<struct<pos, key, text>>: non-blank scalars under any product alias, document order."""
    known = sorted({alias for aliases in PRODUCT_ALIASES.values() for alias in aliases})
    named = f"filter({nodes}, n -> {_in('lower(n.key)', known)} AND {jt.IS_SCALAR.format('n')})"
    hits = (
        f"transform({named}, n -> named_struct('pos', n.pos, 'key', lower(n.key),"
        f" 'text', {tx.sql_strip('n.text')}))"
    )
    return F.expr(f"array_sort(filter({hits}, hit -> hit.text <> ''))")


def by_alias(hits: str, field: str) -> Column:
    """Value of a product field from the ``alias_hits`` column named ``hits``: alias order first,
    document order within an alias."""
    picks = [f"get(filter({hits}, hit -> hit.key = '{a}'), 0).text" for a in PRODUCT_ALIASES[field]]
    return F.expr(f"coalesce({', '.join(picks)})")


def _typed_roots(nodes: str, name: str) -> str:
    """Root objects whose ``@type`` is the given text."""
    tag = tx.sql_let(jt.member(nodes, "r", "@type"), "tag", f"tag.kind = 'str' AND tag.text = '{name}'")
    return f"filter({jt.roots(nodes)}, r -> r.kind = 'dict' AND {tag})"


def breadcrumb(nodes: str, metas: Column) -> Column:
    """Names of the first breadcrumb object that has any, else the category meta tags."""
    items = tx.sql_let(
        jt.member(nodes, "b", "itemListElement"), "items",
        f"filter({jt.children(nodes, 'items')}, i -> i.kind = 'dict')",
    )
    name = tx.sql_strip(jt.truthy_text(jt.member(nodes, "i", "name")))
    names = f"filter(transform({items}, i -> {name}), v -> v IS NOT NULL)"
    trail = tx.sql_let(names, "some", "CASE WHEN size(some) > 0 THEN array_join(some, ' > ') END")
    trails = f"transform({_typed_roots(nodes, 'BreadcrumbList')}, b -> {trail})"
    first = F.expr(f"get(filter({trails}, v -> v IS NOT NULL), 0)")
    return F.coalesce(first, hx.last_meta(metas, "og:category", "product:category"))


def product_objects(nodes: str) -> Column:
    """array<struct> with the usable fields of each ld+json product object, document order."""

    def inner(outer: str, key: str) -> str:
        found = f"CASE WHEN box.kind = 'dict' THEN {jt.member(nodes, 'box', key)} END"
        return tx.sql_let(jt.member(nodes, "p", outer), "box", found)

    def trimmed(node: str) -> str:
        return tx.sql_non_empty(tx.sql_strip(jt.truthy_text(node)))

    fields = {
        "title": jt.truthy_text(jt.member(nodes, "p", "name")),
        "product_description": jt.truthy_text(jt.member(nodes, "p", "description")),
        "rating_avg_display": trimmed(inner("aggregateRating", "ratingValue")),
        "rating_count_display": trimmed(inner("aggregateRating", "reviewCount")),
        "price_display": trimmed(inner("offers", "price")),
        "shop_name": jt.truthy_text(inner("brand", "name")),
    }
    return F.expr(f"transform({_typed_roots(nodes, 'Product')}, p -> {_struct(fields)})")


def _struct(fields: dict[str, str]) -> str:
    return f"named_struct({', '.join(f'{name!r}, {value}' for name, value in fields.items())})"


def from_objects(objects: str, field: str) -> Column:
    """First value of a field over the ``product_objects`` column named ``objects``."""
    return F.expr(f"get(filter(transform({objects}, o -> o.{field}), v -> v IS NOT NULL), 0)")


def candidates(nodes: str) -> Column:
    return F.expr(candidates_sql(nodes))


def candidates_sql(nodes: str) -> str:
    """array<struct<anchor, item, first, size>> of objects that may be reviews, in reading order.

    An object qualifies by its keys, and again by standing in a list under a container key; the
    objects of such a list are read before anything inside them.
    """

    def place(anchor: str, item: str) -> str:
        return _struct({"anchor": anchor, "item": item, "first": "n.first", "size": "n.size"})

    keys = f"transform({jt.children(nodes, 'n')}, child -> lower(child.key))"
    fits = tx.sql_let(
        keys, "k", f"exists(k, x -> {_in('x', TEXT_KEYS)}) AND exists(k, x -> {_in('x', CONTEXT_KEYS)})"
    )
    by_keys = f"transform({nodes}, n -> CASE WHEN n.kind = 'dict' AND {fits} THEN {place('n.pos', '-1')} END)"
    hit = f"up.kind = 'list' AND {_in('lower(up.key)', CONTAINER_KEYS)}"
    in_list = tx.sql_let(f"get({nodes}, n.up)", "up", f"CASE WHEN {hit} THEN {place('up.pos', 'i')} END")
    by_container = f"transform({nodes}, (n, i) -> CASE WHEN n.kind = 'dict' THEN {in_list} END)"
    return f"array_sort(filter(concat({by_keys}, {by_container}), c -> c IS NOT NULL))"


def candidate_fields(nodes: str, found: str) -> Column:
    return F.expr(candidate_fields_sql(nodes, found))


def candidate_fields_sql(nodes: str, found: str) -> str:
    """array<map<key, struct<kind, text, size, plain, truthy>>>: the fields of each candidate that rows use.
    ``plain`` is the trimmed text of a scalar that is not blank."""
    used = f"filter({jt.children(nodes, 'c')}, n -> {_in('n.key', sorted(set(_USED_KEYS)))})"
    parts = {"kind": "n.kind", "text": "n.text", "size": "n.size", "plain": jt.scalar_text("n"), "truthy": jt.truthy("n")}
    entry = f"struct(n.key, {_struct(parts)})"
    return f"transform({found}, c -> map_from_entries(transform({used}, n -> {entry})))"


def _field(key: str) -> str:
    return f"try_element_at(f, '{key}')"


def _first(keys) -> str:
    """First non-blank scalar under the keys, trimmed (exact-case keys, in order)."""
    return f"coalesce({', '.join(f'{_field(key)}.plain' for key in keys)})"


def _first_truthy(keys, pick: str, default: str) -> str:
    """``pick`` of the first truthy value ``{n}`` under the keys, else the default."""
    picked = [f"CASE WHEN {_field(key)}.truthy THEN {pick.format(n=_field(key))} END" for key in keys]
    return f"coalesce({', '.join(picked)}, {default})"


def reviews_of(fields: str) -> Column:
    return F.expr(reviews_sql(fields))


def reviews_sql(fields: str) -> str:
    """Candidate fields as review structs; ``review_text`` is NULL when one has no text."""
    count = "CASE WHEN {n}.kind = 'list' THEN {n}.size ELSE 0 END"
    columns = {
        "review_text": _first(TEXT_KEYS),
        "star_rating": _first(STAR_KEYS),
        "review_time_display": _first(TIME_KEYS),
        "variant_text": _first(VARIANT_KEYS),
        "media_flag": _first_truthy(IMAGE_KEYS + VIDEO_KEYS, "true", "false"),
        "seller_reply_flag": _first_truthy(REPLY_KEYS, "NOT ({n}.kind = 'str' AND {n}.text = '0')", "false"),
        "reviewer_name_masked": _first(REVIEWER_KEYS),
        "helpful_count_display": _first(HELPFUL_KEYS),
        "image_count": _first_truthy(IMAGE_KEYS, count, "0"),
        "video_flag": _first_truthy(VIDEO_KEYS, "true", "false"),
    }
    return f"transform({fields}, f -> {_struct(columns)})"


def card_reviews(html: Column) -> Column:
    """array of review structs from rendered review cards."""
    none = F.lit(None).cast("string")

    def hit(text: Column, pattern: str, group: int) -> Column:
        return tx.non_empty(tx.strip(F.regexp_extract(text, pattern, group)))

    def card(block: Column) -> Column:
        return F.struct(block.alias("block"), hx.strip_tags(block).alias("text"))

    def review(c: Column) -> Column:
        block, text = c["block"], c["text"]
        images = F.regexp_count(block, F.lit(r"(?i)<img\b"))
        videos = F.regexp_count(block, F.lit(r"(?i)<video\b"))
        return F.struct(
            text.alias("review_text"),
            hit(text, CARD_STAR, 1).alias("star_rating"),
            hit(text, CARD_TIME, 1).alias("review_time_display"),
            hit(text, CARD_VARIANT, 2).alias("variant_text"),
            ((images > 0) | (videos > 0)).alias("media_flag"),
            block.rlike(CARD_REPLY).alias("seller_reply_flag"),
            none.alias("reviewer_name_masked"),
            hit(text, CARD_HELPFUL, 1).alias("helpful_count_display"),
            images.alias("image_count"),
            (videos > 0).alias("video_flag"),
        )

    cards = F.transform(F.regexp_extract_all(html, F.lit(hx.REVIEW_CARD), F.lit(1)), card)
    return F.transform(F.filter(cards, lambda c: F.length(c["text"]) >= CARD_MIN_CHARS), review)


def keyed_reviews(rows: Column, product_id: Column, page_no: Column) -> Column:
    """Rows that have a text, as array<struct<key, at, row>> sorted by key, then by place. ``key``
    is the identity of a review within a page."""

    def keyed(row: Column, at: Column) -> Column:
        identity = F.concat_ws(
            "|",
            product_id,
            page_no.cast("string"),
            row["review_text"],
            F.coalesce(row["star_rating"], F.lit("")),
            F.coalesce(row["review_time_display"], F.lit("")),
        )
        return F.struct(tx.stable_hash(identity).alias("key"), at.alias("at"), row.alias("row"))

    with_text = F.filter(rows, lambda row: row["review_text"].isNotNull())
    return F.array_sort(F.transform(with_text, keyed))


def first_of_each(keyed: Column) -> Column:
    """Keep the first row of each key and restore reading order. ``keyed`` must be a plain column:
    equal keys are neighbours, so one look back decides."""
    kept = F.filter(keyed, lambda r, i: (i == 0) | (r["key"] != F.get(keyed, i - 1)["key"]))
    in_order = F.array_sort(F.transform(kept, lambda r: F.struct(r["at"], r["row"])))
    return F.transform(in_order, lambda r: r["row"])
