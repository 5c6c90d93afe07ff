"""Page extraction. Every operator is a narrow projection over the page table: a page is read,
parsed and reduced to rows inside its own partition, with no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import html as hx
from pagewright.functions import jsontree as jt
from pagewright.functions import records as rx
from pagewright.functions import text as tx
from pagewright.operators.clean import keep_first, with_order
from pagewright.schemas import PRODUCT_SNAPSHOTS, REVIEWS_RAW

# Block markers in search order, and those that count in the title only.
BLOCK_MARKERS = ("captcha", "verify you are human", "access denied", "forbidden", "login", "sign in")
TITLE_ONLY_MARKERS = ("login", "sign in")
STOP_STATUS = (403, 429)

# What a page that has no content of its own looks like.
SHELL_DIVS = ('id="main"', "id='main'")
SHELL_MARKERS = ("text/shopee-page-manifest", "window.__ASSETS__")
SHELL_TEXT_CHARS = 400
SHELL_PRODUCT_FIELDS = ("title", "price_display", "rating_avg_display", "shop_name", "product_description")
SHELL_SIGNALS = 4
SHELL_REASON = "shell_page_no_embedded_reviews"


def _with_nodes(pages: DataFrame, keep_json=()) -> DataFrame:
    """Add ``_nodes``, the node array of all JSON embedded in the page."""
    return pages.withColumn("_texts", hx.json_texts(tx.text_of(F.col("html")))).withColumn(
        "_nodes", jt.json_nodes(F.col("_texts"), keep_json)
    )


def unfold(rows: DataFrame, keep, array, at: str, item: str) -> DataFrame:
    """One row per array element with its index. The outer form with a filter on the index, because
    for the plain one the optimizer adds a size filter that repeats the whole array expression."""
    flat = rows.select(*keep, F.posexplode_outer(array).alias(at, item))
    return flat.filter(F.col(at).isNotNull())


def meta_map(pages: DataFrame) -> DataFrame:
    """page_id and a map of meta key to value; the last tag of a key wins."""
    tags = pages.select("page_id", hx.meta_tags(F.col("html")).alias("tags"))
    keys = F.array_distinct(F.transform("tags", lambda tag: tag["key"]))
    entry = lambda key: F.struct(
        key.alias("key"),
        F.try_element_at(F.filter("tags", lambda tag: tag["key"] == key), F.lit(-1))["value"].alias("value"),
    )
    return tags.select("page_id", F.map_from_entries(F.transform(keys, entry)).alias("meta"))


def json_blobs(pages: DataFrame) -> DataFrame:
    """One row per embedded JSON text that parses: page_id, blob_ord, json."""
    texts = F.expr(f"transform({jt.roots('_nodes')}, r -> get(_texts, r.blob))")
    return unfold(_with_nodes(pages), ["page_id"], texts, "blob_ord", "json")


def json_nodes(pages: DataFrame) -> DataFrame:
    """One row per JSON node of a page; ``pos`` is its rank in document order, from 0."""
    read = F.filter("_nodes", lambda n: n["up"] != jt.SKIPPED)
    nodes = unfold(_with_nodes(pages), ["page_id"], read, "at", "n")
    return nodes.select("page_id", "n.blob", "n.pos", "n.key", "n.kind", "n.text", "n.size")


def skipped_json(pages: DataFrame) -> DataFrame:
    """page_id and how many of its JSON texts were nested too deeply to be read."""
    return _with_nodes(pages).select("page_id", F.expr(jt.skipped("_nodes")).alias("skipped_json"))


def deep_find(pages: DataFrame, keys) -> DataFrame:
    """Every value whose key (any case) is in ``keys``, at any depth: page_id, pos, key, kind,
    value. Containers come as JSON text."""
    wanted = sorted({key.lower() for key in keys})
    hits = F.filter("_nodes", lambda n: F.lower(n["key"]).isin(*wanted))
    found = unfold(_with_nodes(pages, wanted), ["page_id"], hits, "at", "n")
    return found.select("page_id", "n.pos", "n.key", "n.kind", F.col("n.text").alias("value"))


def _with_product(read: DataFrame, scrape_time: Column) -> DataFrame:
    """Add the snapshot columns to pages that carry ``_nodes`` (``url`` is the product URL)."""
    html = tx.text_of(F.col("html"))
    parts = read.withColumns(
        {
            "_metas": hx.meta_tags(html),
            "_hits": rx.alias_hits("_nodes"),
            "_objects": rx.product_objects("_nodes"),
        }
    )
    metas = F.col("_metas")
    own = {
        "title": F.coalesce(hx.last_meta(metas, "og:title"), hx.snapshot_title(html)),
        "price_display": hx.last_meta(metas, "product:price:amount"),
        "product_description": hx.last_meta(metas, "description"),
    }
    in_objects = ("title", "product_description", "rating_avg_display", "rating_count_display",
                  "price_display", "shop_name")
    fields = {}
    for field in rx.PRODUCT_ALIASES:
        sources = [own[field]] if field in own else []
        if field in in_objects:
            sources.append(rx.from_objects("_objects", field))
        fields[field] = F.coalesce(*sources, rx.by_alias("_hits", field))
    named = parts.withColumns(
        {
            **fields,
            "product_id": hx.extract_product_id(F.col("url")),
            "product_url": F.col("url"),
            "scrape_time": scrape_time,
            "category_breadcrumb": rx.breadcrumb("_nodes", metas),
            "response_hash": tx.stable_hash(html),
        }
    )
    return named.drop("_metas", "_hits", "_objects")


def with_completeness(records: DataFrame) -> DataFrame:
    """Add the share of required fields that are filled, and the status that follows from it."""
    filled = sum(
        (F.coalesce(F.col(c) != "", F.lit(False)).cast("int") for c in rx.REQUIRED_FIELDS), F.lit(0)
    )
    share = filled / F.lit(float(len(rx.REQUIRED_FIELDS)))
    return records.withColumns(
        {
            "required_field_completeness": F.bround(share, 3),
            "parse_status": F.when(share >= rx.OK_SHARE, "ok").otherwise("partial"),
        }
    )


def parse_product_snapshots(pages: DataFrame, scrape_time: str) -> DataFrame:
    """One snapshot row per page; the page's other columns stay in front of it."""
    keep = [c for c in pages.columns if c not in ("html", "url", *PRODUCT_SNAPSHOTS.names)]
    read = _with_product(_with_nodes(pages), F.lit(scrape_time))
    return with_completeness(read).select(*keep, *PRODUCT_SNAPSHOTS.names)


def carry_seed_category(snapshots: DataFrame, seeds: DataFrame) -> DataFrame:
    """Add the category quota of the (first) seed that names the product URL."""
    rows, order = with_order(seeds, "ord" if "ord" in seeds.columns else None)
    quota = keep_first(rows.select("product_url", "category_quota", order), ["product_url"], order)
    quota = quota.select("product_url", F.col("category_quota").alias("seed_category_quota"))
    return snapshots.join(quota, "product_url", "left")


def review_candidates(pages: DataFrame) -> DataFrame:
    """One row per review candidate of a page in reading order: page_id, ord, rule, n_fields. An
    object may qualify by both rules and is then listed twice."""
    rows = unfold(_with_nodes(pages), ["page_id"], rx.candidates("_nodes"), "ord", "c")
    rule = F.when(F.col("c.item") < 0, "keys").otherwise("container")
    return rows.select("page_id", "ord", rule.alias("rule"), F.col("c.size").alias("n_fields"))


def _with_review_array(rows: DataFrame, reviews: Column, product_id: Column, page_no: Column) -> DataFrame:
    """Add ``_reviews``, the page's rows without repeats, from an array of review structs."""
    keyed = rows.withColumn("_keyed", rx.keyed_reviews(reviews, product_id, page_no))
    return keyed.withColumn("_reviews", rx.first_of_each(F.col("_keyed"))).drop("_keyed")


def _with_embedded_reviews(read: DataFrame) -> DataFrame:
    """Add ``_found`` and ``_reviews`` to pages that carry ``_nodes``."""
    found = read.withColumn("_found", rx.candidates("_nodes"))
    fields = found.withColumn("_fields", rx.candidate_fields("_nodes", "_found"))
    return _with_review_array(fields, rx.reviews_of("_fields"), F.col("product_id"), F.col("review_page")).drop("_fields")


def _explode_reviews(rows: DataFrame, keep) -> DataFrame:
    kept = [*keep, "product_id", "review_page", "scrape_time", "response_hash", "source_url"]
    flat = unfold(rows, kept, F.col("_reviews"), "review_ord", "r")
    own = {name: F.col(f"r.{name}") for name in flat.schema["r"].dataType.names}
    own["purchase_variant"] = F.col("r.variant_text")
    table = [own[n].alias(n) if n in own else F.col(n) for n in REVIEWS_RAW.names]
    return flat.select(*keep, "review_ord", *table)


def _review_inputs(pages: DataFrame, scrape_time: str, hashed: Column) -> DataFrame:
    """Add the columns every review row of a page repeats."""
    columns = pages.columns
    page_no = F.col("page_no").cast("int") if "page_no" in columns else F.lit(1)
    source = F.coalesce(F.col("source_url"), F.col("url")) if "source_url" in columns else F.col("url")
    return pages.withColumns(
        {
            "product_id": hx.extract_product_id(F.col("url")),
            "review_page": page_no,
            "scrape_time": F.lit(scrape_time),
            "response_hash": hashed,
            "source_url": source,
        }
    )


def _kept(pages: DataFrame, *content) -> list[str]:
    taken = {*content, "url", "page_no", "review_ord", *REVIEWS_RAW.names}
    return [c for c in pages.columns if c not in taken]


def parse_reviews(pages: DataFrame, scrape_time: str) -> DataFrame:
    """Review rows from the JSON embedded in pages (``url`` is the product URL; optional
    ``page_no`` and ``source_url``)."""
    read = _review_inputs(_with_nodes(pages), scrape_time, tx.stable_hash(tx.text_of(F.col("html"))))
    return _explode_reviews(_with_embedded_reviews(read), _kept(pages, "html"))


def parse_payload_reviews(payloads: DataFrame, scrape_time: str) -> DataFrame:
    """Review rows from captured JSON payloads (``payload`` text). The hash is the given
    ``response_hash`` or that of the payload with sorted keys."""
    canonical = tx.stable_hash(F.col("_json.canonical"))
    given = "response_hash" in payloads.columns
    hashed = F.coalesce(F.col("response_hash"), canonical) if given else canonical
    read = payloads.withColumn("_json", jt.payload_json(F.col("payload")))
    read = _review_inputs(read.withColumn("_nodes", F.col("_json.nodes")), scrape_time, hashed)
    return _explode_reviews(_with_embedded_reviews(read), _kept(payloads, "payload"))


def parse_rendered_reviews(pages: DataFrame, scrape_time: str) -> DataFrame:
    """Review rows from the cards of rendered pages."""
    html = tx.text_of(F.col("html"))
    read = _review_inputs(pages, scrape_time, tx.stable_hash(html))
    cards = read.withColumn("_cards", rx.card_reviews(html))
    rows = _with_review_array(cards, F.col("_cards"), F.col("product_id"), F.col("review_page"))
    return _explode_reviews(rows, _kept(pages, "html"))


def discover_links(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Pages to read for each product page: page_id, page_no (from 1), link."""
    base = F.col("final_url") if "final_url" in pages.columns else F.col("url")
    links = hx.review_links(tx.text_of(F.col("html")), base, max_pages)
    rows = unfold(pages, ["page_id"], links, "at", "link")
    return rows.select("page_id", (F.col("at") + 1).alias("page_no"), "link")


def _visible_length(html: Column) -> Column:
    return F.length(hx.visible_text(hx.body_html(html)))


def _with_signals(read: DataFrame) -> DataFrame:
    """Add ``blob_count``, ``review_candidate_count``, ``product_signal_count`` and ``_signals``, the number of
    shell signals without that of the visible text, to pages that carry the product columns, ``_found``,
    ``_reviews``."""
    html = tx.text_of(F.col("html"))
    measured = read.withColumns(
        {
            "blob_count": F.expr(f"size({jt.roots('_nodes')})"),
            "review_candidate_count": F.size("_found"),
            "product_signal_count": sum(
                (F.coalesce(F.col(c) != "", F.lit(False)).cast("int") for c in SHELL_PRODUCT_FIELDS),
                F.lit(0),
            ),
        }
    )

    def any_in(words) -> Column:
        found = F.lit(False)
        for word in words:
            found = found | F.contains(html, F.lit(word))
        return found

    signals = [
        any_in(SHELL_DIVS),
        any_in(SHELL_MARKERS),
        F.size("_reviews") == 0,
        F.col("review_candidate_count") == 0,
        F.col("product_signal_count") <= 1,
    ]
    return measured.withColumn("_signals", sum((s.cast("int") for s in signals), F.lit(0)))


def _with_shell(read: DataFrame) -> DataFrame:
    """Add the shell columns to pages that carry the product columns, ``_found``, ``_reviews``."""
    seen = _with_signals(read).withColumn("visible_text_length", _visible_length(tx.text_of(F.col("html"))))
    short = (F.col("visible_text_length") < SHELL_TEXT_CHARS).cast("int")
    counted = seen.withColumn("signal_count", F.col("_signals") + short)
    return counted.withColumn(
        "shell_reason", F.when(F.col("signal_count") >= SHELL_SIGNALS, SHELL_REASON)
    )


def _with_shell_reason(read: DataFrame) -> DataFrame:
    """Add ``shell_reason`` alone. The visible text is the dearest signal to get, and read only where it decides."""
    known, missing = F.col("_signals"), F.col("_signals") == SHELL_SIGNALS - 1
    short = _visible_length(tx.text_of(F.col("html"))) < SHELL_TEXT_CHARS
    reason = F.when(known >= SHELL_SIGNALS, SHELL_REASON).when(missing, F.when(short, SHELL_REASON))
    return _with_signals(read).withColumn("shell_reason", reason)


SHELL_COLUMNS = (
    "shell_reason", "signal_count", "visible_text_length", "blob_count", "review_candidate_count",
    "product_signal_count",
)


def detect_shell_pages(pages: DataFrame) -> DataFrame:
    """One row per page with the shell reason (NULL when the page has content) and its signals."""
    read = _review_inputs(_with_nodes(pages), "", F.lit(""))
    judged = _with_shell(_with_product(_with_embedded_reviews(read), F.lit("")))
    return judged.select("page_id", *SHELL_COLUMNS)


def _markers(stop_on_keywords) -> list[str]:
    given = stop_on_keywords or BLOCK_MARKERS
    return [marker.lower().strip() for marker in given if marker.strip()]


def inspect_blocks(pages: DataFrame, stop_on_status=STOP_STATUS, stop_on_keywords=None) -> DataFrame:
    """Add stop_reason, stop_signal_class, stop_signal_source and stop_matched_text: the first rule
    that says a page was refused (status, empty body, login redirect, then the markers in order)."""
    seen = pages.withColumns(
        {"_title": hx.block_title(F.col("html")), "_visible": hx.block_text(F.col("html"))}
    )

    def verdict(reason, kind: str, source: str, matched) -> Column:
        return F.struct(
            reason.alias("reason"), F.lit(kind).alias("kind"), F.lit(source).alias("source"),
            matched.cast("string").alias("matched"),
        )

    def keyword(marker: str, source: str) -> Column:
        return verdict(F.lit(f"keyword_{marker}"), "keyword", source, F.lit(marker))

    hits = []
    for marker in _markers(stop_on_keywords):
        hits.append(F.when(F.contains("_title", F.lit(marker)), keyword(marker, "title")))
        if marker not in TITLE_ONLY_MARKERS:
            hits.append(F.when(F.contains("_visible", F.lit(marker)), keyword(marker, "visible_text")))
    status, final_url = F.col("status_code"), F.col("final_url")
    redirect = F.lower(tx.text_of(final_url)).rlike("login|signin")
    rule = (
        F.when(
            status.isin(*stop_on_status) if stop_on_status else F.lit(False),
            verdict(F.concat(F.lit("status_"), status.cast("string")), "status_code", "http_status", status),
        )
        .when(tx.is_blank(F.col("html")), verdict(F.lit("empty_payload"), "payload", "body", F.lit(None)))
        .when(redirect, verdict(F.lit("forced_login_redirect"), "redirect", "final_url", final_url))
    )
    rule = rule.otherwise(F.coalesce(*hits)) if hits else rule
    judged = seen.withColumn("_rule", rule)
    return judged.withColumns(
        {
            "stop_reason": F.col("_rule.reason"),
            "stop_signal_class": F.col("_rule.kind"),
            "stop_signal_source": F.col("_rule.source"),
            "stop_matched_text": F.col("_rule.matched"),
        }
    ).drop("_title", "_visible", "_rule")


def block_reason(pages: DataFrame, stop_on_status=STOP_STATUS, stop_on_keywords=None) -> DataFrame:
    """The short form of ``inspect_blocks``: page_id and stop_reason."""
    return inspect_blocks(pages, stop_on_status, stop_on_keywords).select("page_id", "stop_reason")


def page_facts(pages: DataFrame, scrape_time: str, max_pages: int | None = None, stop_on_status=STOP_STATUS,
               stop_on_keywords=None) -> DataFrame:
    """Everything a review harvest needs to know about a stored page, without its HTML: block
    verdict, shell reason, links, and its review rows as an array. One narrow pass, so the HTML is
    never shuffled."""
    judged = inspect_blocks(pages, stop_on_status, stop_on_keywords)
    read = _review_inputs(
        _with_nodes(judged).drop("page_no"), scrape_time, tx.stable_hash(tx.text_of(F.col("html")))
    )
    known = _with_shell_reason(_with_product(_with_embedded_reviews(read), F.lit(scrape_time)))
    links = hx.review_links(tx.text_of(F.col("html")), F.col("final_url"), max_pages)
    return known.select(
        *[c for c in pages.columns if c not in ("html", "page_no")],
        "stop_reason", "stop_signal_class", "stop_signal_source", "stop_matched_text",
        "shell_reason", "response_hash", links.alias("links"), F.col("_reviews").alias("reviews"),
        F.size("_reviews").cast("bigint").alias("n"), F.expr(jt.skipped("_nodes")).alias("skipped_json"),
    )
