"""The catalog's queries once more, as SQL for an independent engine."""

from __future__ import annotations


def norm(x: str) -> str:
    return rf"trim(regexp_replace(lower({x}), '\s+', ' ', 'g'))"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def mask(x: str) -> str:
    n = norm(x)
    return (
        f"CASE WHEN length({n}) <= 2 THEN repeat('*', length({n})) "
        f"ELSE left({n}, 1) || repeat('*', length({n}) - 2) || right({n}, 1) END"
    )


def no_scripts(x: str) -> str:
    return rf"regexp_replace({x}, '(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>', ' ', 'g')"


def no_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


def unescape(x: str) -> str:
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name};?', '{char}', 'g')"
    return x


def visible(x: str) -> str:
    return squeeze(unescape(no_tags(no_scripts(x))))


def block_visible(x: str) -> str:
    return f"lower({squeeze(no_tags(f'regexp_replace({no_scripts(x)}, $$(?s)<!--.*?-->$$, $$ $$, $$g$$)'))})"


def block_title(x: str) -> str:
    return f"lower({squeeze(f'regexp_extract({x}, $$(?is)<title[^>]*>(.*?)</title>$$, 1)')})"


def band(x: str, edges) -> str:
    number = rf"try_cast(regexp_replace({x}, '[^\d.]', '', 'g') AS DOUBLE)"
    (low, a), (mid, b), (high, c), (_, d) = edges
    return (
        f"CASE WHEN {number} < -1 THEN NULL WHEN {number} <= {low} THEN '{a}' WHEN {number} <= {mid} THEN '{b}' "
        f"WHEN {number} <= {high} THEN '{c}' WHEN {number} > {high} THEN '{d}' END"
    )


def price(x: str) -> str:
    return band(x, ((100000, "budget"), (500000, "mid"), (1000000, "upper_mid"), (None, "premium")))


def sold(x: str) -> str:
    return band(x, ((50, "low"), (200, "medium"), (1000, "high"), (None, "very_high")))


REVIEWS = """reviews AS (
  SELECT doc_id AS ord, source AS product_id, text AS review_text, CAST(doc_id % 97 AS VARCHAR) AS review_time_display,
    CAST(doc_id % 5 + 1 AS INTEGER) AS star_rating, CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE lang END AS variant_text
  FROM documents)"""

PRODUCTS = """products AS (
  SELECT source AS product_id, max(lang) AS category_breadcrumb, 'Rp' || CAST(sum(n_chars) * 10 AS BIGINT) AS price_display,
    count(*) || ' sold' AS sold_count_display FROM documents GROUP BY source
  UNION ALL
  SELECT p_brand, max(p_type), 'Rp' || CAST(sum(p_size) * 100 AS BIGINT), count(*) || ' sold' FROM part GROUP BY p_brand)"""


def rollup(source: str = "reviews") -> str:
    text = norm("review_text")
    return rf"""SELECT product_id, count(*) AS review_count,
      1 - count(DISTINCT {text})::DOUBLE / count(*) AS duplicate_ratio,
      sum(CASE WHEN star_rating IN (1, 5) THEN 1 ELSE 0 END)::DOUBLE / count(*) AS extreme_rating_ratio,
      sum(CASE WHEN length(review_text) < 20 THEN 1 ELSE 0 END)::DOUBLE / count(*) AS short_review_ratio,
      1 - count(DISTINCT regexp_replace({text}, '\d+', '<num>', 'g'))::DOUBLE / count(*) AS near_template_ratio
    FROM {source} GROUP BY product_id"""


def aggregates(reviews: str, category: str) -> str:
    return f"""rolled AS ({rollup(reviews)}),
    merged AS (
      SELECT p.product_id, {category} AS category_breadcrumb, {price('price_display')} AS price_band,
        {sold('sold_count_display')} AS sold_count_band, coalesce(review_count, 0) AS review_count,
        coalesce(duplicate_ratio, 0.0) AS duplicate_ratio, coalesce(extreme_rating_ratio, 0.0) AS extreme_rating_ratio,
        coalesce(short_review_ratio, 0.0) AS short_review_ratio, coalesce(near_template_ratio, 0.0) AS near_template_ratio
      FROM products p LEFT JOIN rolled r ON p.product_id IS NOT DISTINCT FROM r.product_id)
    SELECT *, review_count::DOUBLE / (SELECT max(review_count) FROM merged) AS review_density_proxy FROM merged"""


BLOCK_PAGES = """block_pages AS (
  SELECT page_id, CASE page_id % 7 WHEN 1 THEN replace(html, '<title>', '<title>Captcha ')
      WHEN 2 THEN replace(html, '</body>', 'Access Denied</body>') WHEN 3 THEN ' '
      WHEN 4 THEN replace(html, '<title>', '<title>Please Login ') ELSE html END AS html,
    CASE WHEN page_id % 7 = 5 THEN 403 ELSE 200 END AS status_code,
    CASE WHEN page_id % 7 = 6 THEN url || '/buyer/login' ELSE url END AS final_url
  FROM pages), seen AS (SELECT *, """ + block_title("html") + " AS t, " + block_visible("html") + """ AS v FROM block_pages)"""

BLOCK_WORD = """CASE WHEN contains(t, 'captcha') THEN 'captcha/title' WHEN contains(v, 'captcha') THEN 'captcha/visible_text'
  WHEN contains(t, 'verify you are human') THEN 'verify you are human/title'
  WHEN contains(v, 'verify you are human') THEN 'verify you are human/visible_text'
  WHEN contains(t, 'access denied') THEN 'access denied/title' WHEN contains(v, 'access denied') THEN 'access denied/visible_text'
  WHEN contains(t, 'forbidden') THEN 'forbidden/title' WHEN contains(v, 'forbidden') THEN 'forbidden/visible_text'
  WHEN contains(t, 'login') THEN 'login/title' WHEN contains(t, 'sign in') THEN 'sign in/title' END"""

BLOCK_RULES = f"""ruled AS (SELECT *, CASE WHEN status_code IN (403, 429) THEN 'status' WHEN trim(html) = '' THEN 'empty'
    WHEN contains(lower(final_url), 'login') OR contains(lower(final_url), 'signin') THEN 'login' END AS rule,
    {BLOCK_WORD} AS word FROM seen)"""

HREFS = r"""regexp_extract_all({html}, '(?i)href=["'']([^"'']+)["'']', 1)"""
HOST = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"

PARENT = "regexp_replace(regexp_replace(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '[^/]*$', ''), '[^/]+/$', '')"

LINKS = f"""hrefs AS (
    SELECT page_id, url, unnest(h) AS href, generate_subscripts(h, 1) AS pos
    FROM (SELECT page_id, url, {HREFS.format(html="replace(html, 'href=\"/a', 'href=\"/a?page=')")} AS h FROM pages)),
  wanted AS (
    SELECT page_id, {HOST} || href AS link, min(pos) AS pos FROM hrefs
    WHERE lower(href) LIKE '%review%' OR lower(href) LIKE '%rating%' OR lower(href) LIKE '%page=%' GROUP BY 1, 2),
  found AS (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS nth FROM wanted),
  links AS (
    SELECT page_id, 1 AS page_no, url AS link FROM pages
    UNION ALL SELECT page_id, nth + 1, link FROM found WHERE nth <= 4)"""

PRODUCT_BLOBS = """blobs AS (
  SELECT p_partkey AS page_id, unnest([0, 1]) AS blob_ord,
    '{"@type":"Product","name":"other","aggregateRating":{"ratingValue":' || p_size || ',"reviewCount":"' || p_size * 2
      || '"},"offers":{"price":' || p_size * 1000 || '},"brand":{"name":"' || p_brand || '"}}' AS json
  FROM part WHERE p_partkey % 3 = 0
  UNION ALL
  SELECT p_partkey, 0, '{"a":{"price_min":1,"price":"' || p_size || '"},"b":{"price":7},"shop":"' || p_brand || '","sold":'
    || p_size || ',"rating":{"x":1},"rating_star":4.5,"cmt_count":0}' FROM part WHERE p_partkey % 3 = 1
  UNION ALL
  SELECT p_partkey, unnest([0, 1]), '{"@type":"BreadcrumbList","itemListElement":[{"name":"' || p_brand
    || '"},{"name":""},{"name":" ' || p_type || '"}]}' FROM part WHERE p_partkey % 3 = 2
  UNION ALL
  SELECT p_partkey, 2, '{"Stock":true,"location":null}' FROM part WHERE p_partkey % 3 = 2)"""

PAGE_REVIEWS = f"""raw AS (
  SELECT doc_id // 8 AS page_id, doc_id, {strip('text')} AS review_text, CAST(doc_id % 5 + 1 AS VARCHAR) AS star_rating,
    CAST(doc_id % 3 AS VARCHAR) AS review_time_display, lang AS reviewer_name_masked, doc_id % 2 = 1 AS seller_reply_flag
  FROM documents),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, review_text, star_rating, review_time_display ORDER BY doc_id) AS copy
  FROM raw WHERE review_text <> ''),
kept AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY doc_id) - 1 AS review_ord FROM firsts WHERE copy = 1)"""

PAGE_LOG = """page_log AS (
  SELECT strftime(ts, '%Y-%m-%d') AS run, (user_id % 6) * 10000000000 + event_id AS seq, user_id % 6 AS seed,
    user_id % 3 AS product_id, event_id AS page_no,
    CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE CAST(trunc(value) AS BIGINT) % 20 END AS n,
    CASE WHEN event_id % 211 = 210 THEN 'status_' || (403 + event_id % 2) END AS stop_reason,
    event_type = 'error' AS is_empty
  FROM events)"""


def streak(source: str) -> str:
    return f"""(SELECT * FROM (
      SELECT *, coalesce(sum(hit) OVER (PARTITION BY run, seed ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hits
      FROM (SELECT *, CASE WHEN n = 0 AND lag(n) OVER w = 0 AND lag(n, 2) OVER w = 0 THEN 1 ELSE 0 END AS hit
        FROM {source} WINDOW w AS (PARTITION BY run, seed ORDER BY page_no))) WHERE hits = 0)"""


def cap(source: str) -> str:
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""(SELECT * FROM (
      SELECT *, coalesce(sum(n) OVER (PARTITION BY run, product_id ORDER BY seq {before}), 0) AS total,
        coalesce(sum(n) OVER (PARTITION BY run, product_id, seed ORDER BY seq {before}), 0) AS own
      FROM {source}) WHERE total < 100 OR own = 0)"""


def stop(source: str) -> str:
    return f"""(SELECT * FROM (
      SELECT *, min(CASE WHEN stop_reason IS NOT NULL THEN seq END) OVER (PARTITION BY run) AS stop_at FROM {source})
      WHERE stop_at IS NULL OR seq < stop_at)"""


CLEANED = f"""cleaned AS (
  SELECT *, {norm('review_text')} AS t, row_number() OVER (
    PARTITION BY product_id, {norm('review_text')}, review_time_display, star_rating ORDER BY ord) AS copy
  FROM (SELECT * REPLACE (CAST(star_rating AS DOUBLE) AS star_rating) FROM reviews) QUALIFY copy = 1)"""

HARVESTED = """p AS (SELECT p_partkey AS k, p_partkey % 6 AS kind, 'https://shop.example/h-i.5.' || p_partkey AS u, p_name, p_brand, p_type FROM part),
  rows_ AS (
    SELECT *, (SELECT max(k) FROM p) >= 1200 AS blocked FROM (
      SELECT k, kind, u, 1 AS no, 0 AS i, p_name AS text FROM p WHERE kind IN (0, 1, 5)
      UNION ALL SELECT k, kind, u, 2, 0, p_brand FROM p WHERE kind = 0
      UNION ALL SELECT k, kind, u, 2, 1, p_type FROM p WHERE kind = 0
      UNION ALL SELECT k, kind, u, 3, 0, p_name || ' 3' FROM p WHERE kind = 0
      UNION ALL SELECT k, kind, u, 5, 0, p_name || ' 5' FROM p WHERE kind = 1
      UNION ALL SELECT k, kind, u, 1, 0, p_type FROM p WHERE kind = 2
      UNION ALL SELECT k, kind, u, 1, 0, '5 star ' || p_name || ' 2024-01-05' FROM p WHERE kind = 3
      UNION ALL SELECT k, kind, u, 2, 0, p_name || ' 2' FROM p WHERE kind = 5))"""

LOG = "SELECT run, seq, seed, product_id, n FROM"
TITLE = "CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_name || ' page' END"
CARD = f"""cards AS (
  SELECT p_partkey AS page_id, 0 AS review_ord, {squeeze("p_name || ' & ' || (p_size % 5 + 1) || ' star 2024-01-0' || (p_size % 9 + 1) || ' variasi: ' || p_brand || ' | ' || p_size || ' helpful'")} AS review_text,
    2 AS image_count, true AS media_flag, false AS seller_reply_flag FROM part
  UNION ALL SELECT p_partkey, 1, {squeeze("'Seller reply ' || p_type")}, 0, false, true FROM part)"""

# sessions of users, twelve hours apart
VISITS = """WITH g AS (
    SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 12 HOUR, true)::INT AS fresh FROM events
  ), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS session FROM g
  ), v AS (SELECT user_id, session, min(ts) AS session_start, max(ts) AS session_end, count(*)::BIGINT AS n_rows,
      sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM s GROUP BY ALL)"""

SQL = {
    "clean_reviews": f"""WITH base AS (
        SELECT doc_id * 2 AS ord, source AS product_id, text AS review_text, CAST(doc_id % 7 AS VARCHAR) AS review_time_display,
          CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST(doc_id % 5 + 1 AS DOUBLE) END AS star_rating,
          lang || ' ' || source AS reviewer, doc_id % 2 = 0 AS media_flag, doc_id % 3 = 0 AS seller_reply_flag FROM documents),
      both_ AS (SELECT * FROM base UNION ALL SELECT ord + 1, product_id, review_text, review_time_display, star_rating, reviewer,
        media_flag, seller_reply_flag FROM base),
      cleaned AS (SELECT *, {norm('review_text')} AS t FROM both_),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY product_id, t, review_time_display, star_rating ORDER BY ord) AS rn FROM cleaned)
      SELECT ord, product_id, t AS review_text, review_time_display, star_rating, {mask('reviewer')} AS reviewer_name_masked,
        media_flag, seller_reply_flag, t AS normalized_review_text FROM ranked WHERE rn = 1""",
    "clean_products": f"""SELECT ord, product_id, product_url, title, category_breadcrumb, rating_avg_display FROM (
        SELECT p_partkey AS ord, p_brand AS product_id, trim(p_type) AS product_url, {norm('p_name')} AS title,
          {norm('p_type')} AS category_breadcrumb, p_size || '.5' AS rating_avg_display,
          row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""",
    "keep_first": """SELECT o_custkey, o_orderpriority, o_orderkey, o_orderstatus FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "review_features": rf"""WITH {REVIEWS},
      chars AS (SELECT ord, unnest(string_split(review_text, '')) AS c, generate_subscripts(string_split(review_text, ''), 1) AS i FROM reviews),
      runs AS (SELECT ord, c, i - row_number() OVER (PARTITION BY ord, c ORDER BY i) AS g FROM chars WHERE c <> chr(10)),
      long_runs AS (SELECT ord, c, g, count(*) AS k FROM runs GROUP BY ALL HAVING count(*) >= 3),
      repeated AS (SELECT ord, sum(k) AS k FROM long_runs GROUP BY ord)
      SELECT r.ord, product_id, review_text, review_time_display, star_rating, variant_text,
        row_number() OVER (PARTITION BY product_id ORDER BY review_time_display, r.ord) AS relative_review_order,
        {norm('review_text')} AS normalized_review_text, length(review_text) AS text_length,
        len(regexp_extract_all(review_text, '[\x{{1F300}}-\x{{1F5FF}}\x{{1F600}}-\x{{1F64F}}\x{{1F680}}-\x{{1F6FF}}\x{{1F900}}-\x{{1F9FF}}\x{{2600}}-\x{{27BF}}]+')) AS emoji_count,
        CASE WHEN length(review_text) = 0 THEN 0.0 ELSE round_even(coalesce(k, 0)::DOUBLE / length(review_text), 4) END AS repeated_char_ratio,
        length(review_text) - length(replace(review_text, '!', '')) AS exclamation_count,
        trim(variant_text) <> '' AS variant_present_flag, star_rating IN (1, 5) AS extreme_rating_flag,
        length(review_text) < 20 AS short_review_flag
      FROM reviews r LEFT JOIN repeated p ON r.ord = p.ord""",
    "review_order": f"""WITH {REVIEWS} SELECT ord, product_id, review_time_display, star_rating, variant_text,
        row_number() OVER (PARTITION BY product_id ORDER BY review_time_display, ord) AS relative_review_order FROM reviews""",
    "input_order": """SELECT conv_id * 1000 + turn AS ord, text AS review_text,
        row_number() OVER (ORDER BY conv_id * 1000 + turn) AS relative_review_order FROM conversations""",
    "product_rollup": f"WITH {REVIEWS} {rollup()}",
    "product_metadata": f"""WITH {PRODUCTS} SELECT product_id, category_breadcrumb, {price('price_display')} AS price_band,
        {sold('sold_count_display')} AS sold_count_band FROM products""",
    "product_aggregates": f"WITH {REVIEWS}, {PRODUCTS}, {aggregates('reviews', 'category_breadcrumb')}",
    "density": """WITH c AS (SELECT conv_id AS product_id, count(*) AS review_count FROM conversations GROUP BY conv_id)
      SELECT *, review_count::DOUBLE / (SELECT max(review_count) FROM c) AS review_density_proxy FROM c""",
    "price_bands": f"""WITH p AS (SELECT o_orderkey, 'Rp' || CAST(CAST(o_totalprice * 4 AS DECIMAL(18, 2)) AS VARCHAR) AS price_display FROM orders)
      SELECT *, {price('price_display')} AS price_band FROM p""",
    "sold_bands": f"""WITH p AS (SELECT l_partkey, CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS sold_count_display FROM lineitem GROUP BY 1)
      SELECT *, {sold('sold_count_display')} AS sold_count_band FROM p""",
    "template_keys": rf"SELECT doc_id, regexp_replace({norm('text')}, '\d+', '<num>', 'g') AS template_key FROM documents",
    "numbers": r"""WITH s AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN ' ' || c_custkey || ',25 ' WHEN 1 THEN c_name
          WHEN 2 THEN c_custkey || 'd' ELSE '-' || c_custkey || 'e1' END AS shown FROM customer)
      SELECT c_custkey, replace(trim(shown), ',', '.') AS numeric_string,
        CASE c_custkey % 4 WHEN 0 THEN c_custkey + 0.25::DOUBLE WHEN 3 THEN -10.0::DOUBLE * c_custkey ELSE -0.5 END AS number,
        regexp_replace(shown, '[^\d.]', '', 'g') AS digits FROM s""",
    "mask_names": f"SELECT c_custkey, {mask('c_name')} AS masked, {mask('CAST(c_nationkey AS VARCHAR)')} AS short_masked FROM customer",
    "hash_text": "SELECT doc_id, sha256(text) AS hash FROM documents",
    "product_ids": r"""WITH u AS (SELECT page_id, url, regexp_replace(url, '[0-9]', '', 'g') AS bare,
          regexp_extract_all(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '\d+') AS digits FROM pages)
      SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'i' || page_id WHEN 1 THEN 'a b ' || page_id WHEN 2 THEN left(sha256(bare), 16)
        ELSE coalesce(digits[-1], left(sha256(url), 16)) END AS product_id FROM u""",
    "visible_text": f"""SELECT page_id, {visible('html')} AS visible_text, {block_visible('html')} AS block_text,
        {squeeze(unescape(no_tags("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")))} AS title,
        {block_title('html')} AS block_title FROM pages""",
    "unescape_text": "SELECT doc_id, replace(text, 'o', 'ô') AS text FROM documents",
    "block_inspection": f"""WITH {BLOCK_PAGES}, {BLOCK_RULES} SELECT page_id,
        CASE rule WHEN 'status' THEN 'status_' || status_code WHEN 'empty' THEN 'empty_payload' WHEN 'login' THEN 'forced_login_redirect'
          ELSE 'keyword_' || split_part(word, '/', 1) END AS stop_reason,
        CASE rule WHEN 'status' THEN 'status_code' WHEN 'empty' THEN 'payload' WHEN 'login' THEN 'redirect'
          ELSE CASE WHEN word IS NOT NULL THEN 'keyword' END END AS stop_signal_class,
        CASE rule WHEN 'status' THEN 'http_status' WHEN 'empty' THEN 'body' WHEN 'login' THEN 'final_url' ELSE split_part(word, '/', 2) END AS stop_signal_source,
        CASE rule WHEN 'status' THEN CAST(status_code AS VARCHAR) WHEN 'empty' THEN NULL WHEN 'login' THEN final_url
          ELSE split_part(word, '/', 1) END AS stop_matched_text FROM ruled""",
    "block_reasons": f"""WITH {BLOCK_PAGES} SELECT page_id, CASE WHEN trim(html) = '' THEN 'empty_payload'
        WHEN contains(lower(final_url), 'login') OR contains(lower(final_url), 'signin') THEN 'forced_login_redirect'
        WHEN contains(t, 'denied') OR contains(v, 'denied') THEN 'keyword_denied'
        WHEN contains(t, 'captcha') OR contains(v, 'captcha') THEN 'keyword_captcha' END AS stop_reason FROM seen""",
    "link_discovery": f"WITH {LINKS} SELECT page_id, page_no, link FROM links",
    "resolved_urls": f"""WITH h AS (SELECT page_id, url, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos
          FROM (SELECT page_id, url, {HREFS.format(html='html')} AS h FROM pages))
      SELECT page_id, pos, {HOST} || href AS rooted, {HOST} || {PARENT} || 'x/y' || href AS dotted,
        regexp_replace(url, '[?#].*', '') || '?q=' || href AS query FROM h""",
    "meta_tags": "SELECT p_partkey AS page_id, 2 AS n, p_name || ' <' || p_size || '>' AS title, p_brand AS brand FROM part",
    "product_snapshot": f"""SELECT p_partkey AS page_id, CAST(p_partkey AS VARCHAR) AS product_id, {TITLE} AS title,
        CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 2 THEN p_brand || ' > ' || trim(p_type) END AS category_breadcrumb,
        CASE p_partkey % 3 WHEN 0 THEN CAST(p_size * 1000 AS VARCHAR) WHEN 1 THEN CAST(p_size AS VARCHAR) END AS price_display,
        CASE p_partkey % 3 WHEN 1 THEN CAST(p_size AS VARCHAR) END AS sold_count_display,
        CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN '4.5' END AS rating_avg_display,
        CASE p_partkey % 3 WHEN 0 THEN CAST(p_size * 2 AS VARCHAR) WHEN 1 THEN '0' END AS rating_count_display,
        CASE WHEN p_partkey % 3 < 2 THEN p_brand END AS shop_name,
        CASE WHEN p_partkey % 3 = 2 THEN 'True' END AS stock_display, CAST(NULL AS VARCHAR) AS shop_location,
        CASE p_partkey % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.889::DOUBLE ELSE 0.556::DOUBLE END AS required_field_completeness,
        'ok' AS parse_status FROM part""",
    "seed_category": "SELECT p_partkey AS page_id, s_name AS seed_category_quota FROM part LEFT JOIN supplier ON p_partkey = s_suppkey",
    "json_blobs": f"WITH {PRODUCT_BLOBS} SELECT page_id, blob_ord, json FROM blobs",
    "json_nodes": """SELECT p_partkey AS page_id, unnest([0, 1, 2, 3, 4, 5, 6]) AS pos,
        unnest(['-', 'name', 'size', '-', '-', 'brand', 'z']) AS key, unnest(['dict', 'str', 'list', 'num', 'dict', 'str', 'null']) AS kind,
        unnest(['-', p_name, '-', CAST(p_size AS VARCHAR), '-', p_brand, '-']) AS text, unnest([3, 0, 2, 0, 1, 0, 0]) AS size FROM part""",
    "deep_find": """SELECT p_partkey AS page_id, unnest([1, 2, 3, 4, 5, 6]) AS nth, unnest(['str', 'num', 'str', 'str', 'num', 'str']) AS kind,
        unnest(['other', CAST(p_size * 1000 AS VARCHAR), p_brand, 'other', CAST(p_size * 1000 AS VARCHAR), p_brand]) AS value
      FROM part WHERE p_partkey % 3 = 0
      UNION ALL SELECT p_partkey, unnest([1, 2]), unnest(['str', 'num']), unnest([CAST(p_size AS VARCHAR), '7']) FROM part WHERE p_partkey % 3 = 1
      UNION ALL SELECT p_partkey, unnest([1, 2, 3, 4, 5, 6, 7, 8]), unnest(['list', 'str', 'str', 'str', 'list', 'str', 'str', 'str']),
        unnest([l, p_brand, '', ' ' || p_type, l, p_brand, '', ' ' || p_type])
      FROM (SELECT *, '[{"name": "' || p_brand || '"}, {"name": ""}, {"name": " ' || p_type || '"}]' AS l FROM part WHERE p_partkey % 3 = 2)""",
    "reviews_html": f"""WITH {PAGE_REVIEWS} SELECT page_id, review_ord, CAST(page_id AS VARCHAR) AS product_id, review_text, star_rating,
        review_time_display, reviewer_name_masked, true AS media_flag, seller_reply_flag, 1 AS image_count, false AS video_flag FROM kept""",
    "review_candidates": """WITH d AS (SELECT doc_id // 8 AS page_id, doc_id % 8 AS i, count(*) OVER (PARTITION BY doc_id // 8) AS n FROM documents)
      SELECT page_id, i AS ord, 'container' AS rule, 6 AS n_fields FROM d UNION ALL SELECT page_id, n + i, 'keys', 6 FROM d""",
    "reviews_payload": f"""WITH c AS (SELECT *, {strip('text')} AS t,
          '{{"content": ' || to_json(text) || ', "score": ' || turn || ', "username": ' || to_json(role) || '}}' AS one FROM conversations)
      SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS product_id, t AS review_text, CAST(turn AS VARCHAR) AS star_rating,
        role AS reviewer_name_masked, sha256('{{"Review_List": [' || one || ', ' || one || '], "page": ' || turn || '}}') AS response_hash
      FROM c WHERE t <> ''""",
    "reviews_rendered": rf"""WITH {CARD} SELECT page_id, review_ord, review_text,
        coalesce(nullif(regexp_extract(review_text, '(?i)([1-5])(?:\s*/\s*5|\s*bintang|\s*star)', 1), ''), '-') AS star_rating,
        coalesce(nullif(regexp_extract(review_text, '(\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}}\s+\w+\s+\d{{4}})', 1), ''), '-') AS review_time_display,
        coalesce(nullif(trim(regexp_extract(review_text, '(?i)(variasi|variant)[:\s]+([^\n|]+)', 2)), ''), '-') AS variant_text,
        coalesce(nullif(regexp_extract(review_text, '(?i)(\d+)\s*(orang|helpful|terbantu|like)', 1), ''), '-') AS helpful_count_display,
        image_count, media_flag, seller_reply_flag FROM cards""",
    "shell_pages": f"""WITH p AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN replace(html, '<article>', '<article id="main">') ELSE html END AS html FROM pages),
      m AS (SELECT page_id, contains(html, 'id="main"') AS main,
          length({visible("CASE WHEN regexp_matches(html, '(?is)<body[^>]*>.*?</body>') THEN regexp_extract(html, '(?is)<body[^>]*>(.*?)</body>', 1) ELSE html END")}) AS visible_text_length,
          CASE WHEN {squeeze(no_tags("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"))} <> '' THEN 1 ELSE 0 END AS product_signal_count FROM p),
      s AS (SELECT *, 3 + CASE WHEN main THEN 1 ELSE 0 END + CASE WHEN visible_text_length < 400 THEN 1 ELSE 0 END AS signal_count FROM m)
      SELECT page_id, CASE WHEN signal_count >= 4 THEN 'shell_page_no_embedded_reviews' END AS shell_reason, signal_count,
        visible_text_length, 0 AS blob_count, 0 AS review_candidate_count, product_signal_count FROM s""",
    "streak_cut": f"WITH {PAGE_LOG} {LOG} {streak('page_log')}",
    "review_cap": f"WITH {PAGE_LOG} {LOG} {cap('page_log')}",
    "stop_fast": f"WITH {PAGE_LOG} {LOG} {stop('page_log')}",
    "ordered_cuts": f"WITH {PAGE_LOG} {LOG} {stop(cap(streak('page_log')))}",
    "budget": f"""WITH {PAGE_LOG} SELECT run, seq, seed, product_id, n, over_budget FROM (
        SELECT *, row_number() OVER (PARTITION BY run ORDER BY seq) AS rn, count(*) OVER (PARTITION BY run) > 50 AS over_budget FROM page_log)
      WHERE rn <= 50""",
    "empty_streak": f"""WITH {PAGE_LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY seq) AS rn FROM page_log)
      SELECT run, seq, rn - coalesce(max(CASE WHEN NOT is_empty THEN rn END) OVER (PARTITION BY run ORDER BY seq), 0) AS consecutive_empty_payloads FROM r""",
    "run_summary": f"""WITH {PAGE_LOG} SELECT run, count(*) AS requests_made,
        coalesce(arg_min(stop_reason, CASE WHEN stop_reason IS NOT NULL THEN seq END), '-') AS stop_reason,
        CAST(sum(CASE WHEN stop_reason IS NULL THEN n ELSE 0 END) AS BIGINT) AS rows_written FROM page_log GROUP BY run""",
    "source_choice": """WITH d AS (SELECT doc_id // 3 AS seed, doc_id, n_chars % 3 AS kind FROM documents),
      s AS (SELECT seed, seed % 2 = 0 AS shell, bool_or(kind = 0) AS payload, bool_or(kind = 1) AS card FROM d GROUP BY seed)
      SELECT d.seed, doc_id, CASE kind WHEN 0 THEN 'payload' WHEN 1 THEN 'card' ELSE 'embedded' END AS source FROM d JOIN s ON d.seed = s.seed
      WHERE (kind = 0 AND shell) OR (kind = 1 AND shell AND NOT payload) OR (kind = 2 AND (NOT shell OR NOT (payload OR card)))""",
    "payload_numbers": """SELECT l_orderkey AS seed, l_linenumber AS payload_no, l_quantity AS quantity,
        dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS review_page FROM lineitem""",
    "link_match": f"""WITH {LINKS} SELECT l.page_id AS seed, l.page_no, l.link, p.page_id FROM links l JOIN pages p ON l.link = p.url""",
    "missing_links": f"""WITH {LINKS} SELECT page_id AS seed, page_no, link FROM links l WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = l.link)""",
    "seed_template": """SELECT '' AS product_url, p_brand AS category_quota, 'manual seed slot ' || k AS chosen_reason, '2026-01-01' AS seed_date
      FROM (SELECT DISTINCT p_brand FROM part) CROSS JOIN (SELECT unnest(range(1, 10)) AS k)""",
    "seeds": """SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS ord, 'https://shop.example/' || c_custkey AS product_url, c_mktsegment AS category_quota,
        '"' || c_name || '",' || chr(10) || c_custkey AS chosen_reason, '2026-01-01' AS seed_date FROM customer WHERE c_custkey % 3 <> 0""",
    "export_round_trip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "manifest_round_trip": f"""WITH {BLOCK_PAGES}, {BLOCK_RULES} SELECT CAST(page_id AS VARCHAR) AS source_url, 'product_snapshot' AS stage, status_code,
        coalesce(CASE rule WHEN 'status' THEN 'status_' || status_code WHEN 'empty' THEN 'empty_payload' WHEN 'login' THEN 'forced_login_redirect'
          ELSE 'keyword_' || split_part(word, '/', 1) END, '-') AS stop_reason FROM ruled""",
    "page_file_round_trip": "SELECT 'review_harvest' AS stage, page_id AS product_idx, 1 AS page_no, html FROM pages",
    "snapshot_job": f"""SELECT p_partkey AS ord, CAST(p_partkey AS VARCHAR) AS product_id, {TITLE} AS title, 'ok' AS parse_status,
        'x' AS seed_category_quota FROM part""",
    "plain_harvest": f"""WITH {PAGE_REVIEWS} SELECT page_id AS seed, 1 AS page_no, review_ord, CAST(page_id AS VARCHAR) AS product_id, 1 AS review_page,
        review_text, 'https://shop.example/d-i.1.' || page_id AS source_url FROM kept""",
    "harvest_job": f"""WITH {HARVESTED} SELECT k AS seed, no AS page_no, i AS review_ord, CAST(k AS VARCHAR) AS product_id, no AS review_page,
        text AS review_text, CASE WHEN kind = 2 THEN 'api' WHEN no = 1 THEN u ELSE u || '?page=' || no END AS source_url
      FROM rows_ WHERE NOT (kind = 1 AND no = 5) AND (NOT blocked OR k < 1200 OR (k = 1200 AND no = 1))""",
    "harvest_dropped": f"""WITH {HARVESTED} SELECT k AS seed, u || '?page=5' AS url, 'dropped' AS why FROM p WHERE kind = 1
      UNION ALL SELECT k, u || '?page=3', 'missing' FROM p WHERE kind = 5""",
    "all_files_to_pages": """WITH p AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
      SELECT i AS product_idx, 1 AS page_no, 'https://shop.example/f-i.4.' || p_partkey AS url, 'https://shop.example/f-i.4.' || p_partkey || '?seen' AS final_url,
        200 AS status_code, '<p>' || p_name || '</p><a href="/r?page=' || p_partkey || '">more</a>' AS html FROM p
      UNION ALL SELECT i, 2, 'https://shop.example/r?page=' || p_partkey, 'https://shop.example/r?page=' || p_partkey, 0, '<p>' || p_type || '</p>' FROM p""",
    "all_captured_files": """SELECT 'u/' || conv_id AS product_url, turn + 1 AS payload_no, 'api/' || turn AS source_url,
        '{"role":"' || role || '","turn":' || turn || '}' AS payload FROM conversations""",
    "stage_manifest": f"""WITH {REVIEWS}, {PRODUCTS}, {CLEANED} SELECT (SELECT count(*) FROM products) AS products_rows, (SELECT count(*) FROM cleaned) AS reviews_rows""",
    "clean_job": f"""WITH {REVIEWS}, {CLEANED} SELECT ord, product_id, t AS review_text, review_time_display, star_rating, {norm('variant_text')} AS variant_text,
        t AS normalized_review_text FROM cleaned""",
    "features_job_reviews": f"""WITH {REVIEWS}, {CLEANED} SELECT ord, product_id, review_time_display,
        row_number() OVER (PARTITION BY product_id ORDER BY review_time_display, ord) AS relative_review_order,
        length(t) AS text_length, length(t) < 20 AS short_review_flag FROM cleaned""",
    "features_job": f"""WITH {REVIEWS}, {PRODUCTS},
      cleaned AS (SELECT DISTINCT product_id, {norm('review_text')} AS review_text, review_time_display, star_rating FROM reviews),
      {aggregates('cleaned', norm('category_breadcrumb'))}""",
    "asof_orders": """WITH o AS (
        SELECT o_custkey, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (date_diff('day', DATE '1995-01-01', o_orderdate::DATE) % 30) AS ordered,
          max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY ALL)
      SELECT event_id, user_id, o_orderkey, o_totalprice, epoch_us(ordered) AS ordered
      FROM events ASOF LEFT JOIN o ON user_id = o_custkey AND ts >= ordered""",
    "asof_recent": """WITH c AS (SELECT user_id, ts AS clicked, max(event_id) AS click_id FROM events WHERE event_type = 'click' GROUP BY ALL)
      SELECT event_id, click_id, epoch_us(clicked) AS clicked FROM (SELECT * FROM events WHERE event_type = 'view') v
      ASOF JOIN c ON v.user_id = c.user_id AND v.ts > c.clicked WHERE clicked >= v.ts - INTERVAL 3 DAY""",
    "visits": f"""{VISITS} SELECT user_id, session, epoch_us(session_start) AS session_start, epoch_us(session_end) AS session_end, n_rows, cents FROM v""",
    "overlapping_visits": f"""{VISITS}, r AS (SELECT v.*, n_regionkey AS region FROM v JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)
      SELECT a.region, a.user_id, a.session, b.user_id AS user_id_b, b.session AS session_b,
        epoch_us(least(a.session_end, b.session_end)) - epoch_us(b.session_start) AS micros
      FROM r a JOIN r b ON a.region = b.region AND a.session_end >= b.session_start
        AND (a.session_start, a.user_id, a.session) < (b.session_start, b.user_id, b.session)""",
    "incremental_keep_first": """SELECT doc_id, source, lang, n_chars FROM documents
      QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1""",
    "incremental_clean": f"""WITH {REVIEWS}, {CLEANED} SELECT ord, product_id, t AS review_text, review_time_display, star_rating, {norm('variant_text')} AS variant_text,
        t AS normalized_review_text FROM cleaned""",
}

SQL["page_source"] = SQL["page_file_round_trip"]
SQL["payload_source"] = """SELECT conv_id AS product_idx, turn + 1 AS payload_no, 'api/' || turn AS source_url,
    '{"role":"' || role || '","turn":' || turn || '}' AS payload FROM conversations"""
SQL["breadcrumb_levels"] = """WITH p AS (
    SELECT string_split(p_type, ' ') AS parts, CASE WHEN p_size < 20 THEN 'small' WHEN p_size < 40 THEN 'medium' END AS band, p_brand, p_retailprice FROM part
  ), l AS (
    SELECT unnest(range(0, len(parts) + 1))::INT AS level, parts, band, p_brand, p_retailprice FROM p
  ), n AS (SELECT level, array_to_string(parts[1:level], ' > ') AS node, band, p_brand, p_retailprice FROM l)
  SELECT level, node, band, grouping(band) = 1 AS all_bands, count(*) AS n_rows, count(DISTINCT p_brand) AS brands,
    round(avg((p_retailprice > 950)::INT::DOUBLE), 9) AS dear
  FROM n GROUP BY GROUPING SETS ((level, node, band), (level, node))"""
SQL["sketched_events"] = """SELECT event_type, count(*) AS n_rows, count(DISTINCT user_id) AS users_exact, true AS users_close, true AS median_close
  FROM events GROUP BY event_type"""
SQL["stream_streak_cut"] = """WITH p AS (
    SELECT user_id % 30 AS seed, event_id AS page_no, event_type IN ('error', 'signup') AS empty FROM events
  ), r AS (SELECT *, row_number() OVER w AS rn FROM p WINDOW w AS (PARTITION BY seed ORDER BY page_no)
  ), s AS (SELECT *, rn - coalesce(max(CASE WHEN NOT empty THEN rn END) OVER (PARTITION BY seed ORDER BY page_no), 0) AS streak FROM r)
  SELECT seed, page_no, streak FROM s
  QUALIFY coalesce(max((streak >= 4)::INT) OVER (PARTITION BY seed ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0"""
SQL["stream_windows"] = """WITH w AS (
    SELECT time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '2024-01-01') - INTERVAL 3 HOUR * k AS start_, event_type, event_id
    FROM events, range(2) t(k)
  ) SELECT epoch_us(start_) AS window_start, event_type, count(*) AS n_rows, min(event_id) AS first_id FROM w
  WHERE start_ + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY ALL"""
SQL["sql_scalars"] = f"""SELECT c_custkey, {mask('c_name')} AS masked, {norm('c_mktsegment')} AS segment, c_custkey::VARCHAR AS product FROM customer"""
SQL["sql_reviews"] = f"""SELECT conv_id, turn, {strip('text')} AS review_text, turn::VARCHAR AS star_rating, {strip('role')} AS reviewer_name_masked
  FROM conversations WHERE {strip('text')} <> ''"""
SQL["emoji_runs"] = r"""SELECT doc_id, len(regexp_extract_all(
    repeat(chr(128512), doc_id % 4) || text || repeat(chr(9728) || chr(9992), doc_id % 3) || 'a' || chr(128640) || 'b' || chr(129535) || ' ',
    '[\x{1F300}-\x{1F5FF}\x{1F600}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F900}-\x{1F9FF}\x{2600}-\x{27BF}]+')) AS emoji_count FROM documents"""
SQL["json_walk"] = SQL["json_nodes"]
# containers are written without blanks there
SQL["json_walk_find"] = SQL["deep_find"].replace('"name": ', '"name":').replace("}, {", "},{")
