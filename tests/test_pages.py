import hashlib
import json

from pyspark.sql import functions as F

from pagewright.operators import pages as pg
from tests.fixtures import PAYLOAD, PRODUCT_URL, RENDERED_CARDS, SAMPLE_PAGE, SHELL_PAGE

WHEN = "2026-04-10T00:00:00+00:00"


def page_table(spark, *htmls, url=PRODUCT_URL):
    return spark.createDataFrame(
        [(i, url, html) for i, html in enumerate(htmls)], "page_id long, url string, html string"
    )


def test_product_snapshot(spark):
    row = pg.parse_product_snapshots(page_table(spark, SAMPLE_PAGE), WHEN).first()
    assert row.title == "Oolong tin | Leaf and Kettle" and row.product_id == "9001"
    assert row.category_breadcrumb == "Drinks > Tea > Oolong"
    assert row.product_description == "Lightly roasted <oolong>"
    # the better key wins wherever it stands; the first rating in reading order is a review's
    assert (row.price_display, row.sold_count_display, row.rating_avg_display) == ("48000", "310", "4")
    assert (row.shop_name, row.shop_location, row.follower_count_display) == ("Leaf and Kettle", "Alishan", "1200")
    assert row.rating_count_display is None and row.variant_summary is None
    assert row.required_field_completeness == 0.889 and row.parse_status == "ok"


def test_reviews_from_html(spark):
    rows = pg.parse_reviews(page_table(spark, SAMPLE_PAGE), WHEN).orderBy("review_ord").collect()
    assert [r.review_text for r in rows] == ["Second steep is the best one", "Tin arrived dented, tea is fine", "Smells of orchids"]
    assert [r.star_rating for r in rows] == ["4", "3", "5"]
    assert [r.reviewer_name_masked for r in rows] == ["mei", "otto", "mei"]
    assert [(r.media_flag, r.video_flag, r.image_count) for r in rows] == [(False, False, 0), (True, True, 3), (False, False, 0)]
    assert [r.seller_reply_flag for r in rows] == [False, False, True]
    assert [r.review_time_display for r in rows] == ["1733011200", None, None]
    assert {r.source_url for r in rows} == {PRODUCT_URL}


def test_reviews_from_payload(spark):
    df = spark.createDataFrame([(PRODUCT_URL, PAYLOAD)], "url string, payload string")
    rows = pg.parse_payload_reviews(df, WHEN).orderBy("review_ord").collect()
    assert [(r.review_text, r.star_rating) for r in rows] == [
        ("Too floral for me", None), ("Bought it three times", "5"), ("Pleasant", "4")]
    # an empty list of images is no medium
    assert [(r.seller_reply_flag, r.media_flag) for r in rows] == [(False, False), (True, False), (False, False)]
    import hashlib

    text = json.dumps(json.loads(PAYLOAD), sort_keys=True, ensure_ascii=False)
    assert rows[0].response_hash == hashlib.sha256(text.encode()).hexdigest()


def test_reviews_from_rendered_cards(spark):
    """Three blocks look like cards; one is too short."""
    rows = pg.parse_rendered_reviews(page_table(spark, RENDERED_CARDS), WHEN).orderBy("review_ord").collect()
    assert [r.star_rating for r in rows] == ["2", "4"] and [r.image_count for r in rows] == [0, 2]
    assert (rows[0].review_time_display, rows[0].variant_text, rows[0].helpful_count_display) == ("7 January 2025", "loose leaf", "12")
    assert rows[1].video_flag and rows[1].media_flag and not rows[0].media_flag
    assert rows[1].review_text == "Seller response: sorry! 4/5 fragrant and fresh" and rows[1].review_time_display is None


def test_links_keep_the_base_page_first(spark):
    rows = pg.discover_links(page_table(spark, SAMPLE_PAGE)).orderBy("page_no").collect()
    assert [r.link for r in rows] == [
        PRODUCT_URL, "https://tea.example/ratings/all", PRODUCT_URL + "?sort=new&amp;page=3"]
    assert pg.discover_links(page_table(spark, SAMPLE_PAGE), max_pages=1).count() == 1
    many = "".join(f"<a href='?page={n}'>x</a>" for n in range(2, 60))
    assert pg.discover_links(page_table(spark, many)).count() == 59


def test_shell_page(spark):
    rows = pg.detect_shell_pages(page_table(spark, SHELL_PAGE, SAMPLE_PAGE)).orderBy("page_id").collect()
    assert rows[0].shell_reason == "shell_page_no_embedded_reviews" and rows[0].signal_count == 6
    assert rows[1].shell_reason is None
    # ld+json is read by two passes, the state script only by one; the rows stand under a key that names no reviews
    assert rows[1].blob_count == 3 and rows[1].review_candidate_count == 3


def block(spark, html, status=200, final_url="https://shop.example/p", **kw):
    df = spark.createDataFrame([(1, html, status, final_url)], "page_id long, html string, status_code int, final_url string")
    return pg.inspect_blocks(df, **kw).first()


def test_block_rules(spark):
    noise = "<html><head><title>Produk</title><script>var a='captcha';</script></head><body>ok <!-- captcha --></body></html>"
    assert block(spark, noise).stop_reason is None
    challenge = "<html><head><title>Verify You Are Human</title></head><body>Verify you are human</body></html>"
    hit = block(spark, challenge)
    assert (hit.stop_reason, hit.stop_signal_source) == ("keyword_verify you are human", "title")
    assert block(spark, "<p>ok</p>", status=403).stop_reason == "status_403"
    assert block(spark, " \n").stop_reason == "empty_payload"
    hit = block(spark, "<p>ok</p>", final_url="https://shop.example/buyer/Login")
    assert (hit.stop_reason, hit.stop_matched_text) == ("forced_login_redirect", "https://shop.example/buyer/Login")
    assert block(spark, "<p>please login or sign in</p>").stop_reason is None
    assert block(spark, "<title x=1>Sign in</title>").stop_reason == "keyword_sign in"
    assert block(spark, "<p>Captcha</p>", stop_on_keywords=["nothing", " "]).stop_reason is None
    assert block(spark, "<p>Captcha</p>", stop_on_keywords=[]).stop_signal_source == "visible_text"


def test_meta_last_value_wins(spark):
    html = '<meta name="A" content="1"><meta name="a" content=" &lt;2&gt; "><meta content="x" name="b">'
    row = pg.meta_map(page_table(spark, html)).first()
    assert row.meta == {"a": "<2>"}


def test_candidate_order_and_case(spark):
    blob = {
        "Reviews": [
            {"text": "outer", "star": 1, "reply": {"comment": "inner", "date": "x"}},
            {"Comment": "wrong case", "Rating": 5},
        ]
    }
    html = f"<script>{json.dumps(blob)}</script>"
    rows = pg.review_candidates(page_table(spark, html)).orderBy("ord").collect()
    assert [r.rule for r in rows] == ["container", "container", "keys", "keys", "keys"]
    reviews = pg.parse_reviews(page_table(spark, html), WHEN).orderBy("review_ord").collect()
    assert [r.review_text for r in reviews] == ["outer", "inner"]


def test_reply_flag_takes_the_first_truthy_value(spark):
    items = [
        {"text": "a", "reply": "0", "shop_reply": {"x": 1}},
        {"text": "b", "seller_reply": 0, "reply": False, "shop_reply": [1]},
        {"text": "c", "seller_reply": {}, "reply": "", "shop_reply": None},
        {"text": True, "star": 1e5, "images": "yes", "videos": [1]},
    ]
    html = f"<script>{json.dumps({'reviews': items})}</script>"
    rows = pg.parse_reviews(page_table(spark, html), WHEN).orderBy("review_ord").collect()
    assert [r.seller_reply_flag for r in rows] == [False, True, False, False]
    assert (rows[3].review_text, rows[3].star_rating, rows[3].image_count) == ("True", "100000.0", 0)
    assert rows[3].media_flag and rows[3].video_flag


def test_page_dedupe_keeps_the_first(spark):
    items = [{"text": "a", "author": "x"}, {"text": "b"}, {"text": "a", "author": "y"}, {"text": "a", "star": 5}]
    html = f"<script>{json.dumps({'reviews': items})}</script>"
    rows = pg.parse_reviews(page_table(spark, html), WHEN).orderBy("review_ord").collect()
    assert [(r.review_text, r.reviewer_name_masked, r.star_rating) for r in rows] == [
        ("a", "x", None), ("b", None, None), ("a", None, "5")]


def test_alias_order_beats_document_order(spark):
    blob = {"x": {"price_min": 1}, "b": {"price": "0"}, "a": {"price": 7}, "brand": {"name": "zz"}}
    html = f"<script>{json.dumps(blob)}</script>"
    row = pg.parse_product_snapshots(page_table(spark, html), WHEN).first()
    assert row.price_display == "0" and row.title == "zz" and row.shop_name is None


def test_product_objects_skip_wrong_shapes(spark):
    one = {"@type": "Product", "offers": [{"price": 3}], "brand": "text", "aggregateRating": {"ratingValue": 0}}
    two = {"@type": "Product", "name": "second", "offers": {"price": 9.5}, "brand": {"name": "B"}}
    html = "".join(f'<script type="application/ld+json">{json.dumps(o)}</script>' for o in (one, two))
    row = pg.parse_product_snapshots(page_table(spark, html), WHEN).first()
    assert (row.title, row.price_display, row.shop_name, row.rating_avg_display) == ("second", "9.5", "B", None)


def test_breadcrumb(spark):
    empty = {"@type": "BreadcrumbList", "itemListElement": [{"x": 1}, "text"]}
    full = {"@type": "BreadcrumbList", "itemListElement": [{"name": " Rumah "}, {"name": ""}, {"name": 5}]}
    html = "".join(f'<script type="application/ld+json">{json.dumps(o)}</script>' for o in (empty, full))
    assert pg.parse_product_snapshots(page_table(spark, html), WHEN).first().category_breadcrumb == "Rumah > 5"


def test_json_passes(spark):
    html = (
        '<script type="application/ld+json">{"a": 1}</script>'
        "<script>window.__STATE__={\"b\": {\"c\": 2}};</script>"
        "<script>INITIAL_STATE = {\"e\": NaN, \"e\": 6};</script>"
        '<script>window.__STATE__={"d": 4}</script>'
        "<script>{bad}</script><script> [1] </script>"
    )
    rows = pg.json_blobs(page_table(spark, html)).orderBy("blob_ord").collect()
    assert [r.json for r in rows] == ['{"a": 1}', '{"b": {"c": 2}}', '{"e": NaN, "e": 6}', '{"a": 1}', '{"d": 4}']


def test_deep_find(spark):
    html = '<script>{"K": {"k": [1, {"k": "x"}]}, "z": {"k": null}}</script>'
    rows = pg.deep_find(page_table(spark, html), ["K"]).orderBy("pos").collect()
    assert [(r.kind, r.value) for r in rows] == [
        ("dict", '{"k": [1, {"k": "x"}]}'), ("list", '[1, {"k": "x"}]'), ("str", "x"), ("null", None)]


def test_node_walk_matches_a_plain_walk(spark):
    import random

    rng = random.Random(5)

    def tree(depth):
        pick = rng.random()
        if depth > 6 or pick < 0.4:
            return rng.choice([1, -0.5, 1e5, True, False, None, "", "é", '{"a": 1}', 10**20, "\ud800"])
        if pick < 0.7:
            return [tree(depth + 1) for _ in range(rng.randint(0, 4))]
        return {f"k{rng.randint(0, 9)}": tree(depth + 1) for _ in range(rng.randint(0, 4))}

    def walk(value, key=None):
        yield key, value
        for k, v in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ():
            yield from walk(v, k if isinstance(value, dict) else None)

    trees = [{"root": tree(0)} for _ in range(200)]
    table = page_table(spark, *[f"<script>{json.dumps(t)}</script>" for t in trees])
    got = {}
    for r in pg.json_nodes(table).orderBy("page_id", "pos").collect():
        got.setdefault(r.page_id, []).append((r.key, r.kind, r.text))
    kinds = {str: "str", bool: "bool", int: "num", float: "num", dict: "dict", list: "list", type(None): "null"}
    for i, t in enumerate(trees):
        want = [
            (k, kinds[type(v)],
             None if isinstance(v, (dict, list, type(None))) else str(v).encode("utf-8", "replace").decode())
            for k, v in walk(t)
        ]
        assert got[i] == want


def test_deep_json_is_read_whole(spark):
    deep = '{"a":' * 300 + '{"comment":"far","star":1}' + "}" * 300
    rows = pg.parse_reviews(page_table(spark, f"<script>{deep}</script>"), WHEN).collect()
    assert [r.review_text for r in rows] == ["far"]


def test_page_columns_are_pruned_and_narrow(spark):
    plan = pg.parse_reviews(page_table(spark, SAMPLE_PAGE), WHEN)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    plan = pg.parse_product_snapshots(page_table(spark, SAMPLE_PAGE), WHEN)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_very_long_runs_and_scripts(spark):
    """Patterns must not recurse per character."""
    from pagewright.functions import html as hx
    from pagewright.functions import text as tx

    df = spark.sql("SELECT repeat('a', 2000000) AS x, concat('<script>', repeat('x ', 1000000), '</script>y') AS h")
    row = df.select(
        tx.repeated_char_ratio(F.col("x")).alias("r"), tx.normalize_text(F.col("h")).alias("n"),
        hx.visible_text(F.col("h")).alias("v"), F.size(hx.json_texts(F.col("h"))).alias("j"),
    ).first()
    assert (row.r, row.v, row.j) == (1.0, "y", 0)


def test_more_pages_than_one_slice(spark):
    htmls = [f'<script>{{"reviews": [{{"text": "t{i}"}}]}}</script>' for i in range(200)]
    rows = pg.parse_reviews(page_table(spark, *htmls).coalesce(1), WHEN).collect()
    assert sorted((r.page_id, r.review_text) for r in rows) == [(i, f"t{i}") for i in range(200)]


def test_a_payload_is_parsed_once(spark, capsys):
    texts = ['{"b": 1, "a": {"reviews": [{"comment": "x", "rating": 5}]}}', "no json", None, "[" * 100_000]
    df = spark.createDataFrame([(i, PRODUCT_URL, t) for i, t in enumerate(texts)], "i int, url string, payload string")
    rows = pg.parse_payload_reviews(df, WHEN)
    rows.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    canonical = '{"a": {"reviews": [{"comment": "x", "rating": 5}]}, "b": 1}'
    assert [(r.i, r.review_text, r.response_hash) for r in rows.collect()] == [(0, "x", hashlib.sha256(canonical.encode()).hexdigest())]


def test_shell_reason_alone_is_that_of_all_signals(spark):
    words = lambda n: f"<p>{'w ' * n}</p>"
    review = '<script>{"reviews":[{"text":"a","star":5}]}</script>'
    title = '<meta property="og:title" content="t"><meta property="product:price:amount" content="1">'
    parts = [(m, w, r, t) for m in ("", '<div id="main"></div>', SHELL_PAGE) for w in (words(5), words(300)) for r in ("", review) for t in ("", title)]
    htmls = ["".join(p) for p in parts] + [f"<html>{t}<body>{w}</body>{m}</html>" for m, w, _, t in parts] + ["", None, "<body></body>" + words(300)]
    pages = page_table(spark, *htmls).withColumns({"final_url": F.col("url"), "status_code": F.lit(200)})
    facts = {r.page_id: r.shell_reason for r in pg.page_facts(pages, WHEN).collect()}
    full = {r.page_id: r.shell_reason for r in pg.detect_shell_pages(pages).collect()}
    assert facts == full and len(full) == len(htmls) and len(set(full.values())) == 2
    code = pg.page_facts(pages, WHEN)._jdf.queryExecution().optimizedPlan().toString()
    assert "visible_text_length" not in code
