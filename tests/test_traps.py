"""Differences between engines that are easy to get wrong, one test each."""

import json

from pyspark.sql import functions as F

from pagewright.functions import html as hx
from pagewright.functions import text as tx
from pagewright.operators import features as ft
from pagewright.operators import pages as pg
from pagewright.sources import io
from tests.test_pages import WHEN, page_table


def apply(spark, expr, *items):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, x string")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_white_space_is_exactly_what_python_strips(spark):
    every = [chr(c) for c in [*range(0x3100), 0xFEFF, 0x180E, 0x200B, 0x2060]]
    got = apply(spark, lambda c: c.rlike(f"^[{tx.SPACES}]$"), *every)
    assert got == [c.isspace() for c in every]


def test_missing_cells_become_empty_not_nan(spark):
    assert apply(spark, tx.normalize_text, None) == [""]
    assert apply(spark, tx.mask_identifier, None) == [""]


def test_ids_and_words_survive_csv(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("007", 'a "b"\nc, d\\', "NA"), ("1e5", " x\r\ny ", "none")]
    io.write_csv(spark.createDataFrame(rows, "product_id string, review_text string, w string"), path)
    got = sorted(tuple(r) for r in io.read_csv(spark, path).collect())
    assert got == sorted(rows)


def test_comma_is_always_a_decimal_point(spark):
    assert apply(spark, tx.to_numeric_string, "1,234") == ["1.234"]
    assert apply(spark, tx.price_band, "Rp150.000", "-7", "2.000.000") == ["budget", "budget", None]


def test_order_is_text_order(spark):
    df = spark.createDataFrame([("p", "9", 0), ("p", "10", 1)], "product_id string, review_time_display string, ord int")
    got = {r.review_time_display: r.relative_review_order for r in ft.review_order(df, "ord").collect()}
    assert got == {"10": 1, "9": 2}


def test_state_assignment_ends_at_the_first_brace_and_semicolon(spark):
    cut = '<script>x; window.__STATE__ = {"a": "};", "b": 1};</script>'
    assert pg.json_blobs(page_table(spark, cut)).count() == 0
    spaced = '<script>window.__STATE__ = {"a": 1}</script>'  # no semicolon, blanks around the sign
    assert pg.json_blobs(page_table(spark, spaced)).count() == 0


def test_trailing_text_and_single_quotes_are_not_json(spark):
    for body in ('{"a": 1} {"b": 2}', "{'a': 1}"):
        assert pg.json_blobs(page_table(spark, f"<script>{body}</script>")).count() == 0


def test_two_visible_texts(spark):
    html = "<title>T</title><!-- a > b --><STYLE>x</style><p>A &amp; B</p>"
    row = spark.createDataFrame([(html,)], "h string").select(hx.visible_text(F.col("h")), hx.block_text(F.col("h"))).first()
    assert tuple(row) == ("T b --> A & B", "t a &amp; b")


def test_titles(spark):
    html = ["<TITLE>A &lt;b</TITLE>", "<title x='1'>Up\n  Per</title>", "<title></title>", "none"]
    assert apply(spark, hx.snapshot_title, *html) == ["A <b", None, None, None]
    assert apply(spark, hx.block_title, *html) == ["a &lt;b", "up per", "", ""]


def test_product_ids(spark):
    got = apply(
        spark, hx.extract_product_id, "https://s.example/p-i.1.22?itemid=9&itemid=8", "https://s.example/x?product_id=a+b%2F",
        "https://s.example/12/x34;p=5?q=6", "https://s.example/abc def", "https://s.example/p7?itemid=",
    )
    import hashlib

    assert got == ["9", "a b/", "34", hashlib.sha256(b"https://s.example/abc def").hexdigest()[:16], "7"]


def test_scalar_text_of_numbers_and_flags(spark):
    blob = {"reviews": [{"text": 1e5, "star": True}, {"text": 12345678901234567890, "star": 1.0}]}
    rows = pg.parse_reviews(page_table(spark, f"<script>{json.dumps(blob)}</script>"), WHEN).orderBy("review_ord").collect()
    assert [(r.review_text, r.star_rating) for r in rows] == [
        ("100000.0", "True"), ("12345678901234567890", "1.0")]


def test_links_are_resolved_deduplicated_and_capped(spark):
    html = "".join(f'<a href="{h}">' for h in ("?page=2", "/p?page=2", "?page=2", "x/../reviews", "#rating", "/other"))
    links = pg.discover_links(page_table(spark, html, url="https://s.example/p"), 4).orderBy("page_no").collect()
    assert [r.link for r in links] == [
        "https://s.example/p", "https://s.example/p?page=2", "https://s.example/reviews", "https://s.example/p#rating"]


def test_urls_and_entities_match_the_standard_library(spark):
    from html import unescape
    from urllib.parse import urljoin

    bases = ["https://h.example/a/b?q=1#f", "http://h.example", "/x/y"]
    links = ["", "x", "../x", "/r/./s", "//o/p", "?p=2", "#f", "http://o/x", "mailto:q", "a//b", "..", "?", "//", " x\t"]
    pairs = [(b, l) for b in bases for l in links]
    df = spark.createDataFrame(pairs, "b string, l string")
    for r in df.select("b", "l", hx.resolve_url(F.col("b"), F.col("l")).alias("y")).collect():
        assert r.y == urljoin(r.b, r.l), (r.b, r.l)
    texts = ["&amp;lt;", "&notit;", "&#128;&#0;&#xD800;", "&#x110000;&#99999999999;", "&", "&;", "&zzz;", "&eacute&Eacute;", "&#xFDD0;a"]
    assert apply(spark, hx.unescape_html, *texts) == [unescape(t) for t in texts]
