import random

import pytest
from pyspark.sql import functions as F

from pagewright.functions import text as tx
from pagewright.operators import clean as cl
from pagewright.operators import features as ft


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


def values(spark, expr, items, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_normalize(spark):
    spaces = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    got = values(spark, tx.normalize_text, ["  Halo   Dunia \n", None, f"{spaces}A{spaces}B{spaces}", "x​y"])
    assert got == ["halo dunia", "", "a b", "x​y"]


def test_mask(spark):
    got = values(spark, tx.mask_identifier, ["Budi", None, " ", "A", "ab", "abc", "é😀ü"])
    assert got == ["b**i", "", "", "*", "**", "a*c", "é*ü"]


def test_numeric_string(spark):
    assert values(spark, tx.to_numeric_string, [" 1,234 ", None, "4.9"]) == ["1.234", "", "4.9"]


def test_repeated_char_ratio(spark):
    items = ["baguuus banget!!!", "", None, "aab", "\r\r\r", "\n\n\n", "😀😀😀x", "a" * 3 + "b" * 29]
    assert values(spark, tx.repeated_char_ratio, items) == [round(6 / 17, 4), 0.0, 0.0, 0.0, 1.0, 0.0, 0.75, 1.0]


def test_half_even_rounding(spark):
    assert one(spark, tx.repeated_char_ratio, "aaa" + "bc" * 46 + "b") == 0.0312  # 3/96 = 0.03125


def test_emoji_counts_runs(spark):
    assert values(spark, tx.emoji_count, ["😀😀 a ☀", "ascii", None, "é", "❤️"]) == [2, 0, 0, 0, 1]


def test_to_number(spark):
    items = ["5", " 4.5 ", "5d", "abc", "", None, "1e3", "1,2", "NaN", "inf"]
    assert values(spark, tx.to_number, items) == [5.0, 4.5, None, None, None, None, 1000.0, None, None, float("inf")]


def test_bands(spark):
    items = ["0", "Rp100.000", "150000", "500000", "500001", "1000001", "-5", "", "1.234.5", None]
    got = values(spark, tx.price_band, items)
    assert got == ["budget", "budget", "mid", "mid", "upper_mid", "premium", "budget", None, None, None]
    assert values(spark, tx.sold_band, ["50", "50.5", "250", "1,2rb"]) == ["low", "medium", "high", "low"]
    edges = values(spark, lambda c: tx.band_numeric(c), [-1.0, -1.001, float("inf"), float("nan")], "double")
    assert edges == ["budget", None, "premium", None]


def test_template_key_covers_all_digits(spark):
    assert one(spark, tx.template_key, "a 12 b ٣٤") == "a <num> b <num>"


def test_clean_reviews(spark):
    rows = [
        ("1", "Bagus sekali", "2026-01-01", "5", "Lutfi", True, None),
        ("1", "  bagus   sekali ", "2026-01-01", "5", "Lutfi", True, False),
        (None, "x", None, "bad", None, None, None),
        (None, "X", None, None, None, None, None),
    ]
    df = spark.createDataFrame(
        rows,
        "product_id string, review_text string, review_time_display string, star_rating string, "
        "reviewer_name_masked string, media_flag boolean, seller_reply_flag boolean",
    )
    got = sorted(cl.clean_reviews(df).collect(), key=lambda r: r.review_text)
    assert [(r.review_text, r.star_rating, r.reviewer_name_masked) for r in got] == [
        ("bagus sekali", 5.0, "l***i"), ("x", None, "")]
    assert got[1].media_flag is False and got[0].normalized_review_text == "bagus sekali"


def test_clean_products_keeps_the_first(spark):
    rows = [(3, " p ", "u", "B"), (1, "p", "u ", "A  a"), (2, "q", "u", None)]
    df = spark.createDataFrame(rows, "ord int, product_id string, product_url string, title string").repartition(3)
    got = sorted(tuple(r) for r in cl.clean_products(df, "ord").collect())
    assert got == [(1, "p", "u", "a a"), (2, "q", "u", "")]


def test_cleaning_is_idempotent_and_partition_free(spark):
    rng = random.Random(1)
    words = ["A", " a", "b  B", "", None, "c"]
    rows = [(i, rng.choice(["1", None]), rng.choice(words), rng.choice(["t", None]), rng.choice(["5", "x"])) for i in range(200)]
    df = spark.createDataFrame(rows, "ord int, product_id string, review_text string, review_time_display string, star_rating string")
    once = cl.clean_reviews(df.coalesce(1), "ord")
    again = cl.clean_reviews(once.drop("normalized_review_text"), "ord")
    spread = cl.clean_reviews(df.repartition(8), "ord")
    as_set = lambda d: sorted(map(str, d.collect()))
    assert as_set(once) == as_set(again) == as_set(spread)


def test_features_with_missing_columns(spark):
    df = spark.createDataFrame([("1", "ok", 0), ("1", "!!! " * 9, 1)], "product_id string, review_text string, ord int")
    rows = ft.build_review_features(df, "ord").orderBy("ord").collect()
    assert [r.relative_review_order for r in rows] == [1, 2]
    assert not rows[0].variant_present_flag and not rows[0].extreme_rating_flag
    assert rows[0].short_review_flag and not rows[1].short_review_flag and rows[1].exclamation_count == 27


def test_features(spark):
    df = spark.createDataFrame(
        [("1", "baguuus banget!!!", 5, "Merah", "2026-01-01")],
        "product_id string, review_text string, star_rating int, variant_text string, review_time_display string",
    )
    row = ft.build_review_features(df).first()
    assert row.text_length == 17 and row.variant_present_flag and row.extreme_rating_flag
    assert row.relative_review_order == 1 and row.repeated_char_ratio == 0.3529


def test_review_order(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice(["10", "9", "2", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "ord int, product_id string, review_time_display string")
    got = {r.ord: r.relative_review_order for r in ft.review_order(df.repartition(6), "ord").collect()}
    want, seen = {}, {}
    for ord_, product, time in sorted(rows, key=lambda r: (r[1] or "", r[2] is None, r[2] or "", r[0])):
        seen[product] = seen.get(product, 0) + 1
        want[ord_] = seen[product] if product is not None else None
    assert got == want


def test_input_order_numbering_spans_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 3).alias("ord"), F.lit("t").alias("review_text")).repartition(7)
    rows = ft.review_order(df, "ord").orderBy("ord").collect()
    assert [r.relative_review_order for r in rows] == list(range(1, 1001))


REVIEWS = "product_id string, review_text string, star_rating int, variant_text string, review_time_display string"


def test_aggregates(spark):
    reviews = spark.createDataFrame(
        [("1", "mantap", 5, "", "2026-01-01"), ("1", "Mantap ", 4, "", "2026-01-02"), ("1", "beli 2", 3, "", "x"),
         ("1", "beli 10", 1, "", "x"), ("9", "unknown product", 1, "", "x")],
        REVIEWS,
    )
    products = spark.createDataFrame(
        [("1", "elektronik", "150000", "250", "4.8", "100"), ("2", None, "1", "1", None, None), ("1", "later", "1", "1", "", "")],
        "product_id string, category_breadcrumb string, price_display string, sold_count_display string, rating_avg_display string, rating_count_display string",
    ).coalesce(1)
    rows = {r.product_id: r for r in ft.build_product_aggregates(reviews, products).collect()}
    assert set(rows) == {"1", "2"}
    r = rows["1"]
    assert (r.price_band, r.sold_count_band, r.category_breadcrumb) == ("mid", "high", "elektronik")
    assert (r.review_count, r.duplicate_ratio, r.near_template_ratio) == (4, 0.25, 0.5)
    assert (r.extreme_rating_ratio, r.short_review_ratio, r.review_density_proxy) == (0.5, 1.0, 1.0)
    assert rows["2"].review_count == 0 and rows["2"].review_density_proxy == 0.0


def test_aggregates_without_reviews_or_products(spark):
    products = spark.createDataFrame([("1", "150000")], "product_id string, price_display string")
    none = spark.createDataFrame([], REVIEWS)
    row = ft.build_product_aggregates(none, products).first()
    assert (row.review_count, row.review_density_proxy, row.sold_count_band) == (0, 0.0, "unknown")
    reviews = spark.createDataFrame([(None, "a", 5, "", "x"), ("1", "a", 5, "", "x")], REVIEWS)
    alone = ft.build_product_aggregates(reviews, products.limit(0)).collect()
    assert len(alone) == 2 and "price_band" not in alone[0]


def test_null_products_meet(spark):
    products = spark.createDataFrame([(None, "150000")], "product_id string, price_display string")
    reviews = spark.createDataFrame([(None, "a", 5, "", "x")], REVIEWS)
    assert ft.build_product_aggregates(reviews, products).first().review_count == 1


def test_a_hot_product_is_spread(spark):
    """Copies combine before the shuffle and the distinct counts need no Expand."""
    reviews = spark.createDataFrame([("1", "a", 5, "", "x")], REVIEWS)
    plan = ft.product_rollup(ft.text_features(reviews))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan and plan.count("Exchange") <= 3
