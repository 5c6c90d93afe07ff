import pytest

from pagewright.operators import clean, features, hotkeys
from pagewright.plans import jobs
from pagewright.sources import io


def test_one_of_two_equal_texts_is_shuffled(spark):
    rows = [(1, "p", " a  b "), (2, "p", "a b"), (3, None, None)]
    found = clean.clean_reviews(spark.createDataFrame(rows, "ord long, product_id string, review_text string"), "ord")
    assert found.columns == ["ord", "product_id", "review_text", "normalized_review_text"]
    got = sorted((r.ord, r.review_text, r.normalized_review_text) for r in found.collect())
    assert [g[0] for g in got] == [1, 3] and got[0][1:] == ("a b", "a b") and got[1][1] == got[1][2]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "AS normalized_review_text" in plan.split("Join", 1)[0] and "normalized_review_text" not in plan.split("Join", 1)[1]


def test_only_keys_are_sorted_for_the_review_order(spark, tmp_path, monkeypatch):
    folder, texts = str(tmp_path), ['a "quoted", text', "two\nlines", "", None, "same", "same"]
    rows = [(i, f"p{i % 2}" if i % 5 else None, f"0{i % 3}" if i % 4 else None, texts[i % 6]) for i in range(60)]
    reviews = spark.createDataFrame(rows, "ord long, product_id string, review_time_display string, review_text string")
    for name, table in (("products", reviews.select("ord", "product_id").limit(0)), ("reviews", clean.treated_reviews(reviews))):
        table.repartition(3).write.parquet(f"{folder}/{name}.parquet")
    seen, chunk = [], hotkeys.chunk
    monkeypatch.setattr(hotkeys, "chunk", lambda rows, *a: seen.append(rows.columns) or chunk(rows, *a))
    assert jobs.metadata_features(spark, folder)["review_features_rows"] == 60
    assert seen and not any("review_text" in columns for columns in seen)
    found = spark.read.parquet(f"{folder}/review_features.parquet")
    got = {r.ord: r.relative_review_order for r in found.collect()}
    for product in ("p0", "p1"):
        own = sorted((r for r in rows if r[1] == product), key=lambda r: (r[2] or "", r[0]))  # cleaned, no time is empty text
        assert [got[r[0]] for r in own] == list(range(1, len(own) + 1))
    assert all(got[r[0]] is None for r in rows if r[1] is None)
    # the CSV copies are compressed and hold the same rows
    files = [f.name for f in (tmp_path / "review_features.csv").iterdir() if f.name.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    text = lambda table: sorted((int(r.ord), r.review_text or "", str(r.relative_review_order or "")) for r in table.collect())
    assert text(io.read_csv(spark, f"{folder}/review_features.csv")) == text(found)


@pytest.mark.parametrize("orders", [3, 1])
def test_equal_keys_are_numbered_apart(spark, orders):
    """Rows that are equal in product, time and order, NULLs included, all stay and get numbers of their own."""
    rows = [(None if i % 7 == 0 else i % orders, "p" if i % 3 else "q", None if i % 4 == 0 else f"{i % 2}") for i in range(200)]
    table = spark.createDataFrame(rows, "ord long, product_id string, review_time_display string").repartition(5)
    sides = [features.review_order(table, "ord", stable=stable) for stable in (True, False)]
    assert sides[0].columns == sides[1].columns and sides[0].schema["relative_review_order"].dataType == sides[1].schema["relative_review_order"].dataType
    assert sorted(map(str, sides[0].collect())) == sorted(map(str, sides[1].collect()))
