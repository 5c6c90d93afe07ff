import json

import pytest
from pyspark.sql import functions as F

from pagewright.operators import clean
from pagewright.plans import catalog, jobs
from pagewright.sources import io
from tests.fixtures import PAYLOAD, PRODUCT_URL, RENDERED_CARDS, SAMPLE_PAGE, SHELL_PAGE

WHEN = "2026-04-10T00:00:00+00:00"
PAGE = "page_id long, url string, final_url string, status_code int, html string"


def page_rows(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], PAGE)


SEED = "ord long, product_url string, category_quota string"


def url(i):
    return f"https://shop.example/p-i.1.{i}"


def reviews_page(texts, links=()):
    body = json.dumps({"reviews": [{"text": t, "star": 5} for t in texts]})
    anchors = "".join(f'<a href="{link}">x</a>' for link in links)
    return f"<html><title>t</title><body>{'word ' * 100}{anchors}<script>{body}</script></body></html>"


def test_snapshot_job_stops_at_the_first_block(spark):
    seeds = spark.createDataFrame([(i, url(i), "Rumah") for i in range(5)], SEED)
    rows = [(url(i), url(i), 403 if i == 2 else 200, SAMPLE_PAGE) for i in range(4)]
    out = jobs.snapshot_products(seeds, page_rows(spark, rows), WHEN)
    got = out["products"].orderBy("ord").collect()
    assert [r.product_id for r in got] == ["0", "1"] and got[0].seed_category_quota == "Rumah"
    assert out["summary"].collect()[0].asDict() == {"requests_made": 3, "stop_reason": "status_403", "rows_written": 2}
    assert out["manifest"].count() == 3 and [r.ord for r in out["missing"].collect()] == [4]


def test_harvest_follows_links_and_cuts(spark):
    page = lambda i, n: f"{url(i)}?page={n}"
    rows = [
        # seed 0: two pages with rows, then three empty ones; page 6 is never reached
        (url(0), url(0), 200, reviews_page(["a0"], [page(0, n) for n in range(2, 8)])),
        (page(0, 2), page(0, 2), 200, reviews_page(["a1", "a2"])),
        *[(page(0, n), page(0, n), 200, reviews_page([])) for n in (3, 4, 5)],
        (page(0, 6), page(0, 6), 403, reviews_page(["never"])),
        # seed 1: blocked on its second page, which ends the run
        (url(1), url(1), 200, reviews_page(["b0"], [page(1, 2), page(1, 3)])),
        (page(1, 2), page(1, 2), 429, reviews_page(["blocked"])),
        (url(2), url(2), 200, reviews_page(["never"])),
    ]
    seeds = spark.createDataFrame([(i, url(i), "x") for i in range(3)], SEED)
    out = jobs.harvest_reviews(seeds, page_rows(spark, rows), WHEN, max_empty_pages=3)
    got = out["reviews"].orderBy("seed", "page_no", "review_ord").collect()
    assert [r.review_text for r in got] == ["a0", "a1", "a2", "b0"]
    assert [r.review_page for r in got] == [1, 2, 2, 1] and got[1].source_url == page(0, 2)
    assert out["summary"].first().asDict() == {"requests_made": 7, "stop_reason": "status_429", "rows_written": 4}
    assert sorted(r.product_url for r in out["missing"].collect()) == [page(0, 7), page(1, 3)]
    assert [(r.seed, r.url) for r in out["dropped"].collect()] == [(0, page(0, 6))]


def test_no_limit_keeps_all_pages(spark):
    page = lambda n: f"{url(0)}?page={n}"
    rows = [(url(0), url(0), 200, reviews_page(["a"] , [page(n) for n in range(2, 40)]))]
    rows += [(page(n), page(n), 200, reviews_page([f"r{n} {k}" for k in range(5)] if n % 9 == 0 else [])) for n in range(2, 40)]
    out = jobs.harvest_reviews(spark.createDataFrame([(0, url(0), "x")], SEED), page_rows(spark, rows), WHEN)
    assert out["reviews"].count() == 21 and out["summary"].first().requests_made == 39
    assert out["dropped"].isEmpty() and out["missing"].isEmpty()


def test_a_page_stored_per_stage_counts_once(spark):
    seeds = spark.createDataFrame([(0, url(0), "x")], SEED)
    stages = ["review_harvest", "product_snapshot", "review_harvest"]
    rows = [(9 - i, url(0), url(0), 200, reviews_page([f"text {i}"]), stage) for i, stage in enumerate(stages)]
    pages = spark.createDataFrame(rows, PAGE + ", stage string")
    out = jobs.harvest_reviews(seeds, pages, WHEN)
    assert [r.review_text for r in out["reviews"].collect()] == ["text 2"]
    assert out["summary"].first().asDict() == {"requests_made": 1, "stop_reason": None, "rows_written": 1}
    assert jobs.snapshot_products(seeds, pages, WHEN)["products"].count() == 1


def test_json_that_is_too_deep_is_reported(spark):
    deep = '{"a":' * 200000 + "1" + "}" * 200000
    html = reviews_page(["kept"]).replace("</body>", f"<script>{deep}</script></body>")
    seeds = spark.createDataFrame([(0, url(0), "x")], SEED)
    out = jobs.harvest_reviews(seeds, page_rows(spark, [(url(0), url(0), 200, html)]), WHEN)
    assert [r.review_text for r in out["reviews"].collect()] == ["kept"]
    assert [(r.url, r.skipped_json) for r in out["skipped"].collect()] == [(url(0), 1)]


def test_job_plans(spark):
    """No cross join, and no single partition but for sums of one row."""
    seeds = spark.createDataFrame([(i, url(i), "Rumah") for i in range(5)], SEED)
    pages = page_rows(spark, [(url(i), url(i), 200, SAMPLE_PAGE) for i in range(5)])
    for found in (jobs.snapshot_products(seeds, pages, WHEN), jobs.harvest_reviews(seeds, pages, WHEN)):
        for name, rows in found.items():
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
            assert "Window" not in plan, name


def test_harvest_cap_is_page_granular(spark):
    links = [f"{url(0)}?page={n}" for n in (2, 3)]
    rows = [(url(0), url(0), 200, reviews_page(["a", "b"], links))]
    rows += [(u, u, 200, reviews_page([u + "x", u + "y"])) for u in links]
    seeds = spark.createDataFrame([(0, url(0), "x")], SEED)
    out = jobs.harvest_reviews(seeds, page_rows(spark, rows), WHEN, max_reviews_per_product=3)
    assert out["reviews"].count() == 4


@pytest.mark.parametrize("source", ["payload", "card", "nothing", "off"])
def test_harvest_of_a_shell_page(spark, source):
    seeds = spark.createDataFrame([(0, PRODUCT_URL, "x")], SEED)
    pages = page_rows(spark, [(PRODUCT_URL, PRODUCT_URL, 200, SHELL_PAGE)])
    payloads = [(PRODUCT_URL, 1, "https://shop.example/api", '{"x": 1}')]
    if source == "payload":
        payloads.append((PRODUCT_URL, 2, "https://shop.example/api", PAYLOAD))
    payloads = spark.createDataFrame(payloads, "product_url string, payload_no int, source_url string, payload string")
    html = RENDERED_CARDS if source in ("card", "payload") else "<p></p>"
    rendered = spark.createDataFrame([(PRODUCT_URL, html, PRODUCT_URL)], "product_url string, html string, source_url string")
    out = jobs.harvest_reviews(seeds, pages, WHEN, payloads, rendered, fallback_enabled=source != "off")
    got = out["reviews"].orderBy("review_ord").collect()
    assert len(got) == (3 if source == "payload" else 2 if source == "card" else 0)
    assert out["summary"].first().rows_written == len(got)
    if source == "payload":
        assert {r.review_page for r in got} == {1} and got[0].source_url == "https://shop.example/api"


def test_tables_run_through(spark, tmp_path):
    """Files of a crawl, seeds, jobs and stage tables, end to end."""
    html, interim, processed, log = (str(tmp_path / d) for d in ("html", "interim", "processed", "log"))
    io.write_csv(spark.createDataFrame([("", "none"), (PRODUCT_URL, "tea")], "product_url string, category_quota string").coalesce(1), str(tmp_path / "seeds"))
    seeds = io.load_seeds(spark, str(tmp_path / "seeds"))
    assert [(r.ord, r.category_quota) for r in seeds.collect()] == [(0, "tea")]
    second = "https://tea.example/ratings/all"
    rows = [("product_snapshot", 0, 1, SAMPLE_PAGE), ("review_harvest", 0, 1, SAMPLE_PAGE), ("review_harvest", 0, 2, reviews_page(["late"]))]
    io.write_page_files(spark.createDataFrame(rows, "stage string, product_idx int, page_no int, html string"), html)
    seen = [("product_snapshot", PRODUCT_URL, PRODUCT_URL, 200), ("review_harvest", PRODUCT_URL, PRODUCT_URL, 200)]
    seen = spark.createDataFrame(seen, "stage string, source_url string, final_url string, status_code int")
    for stage in ("product_snapshot", "review_harvest"):
        io.append_manifest(jobs.manifest_rows(seen.filter(F.col("stage") == stage), stage, WHEN), log)
    pages = io.stored_pages(io.read_page_files(spark, html), io.read_manifest(spark, log), seeds)
    links = sorted((r.stage, r.page_no, r.url, r.status_code) for r in pages.collect())
    first = [("product_snapshot", 1, PRODUCT_URL, 200), ("review_harvest", 1, PRODUCT_URL, 200)]
    assert links[:2] == first and links[2][:2] == ("review_harvest", 2) and links[2][3] is None
    assert links[2][2].startswith("https://tea.example/") and (second in links[2][2] or "ratings" in links[2][2])
    with pytest.raises(FileNotFoundError, match="run the stage before"):
        jobs.clean_validate(spark, interim, processed)
    snapshots, harvested = jobs.snapshot_products(seeds, pages, WHEN), jobs.harvest_reviews(seeds, pages, WHEN)
    assert jobs.write_job(snapshots, interim, "products", log)["rows"] == 1
    assert jobs.write_job(harvested, interim, "reviews", log)["rows"] == 4
    cleaned = jobs.clean_validate(spark, interim, processed)
    assert (cleaned["products_rows"], cleaned["reviews_rows"]) == (1, 4)
    kept = spark.read.parquet(f"{processed}/reviews.parquet").orderBy("ord").collect()
    assert [r.ord for r in kept] == [0, 1, 2, 3] and {r.product_id for r in kept} == {"9001"}
    assert [r.star_rating for r in kept] == [4.0, 3.0, 5.0, 5.0] and [r.image_count for r in kept] == [0, 3, 0, 0]
    featured = jobs.metadata_features(spark, processed)
    assert (featured["review_features_rows"], featured["product_aggregates_rows"]) == (4, 1)
    row = spark.read.parquet(f"{processed}/product_aggregates.parquet").first()
    assert (row.review_count, row.price_band, row.review_density_proxy) == (4, "budget", 1.0)
    assert io.read_csv(spark, f"{processed}/reviews.csv").count() == 4
    assert json.loads(spark.read.text(f"{processed}/feature_manifest.json").first().value)["review_features_rows"] == 4
    assert spark.read.json(f"{interim}/reviews_raw_summary.json").first().rows_written == 4
    with pytest.raises(FileNotFoundError, match="run clean_validate"):
        jobs.metadata_features(spark, interim)


def test_seeds_of_several_files_keep_file_order(spark, tmp_path):
    """The second file is much larger, so it is read first."""
    path = tmp_path / "seeds"
    path.mkdir()
    (path / "part-00000.csv").write_text("product_url\nfirst\n")
    (path / "part-00001.csv").write_text("product_url\n" + "".join(f"later{i}\n" for i in range(2000)))
    got = io.load_seeds(spark, str(path)).orderBy("ord").collect()
    assert [r.product_url for r in got[:3]] == ["first", "later0", "later1"] and [r.ord for r in got] == list(range(2001))
    assert [r.product_url for r in io.load_seeds(spark, str(path), 1).collect()] == ["first"]
    with pytest.raises(ValueError, match="several files"):
        clean.with_order(io.read_csv(spark, str(path)), None)


def test_interim_csv_keeps_its_order(spark, tmp_path):
    interim, processed = str(tmp_path / "interim"), str(tmp_path / "processed")
    products = spark.createDataFrame([("1", "u")], "product_id string, product_url string")
    reviews = spark.createDataFrame([("1", "Same  Text", "a"), ("1", "same text", "b"), ("1", "other", "c")], "product_id string, review_text string, variant_text string")
    io.write_csv(products, f"{interim}/product_snapshots.csv")
    io.write_csv(reviews.coalesce(1), f"{interim}/reviews_raw.csv")
    jobs.clean_validate(spark, interim, processed)
    kept = spark.read.parquet(f"{processed}/reviews.parquet").orderBy("ord").collect()
    assert [(r.ord, r.variant_text) for r in kept] == [(0, "a"), (2, "c")]


def test_storage_folder(spark):
    from pagewright.sources import storage

    class Fake:
        """A session of a cluster without a checkpoint folder and with a local warehouse."""

        class sparkContext:  # noqa: N801
            applicationId, master = "app", "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default="file:/tmp/warehouse": default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.ensure_checkpoint_dir(Fake)
    assert storage.scratch_path(spark, "x").startswith(spark.sparkContext.getCheckpointDir())


def test_an_empty_table_leaves_no_csv(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not io.write_csv(spark.createDataFrame([], "a string"), path) and not (tmp_path / "none").exists()


def test_seeds(spark, tmp_path):
    path = str(tmp_path / "seeds")
    rows = [("u1 ", "a"), ("", "b"), (None, "c"), ("u2", "d")]
    io.write_csv(spark.createDataFrame(rows, "product_url string, category_quota string").coalesce(1), path)
    assert [r.product_url for r in io.load_seeds(spark, path).orderBy("ord").collect()] == ["u1", "u2"]
    assert [r.product_url for r in io.load_seeds(spark, path, 1).collect()] == ["u1"]
    blank = str(tmp_path / "blank")
    io.write_csv(spark.createDataFrame([("", "b")], "product_url string, category_quota string"), blank)
    with pytest.raises(ValueError, match="no valid product_url values"):
        io.load_seeds(spark, blank)
    with pytest.raises(ValueError, match="must include"):
        other = str(tmp_path / "other")
        io.write_csv(spark.createDataFrame([("b",)], "category_quota string"), other)
        io.load_seeds(spark, other)


def test_seed_template(spark):
    df = io.seed_template(spark.createDataFrame([("A",), ("B",)], "category string"), 2, "2026-04-24")
    assert sorted((r.category_quota, r.chosen_reason) for r in df.collect()) == [
        ("A", "manual seed slot 1"), ("A", "manual seed slot 2"), ("B", "manual seed slot 1"), ("B", "manual seed slot 2")]


def test_page_and_payload_files(spark, tmp_path):
    path = tmp_path / "html"
    path.mkdir()
    (path / "product_snapshot_001.html").write_text("<p>\na\n</p>\n")
    (path / "review_page_002_010.html").write_text("b")
    (path / "review_page_002_003_browser_payload.json").write_text(json.dumps({"source_url": "u", "payload": {"z": 1, "a": 2}}))
    (path / "review_page_002_001_browser_rendered_html.html").write_text("r")
    pages = io.read_page_files(spark, str(path))
    assert sorted(map(tuple, pages.collect())) == [
        ("product_snapshot", 0, 1, "<p>\na\n</p>\n"), ("review_harvest", 1, 10, "b")]
    assert [tuple(r) for r in io.read_payload_files(spark, str(path)).collect()] == [(1, 3, "u", '{"z":1,"a":2}')]
    assert [tuple(r) for r in io.read_rendered_files(spark, str(path)).collect()] == [(1, "r")]
    io.write_page_files(pages, str(tmp_path / "copy"))
    again = io.read_page_files(spark, str(tmp_path / "copy"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, pages.collect()))


def test_manifest_appends(spark, tmp_path):
    seeds = spark.createDataFrame([(0, PRODUCT_URL, "x")], SEED)
    pages = page_rows(spark, [(PRODUCT_URL, PRODUCT_URL, 403, "x")])
    manifest = jobs.snapshot_products(seeds, pages, WHEN)["manifest"]
    path = str(tmp_path / "manifest")
    io.append_manifest(manifest, path)
    io.append_manifest(manifest, path)
    rows = io.read_manifest(spark, path).collect()
    assert len(rows) == 2 and rows[0].stop_reason == "status_403" and rows[0].status_code == 403
    assert rows[0].stop_matched_text == "403" and rows[0].error is None


def test_pages_of_a_thin_table_are_parsed_by_many_tasks(spark, tmp_path):
    names = "cast(id AS string) AS p_name, 'b' AS p_brand, 'a b' AS p_type, cast(id % 50 AS int) AS p_size"
    spark.range(300).selectExpr("id AS p_partkey", *names.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    tasks = 2 * spark.sparkContext.defaultParallelism
    snapshots = catalog.product_pages(spark, str(tmp_path))
    assert snapshots.rdd.getNumPartitions() == tasks and snapshots.select("page_id").distinct().count() == 300
    _, pages, payloads, rendered = catalog._harvest_inputs(spark, str(tmp_path))
    # the pages are three tables over the parts: first, later and first pages once more
    assert [t.rdd.getNumPartitions() for t in (pages, payloads, rendered)] == [3 * tasks, tasks, tasks]
    assert pages.count() == 300 + 50 * (2 + 4 + 1) + 300
