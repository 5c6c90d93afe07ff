import tempfile
from pathlib import Path

import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from pagewright.sources import io
from pagewright.sources import pagefiles as pf

ROWS = "kind string, stage string, product_idx int, page_no int, body string"


def rows_of(n=3000):
    rows = [("page", "product_snapshot", i, 1, f"<p>snapshot {i} é</p>") for i in range(0, n, 100)]
    rows += [("page", "review_harvest", i, p, f"<p>{i} {p}</p>\n") for i in range(0, n, 300) for p in (1, 2)]
    rows += [("payload", "review_harvest", i, 1, '{"a": 1}') for i in range(0, n, 500)]
    return rows + [("rendered", "review_harvest", 7, 3, None), ("page", "review_harvest", 5, 1, "")]


def written(spark, rows):
    path = tempfile.mkdtemp(prefix="run-")
    pf.write_files(spark.createDataFrame(rows, ROWS).repartition(4), path)
    return path


def content(df):
    return sorted(map(str, df.select("kind", "stage", "product_idx", "page_no", "body").collect()))


def test_round_trip(spark):
    rows = rows_of()
    path = written(spark, rows)
    want = sorted(str(tuple(r)) for r in [(*r[:4], r[4] or "") for r in rows])
    assert sorted(str(tuple(r)) for r in pf.read_files(spark, path).select("kind", "stage", "product_idx", "page_no", "body").collect()) == want
    assert {p.name for p in Path(path).iterdir()} == {f"products_{k:07d}" for k in range(3)}
    pf.write_files(spark.createDataFrame([("page", "review_harvest", 5, 1, "new")], ROWS), path)
    assert pf.read_files(spark, path).filter("product_idx = 5").first()["body"] == "new" and pf.read_files(spark, path).count() == len(rows)
    pf.write_files(spark.createDataFrame(rows[:2], ROWS), path, "overwrite")
    assert pf.read_files(spark, path).count() == 2


class Watched:
    """A file system that notes what is opened."""

    def __init__(self, system):
        self.system, self.opened = system, []

    def open_input_stream(self, path):
        self.opened.append(path)
        return self.system.open_input_stream(path)

    def __getattr__(self, name):
        return getattr(self.system, name)


def test_a_filter_opens_matching_files_only(spark, monkeypatch):
    path = written(spark, rows_of())
    wanted = "kind = 'payload' AND product_idx BETWEEN 400 AND 2100 AND length(body) > 0"
    found = pf.read_files(spark, path).filter(wanted)
    assert sorted(r.product_idx for r in found.collect()) == [500, 1000, 1500, 2000]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and "kind#" not in plan.split("Filter", 1)[1].split("\n")[0]  # Spark tests the body alone
    system = Watched(pf.fs.LocalFileSystem())
    monkeypatch.setattr(pf, "file_system", lambda p: (system, p))
    reader = pf.PageFileReader({"path": path})
    assert not list(reader.pushFilters([ds.EqualTo(("kind",), "payload"), ds.GreaterThanOrEqual(("product_idx",), 400), ds.LessThanOrEqual(("product_idx",), 2100)]))
    rows = [r for part in reader.partitions() for batch in reader.read(part) for r in batch.to_pylist()]
    assert len(rows) == len(system.opened) == 4 and all("_payload.json" in p for p in system.opened)


def test_names_and_folders_are_chosen_before_listing(spark, monkeypatch):
    path = written(spark, rows_of())
    listed = []
    selector = pf.fs.FileSelector
    monkeypatch.setattr(pf.fs, "FileSelector", lambda p: listed.append(p) or selector(p))
    reader = pf.PageFileReader({"path": path})
    left = list(reader.pushFilters([ds.GreaterThanOrEqual(("product_idx",), 1900), ds.In(("kind",), ("page",)), ds.StringContains(("body",), "x"), ds.LessThan(("size",), 9)]))
    assert [type(f) for f in left] == [ds.StringContains, ds.LessThan]
    chosen = reader.chosen()
    assert {f[2]["product_idx"] for f in chosen} == set(range(1900, 3000, 100)) and not any(p.endswith("products_0000000") for p in listed)


def test_small_files_are_packed_by_bytes(spark):
    path = written(spark, rows_of())
    reader = pf.PageFileReader({"path": path, "partitionbytes": "1000", "opencost": "100"})
    sizes = [len(p.files) for p in reader.partitions()]
    assert max(sizes) == 10 and sum(sizes) == len(rows_of()) and len(sizes) == -(-sum(sizes) // 10)
    assert pf.read_files(spark, path).rdd.getNumPartitions() == 1


def test_a_failed_write_leaves_nothing(spark):
    path = written(spark, rows_of()[:3])
    bad = spark.createDataFrame(rows_of()[3:9], ROWS).withColumn("body", F.when(F.col("product_idx") >= 800, F.raise_error(F.lit("no body"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="no body"):
        pf.write_files(bad, path)
    assert pf.read_files(spark, path).count() == 3 and not list(Path(path).glob("_staging*"))


def test_an_empty_folder(spark):
    assert pf.read_files(spark, tempfile.mkdtemp(prefix="run-")).count() == 0


def test_a_task_reports_folders_and_new_folders_move_as_one(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="run-")
    writer = pf.PageFileWriter({"path": root}, False)
    batch = lambda rows: pf.pa.RecordBatch.from_pylist([dict(zip(("kind", "stage", "product_idx", "page_no", "body"), r, strict=True)) for r in rows])
    done = [writer.write(iter([batch(rows_of()[k::2])])) for k in range(2)]
    assert all(m.folders == [f"products_{k:07d}" for k in range(3)] for m in done) and len(str(done)) < 600
    moved = []

    class Moves(Watched):
        type_name = "local"

        def move(self, a, b):
            moved.append(a)
            self.system.move(a, b)

    monkeypatch.setattr(pf, "file_system", lambda p: (Moves(pf.fs.LocalFileSystem()), p))
    writer.commit(done)
    assert sum("." not in m.rsplit("/", 1)[-1] for m in moved) == 3 and len(moved) < len(rows_of())
    assert len(list(Path(root).rglob("*.*"))) == len(rows_of()) and not list(Path(root).glob("_staging*"))


def test_many_folders_are_listed_by_the_tasks(spark):
    rows = [("page", "review_harvest", 1000 * k, p, f"{k} {p}") for k in range(40) for p in (1, 2)]
    path = written(spark, rows)
    reader = pf.PageFileReader({"path": path})
    parts = reader.partitions()
    assert len(parts) == 40 and not any(p.files for p in parts)
    found = pf.read_files(spark, path).filter("page_no = 2 AND product_idx >= 35000")
    assert sorted((r.product_idx, r.body) for r in found.collect()) == [(1000 * k, f"{k} 2") for k in range(35, 40)]


def test_page_files_of_the_jobs(spark):
    path = tempfile.mkdtemp(prefix="run-")
    rows = [("review_harvest", 0, 1, "a"), ("review_harvest", 0, 1, "a"), ("review_harvest", 0, 2, "x\n"), ("product_snapshot", 1234567, 9, None),
            (None, 2, 1, "z"), ("review_harvest", None, 1, "gone"), ("review_harvest", 4, None, "gone")]
    io.write_page_files(spark.createDataFrame(rows, "stage string, product_idx long, page_no int, html string").repartition(5), path)
    old = Path(path, "page_file=review_page_008_001.html")
    old.mkdir()
    (old / "part-0.txt").write_text("<p>\n\n")
    (old / "_SUCCESS").write_text("")
    found = io.read_page_files(spark, path)
    want = [("product_snapshot", 1234567, 1, ""), ("review_harvest", 0, 1, "a\na"), ("review_harvest", 0, 2, "x\n"), ("review_harvest", 2, 1, "z"), ("review_harvest", 7, 1, "<p>\n")]
    assert sorted(map(tuple, found.collect())) == want
    both = found.filter("page_no = 1").unionByName(found.filter("page_no = 2"))
    assert sorted(map(tuple, both.collect())) == want
    assert not list(Path(path).glob("page_file=*_00[12]_00[12].html"))
