import json
import random

import pytest
from pyspark.sql import functions as F

from pagewright.operators import jsonwalk as jw
from pagewright.operators import pages as pg


def random_value(rng, depth):
    kind = rng.randrange(8) if depth else rng.randrange(6)
    if kind == 6:
        return [random_value(rng, depth - 1) for _ in range(rng.randrange(4))]
    if kind == 7:
        keys = rng.sample(["b", "a", "Name", 'q"t', "é", "", "z.y", "name"], rng.randrange(5))
        return {k: random_value(rng, depth - 1) for k in keys}
    return [None, True, rng.randrange(-9, 10**6), rng.randrange(100) / 8, 'te"xt {é}\n', '{"looks": "like"}'][kind]


def page_rows(spark, values):
    script = lambda v: f"<script>{v if isinstance(v, str) else json.dumps(v)}</script>"
    return spark.createDataFrame([(i, "".join(map(script, v))) for i, v in enumerate(values)], "page_id long, html string").repartition(3)


def pages_of(rng, n):
    container = lambda: rng.choice([{k: random_value(rng, 3) for k in "kNj"}, [random_value(rng, 3) for _ in range(4)]])
    return [[container() for _ in range(rng.randint(1, 3))] for _ in range(n)] + [[], ['{"broken": '], [[], {}]]


def test_nodes_equal_those_of_the_parser(spark):
    pages = page_rows(spark, pages_of(random.Random(1), 60))
    columns = ["page_id", "blob", "pos", "key", "kind", "text", "size"]
    got = jw.json_nodes(pages)
    want = pg.json_nodes(pages).select(*columns)
    rows = lambda df: sorted(map(str, map(tuple, df.select(*columns).collect())))
    assert rows(got) == rows(want) and want.count() > 300
    assert not got.filter("truncated").count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_found_values_come_in_document_order(spark):
    pages = page_rows(spark, pages_of(random.Random(2), 60))
    got = jw.deep_find(pages, ["NAME", "é"]).orderBy("page_id", "blob", "path").collect()
    want = pg.deep_find(pages, ["NAME", "é"]).orderBy("page_id", "pos").collect()
    plain = lambda kind, value: json.loads(value) if kind in ("dict", "list") else value
    assert [(r.page_id, r.key, r.kind, plain(r.kind, r.value)) for r in got] == [(r.page_id, r.key, r.kind, plain(r.kind, r.value)) for r in want]
    assert len(want) > 20


def test_deep_pages_are_marked(spark):
    deep = 1
    for _ in range(12):
        deep = [deep]
    got = jw.json_nodes(page_rows(spark, [[{"a": deep}], [{"a": [[[1]]]}]]), depth=5)
    assert {(r.page_id, r.truncated, r.n) for r in got.groupBy("page_id", "truncated").agg(F.count("*").alias("n")).collect()} == {(0, True, 6), (1, False, 5)}
    with pytest.raises(ValueError):
        jw.walk(page_rows(spark, [[deep]]), depth=100)


def test_awkward_pages(spark):
    rows = [(1, None), (2, ""), (3, "<p>no script</p>"), (4, '<script>{"a": 1, "a": 2}</script>'), (None, '<script>{"a": [1]}</script>'), (5, '<script>{"a": [1]}</script>'), (5, '<script>{"a": [1]}</script>')]
    got = jw.walk(spark.createDataFrame(rows, "page_id long, html string")).collect()
    assert sorted((str(r.page_id), tuple(r.path), r.kind) for r in got) == sorted([("None", p, k) for p, k in (((0,), "dict"), ((0, 0), "list"), ((0, 0, 0), "num"))] + 2 * [("5", p, k) for p, k in (((0,), "dict"), ((0, 0), "list"), ((0, 0, 0), "num"))])
    assert jw.walk(spark.createDataFrame([], "page_id long, html string")).count() == 0
