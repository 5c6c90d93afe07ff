import random

from pyspark.sql import functions as F

from pagewright.operators import hierarchy as hi

PATHS = ["A > B > C", "A > B", "A>B > D", "A > > C", "", None, " A ", "B > C > D > E"]


def plain(rows, depth=None):
    found = {}
    for path, band, user, ok in rows:
        parts = [p.strip() for p in (path or "").split(">") if p.strip()]
        for level in range(len(parts[:depth]) + 1):
            node = " > ".join(parts[:level])
            for key in ((level, node, band, False), (level, node, None, True)):
                found.setdefault(key, []).append((user, ok))
    return sorted(
        str((*key, len(v), len({u for u, _ in v if u is not None}), round(sum(bool(ok) for _, ok in v) / len(v), 6))) for key, v in found.items()
    )


def test_levels_equal_a_loop(spark):
    rng = random.Random(1)
    rows = [(rng.choice(PATHS), rng.choice(["low", "high", None]), rng.choice([None, *range(9)]), rng.choice([True, False, None])) for _ in range(400)]
    table = spark.createDataFrame(rows, "path string, band string, user int, ok boolean").repartition(4)
    for depth in (None, 1):
        got = hi.level_rollup(table, "path", "band", {"users": F.col("user")}, {"oks": F.col("ok")}, depth)
        cells = [(r.level, r.node, r.band, r.all_bands, r.n_rows, r.users, round(r.oks, 6)) for r in got.collect()]
        assert sorted(map(str, cells)) == plain(rows, depth)


def test_one_pass_and_no_single_task(spark):
    table = spark.range(1000).select(F.lit("A > B").alias("path"), F.lit("x").alias("band"), F.col("id").alias("u"))
    plan = hi.level_rollup(table, "path", "band", {"users": F.col("u")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "SinglePartition" not in plan and "Expand" in plan


def test_empty_table(spark):
    assert hi.level_rollup(spark.createDataFrame([], "path string, band string"), "path", "band").count() == 0
