import random
import tempfile

import pytest
from pyspark.sql import functions as F

from pagewright.operators import sketches as sk


def table(spark, n=40000):
    """A third of the rows in one group."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7))
    return spark.range(n).select(
        key.alias("k"), (F.col("id") % 5).alias("day"), F.expr("id * 7919 % 9001").alias("user"), F.expr("cast(id * 104729 % 50021 as double)").alias("x")
    )


def states_of(rows, by=("k", "day")):
    return sk.sketch_states(rows, by, {"users": F.col("user")}, {"x": F.col("x")})


def test_merged_states_are_within_the_bounds(spark):
    rows = table(spark)
    states = states_of(rows)
    got = {r.k: r for r in sk.estimates(sk.merge_states(states, ["k"]), (0.1, 0.5, 0.9)).collect()}
    exact = {r.k: r for r in rows.groupBy("k").agg(F.count("*").alias("n"), F.count_distinct("user").alias("u"), F.sort_array(F.collect_list("x")).alias("xs")).collect()}
    assert set(got) == set(exact)
    for k, want in exact.items():
        assert got[k].n_rows == want.n and abs(got[k].users / want.u - 1) < 3 * 0.0163
        for share, value in ((0.1, got[k].x_p10), (0.5, got[k].x_p50), (0.9, got[k].x_p90)):
            rank = sum(x <= value for x in want.xs) / want.n
            assert abs(rank - share) < 0.0275


def test_any_order_of_merges_is_within_the_bounds(spark):
    rows = table(spark, 30000)
    states, schema = states_of(rows).collect(), states_of(table(spark, 10)).schema
    exact = {r.k: (r.n, r.u) for r in rows.groupBy("k").agg(F.count("*").alias("n"), F.count_distinct("user").alias("u")).collect()}
    rng = random.Random(1)
    for parts in (1, 3, 8):
        rng.shuffle(states)
        halves = [spark.createDataFrame(states[i::2], schema).repartition(parts) for i in range(2)]
        once = sk.merge_states(halves[0], ["k"]).unionByName(sk.merge_states(halves[1], ["k"]))
        got = {r.k: r for r in sk.estimates(sk.merge_states(once, ["k"])).collect()}
        assert set(got) == set(exact)
        assert all(got[k].n_rows == n and abs(got[k].users / u - 1) < 3 * 0.0163 for k, (n, u) in exact.items())


def test_periods_are_stored_and_replaced(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/states"
    rows = table(spark, 9000)
    for day in range(5):
        sk.append_states(states_of(rows.filter(F.col("day") == day)), path, "day")
    sk.append_states(states_of(rows.filter("day = 2")), path, "day")  # once more
    stored = spark.read.parquet(path)
    total = sk.estimates(sk.merge_states(stored)).first()
    assert total.n_rows == 9000 and abs(total.users / 9000 - 1) < 0.05
    some = sk.estimates(sk.merge_states(stored.filter("day BETWEEN 1 AND 2"))).first()
    assert some.n_rows == 3600


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", None, None), ("a", None, None), (None, 1, 2.0)], "k string, user int, x double")
    got = {r.k: (r.n_rows, r.users, r.x_p50) for r in sk.estimates(sk.sketch_states(rows, ["k"], {"users": F.col("user")}, {"x": F.col("x")})).collect()}
    assert got == {"a": (2, 0, None), None: (1, 1, 2.0)}
    assert sk.estimates(states_of(table(spark, 0))).count() == 0
    assert sk.estimates(sk.merge_states(states_of(table(spark, 0)), ["k"])).count() == 0
    assert pytest.approx(sk.estimates(sk.merge_states(states_of(table(spark, 5)))).first().users) == 5
