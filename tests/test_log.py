import random

import pytest
from pagewright.operators import log as lg

SCHEMA = "run int, seq int, seed int, product_id string, page_no int, n int, stop_reason string, is_empty boolean, exempt boolean"


def random_log(seed, runs=25):
    rng = random.Random(seed)
    rows = []
    for run in range(runs):
        seq = 0
        for s in range(rng.randint(1, 5)):
            product = f"p{rng.randint(0, 1)}"
            exempt = rng.random() < 0.2
            for page in range(1, rng.randint(2, 9)):
                n = rng.choice([0, 0, 0, 3, 7])
                reason = "status_403" if rng.random() < 0.05 else None
                rows.append((run, seq, s, product, page, n, reason, rng.random() < 0.6, exempt))
                seq += 1
    return rows


def loop(rows, limit, cap, stop_fast, exempt=False):
    """Plain loop over the pages of each run."""
    kept = []
    for run in sorted({r[0] for r in rows}):
        counts, closed, streak, stopped = {}, set(), {}, False
        for r in [r for r in rows if r[0] == run]:
            _, seq, seed, product, _, n, reason, _, free = r
            if stopped or (limit and streak.get(seed, 0) >= limit) or (seed in closed and not (exempt and free)):
                continue
            if stop_fast and reason:
                stopped = True
                continue
            kept.append((run, seq))
            streak[seed] = 0 if n else streak.get(seed, 0) + 1
            counts[product] = counts.get(product, 0) + n
            if cap is not None and n and counts[product] >= cap and not (exempt and free):
                closed.add(seed)
    return kept


def keys(df):
    return sorted((r.run, r.seq) for r in df.select("run", "seq").collect())


def test_cuts_equal_a_loop(spark):
    rows = random_log(1)
    log = spark.createDataFrame(rows, SCHEMA).repartition(5)
    plain = log.drop("exempt")
    streak = lg.streak_cut(plain, 3)
    assert keys(streak) == loop(rows, 3, None, False)
    assert keys(lg.review_cap_cut(plain, 10)) == loop(rows, None, 10, False)
    both = lg.review_cap_cut(streak, 10)
    assert keys(both) == loop(rows, 3, 10, False)
    assert keys(lg.stop_fast_cut(both)) == loop(rows, 3, 10, True)


def test_exempt_rows_count_but_stay(spark):
    rows = random_log(2)
    # an exempt seed is never left early, so its pages do not close anything
    log = spark.createDataFrame(rows, SCHEMA)
    assert keys(lg.review_cap_cut(log, 10)) == loop(rows, None, 10, False, exempt=True)


def test_cut_order_matters(spark):
    # page 5 is blocked but lies behind the empty streak of its seed, so the run goes on
    rows = [(1, i, 0, "p", i, 0, "status_403" if i == 5 else None, False, False) for i in range(1, 6)]
    rows += [(1, 6, 1, "q", 1, 4, None, False, False)]
    log = spark.createDataFrame(rows, SCHEMA)
    right = lg.stop_fast_cut(lg.streak_cut(log, 3))
    assert keys(right) == [(1, 1), (1, 2), (1, 3), (1, 6)]
    wrong = lg.streak_cut(lg.stop_fast_cut(log), 3)
    assert keys(wrong) == [(1, 1), (1, 2), (1, 3)]


def test_empty_payload_streak(spark):
    rows = random_log(3)
    log = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {(r.run, r.seq): r.consecutive_empty_payloads for r in lg.empty_payload_streak(log).collect()}
    streak = {}
    for r in rows:
        streak[r[0]] = streak.get(r[0], 0) + 1 if r[7] else 0
        assert got[(r[0], r[1])] == streak[r[0]]
    assert len(got) == len(rows)


@pytest.mark.parametrize("budget", [5, 5000])
def test_budget(spark, budget):
    rows = random_log(4)
    log = spark.createDataFrame(rows, SCHEMA)
    got = lg.budget_cut(log, budget).collect()
    sizes = {}
    for r in rows:
        sizes[r[0]] = sizes.get(r[0], 0) + 1
    assert sorted((r.run, r.seq) for r in got) == [(r[0], r[1]) for r in rows if r[1] < budget]
    assert all(r.over_budget == (sizes[r.run] > budget) for r in got)


def test_run_summary(spark):
    rows = [
        (1, 1, 0, "p", 1, 4, None, False, False),
        (1, 2, 0, "p", 2, 0, "status_429", False, False),
        (2, 1, 0, "p", 1, 2, None, False, False),
    ]
    got = {r.run: tuple(r)[1:] for r in lg.run_summary(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (2, "status_429", 4), 2: (1, None, 2)}


def test_source_choice(spark):
    frame = lambda rows: spark.createDataFrame(rows, "seed int, review_text string")
    shells = spark.createDataFrame([(1,), (2,), (3,)], "seed int")
    payload, cards = frame([(1, "p1"), (4, "p4")]), frame([(1, "c1"), (2, "c2"), (4, "c4")])
    embedded = frame([(1, "e1"), (2, "e2"), (3, "e3"), (4, "e4")])
    got = lg.choose_source(shells, payload, cards, embedded).collect()
    assert sorted((r.seed, r.review_text, r.source) for r in got) == [
        (1, "p1", "payload"), (2, "c2", "card"), (3, "e3", "embedded"), (4, "e4", "embedded")]
    off = lg.choose_source(shells, payload, cards, embedded, fallback_enabled=False)
    assert off.count() == 4 and off.filter("source != 'embedded'").isEmpty()


def test_payload_numbers_skip_empty_payloads(spark):
    rows = spark.createDataFrame([(1, 2, "a"), (1, 5, "b"), (1, 5, "c"), (2, 9, "d")], "seed int, payload_no int, t string")
    got = {r.t: r.review_page for r in lg.number_payloads(rows).collect()}
    assert got == {"a": 1, "b": 2, "c": 2, "d": 1}


def test_link_match(spark):
    links = spark.createDataFrame([(1, 1, "u1"), (1, 2, "u2")], "seed int, page_no int, link string")
    pages = spark.createDataFrame([(9, "u1", "<p>"), (8, "u3", "<p>")], "page_id int, url string, html string")
    assert [tuple(r) for r in lg.match_links(links, pages).select("seed", "page_no", "page_id").collect()] == [(1, 1, 9)]
    assert [r.link for r in lg.missing_links(links, pages).collect()] == ["u2"]


def test_no_limit_keeps_everything(spark):
    rows = random_log(5)
    log = spark.createDataFrame(rows, SCHEMA)
    for cut in (lg.streak_cut, lg.review_cap_cut, lg.budget_cut):
        assert cut(log).count() == len(rows)


def test_a_group_is_cut_into_chunks(spark):
    """One group, several partitions: the carried values go through all of them."""
    from pagewright.operators import hotkeys

    table = spark.range(0, 200000).selectExpr("'g' AS g", "id AS at", "id % 7 AS n").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunks = hotkeys.chunk(table, ["g"], ["at"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert chunks.rows.select("_chunk").distinct().count() > 1
    got = chunks.running("total", "sum", chunks.rows["n"]).numbered("nth").done().orderBy("at").collect()
    total = 0
    for i, r in enumerate(got):
        total += i % 7
        assert (r.nth, r.total) == (i + 1, total)


def test_one_page_per_url(spark):
    pages = spark.createDataFrame([(2, "u", "a"), (1, "u", "b"), (3, "u", "c"), (4, "v", "a")], "page_id int, url string, stage string")
    assert sorted((r.page_id, r.url) for r in lg.one_per_url(pages, "page_id").collect()) == [(1, "u"), (4, "v")]
    assert sorted((r.page_id, r.url) for r in lg.one_per_url(pages, "page_id", "a").collect()) == [(2, "u"), (4, "v")]
