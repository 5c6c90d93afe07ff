import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import mixing
from tests.llm.helpers import awkward, docs, prose

LABELS = "doc_id long, quality int, toxic int, text string, tokens string"
WEIGHTS = {"good": 0.8, "low": 0.15, "toxic": 0.05}


def corpus(seed=3, n=600):
    rng = random.Random(seed)
    pairs, labels = [], {}
    for i in range(n):
        kind = rng.choice(["good", "good", "low", "toxic"])
        text = prose(rng, rng.randint(20, 120), 300)
        if kind == "low":
            text = " ".join(w + "###" for w in text.split())
        if kind == "toxic":
            text += " idiot scum trash moron"
        pairs.append((i, text))
        labels[i] = kind
    return pairs, labels


def label_rows(spark, labels):
    rows = [(i, 0 if k == "low" else 1, int(k == "toxic"), "x", "y") for i, k in labels.items()]
    return spark.createDataFrame(rows, LABELS)


def test_rates_meet_the_targets(spark):
    pairs, kinds = corpus()
    train = {i: k for i, k in kinds.items() if i % 2}
    got = mixing.mixed(docs(spark, pairs), label_rows(spark, train), WEIGHTS, "good").collect()
    assert len(got) == len(pairs)
    held_out = [r for r in got if r.doc_id % 2 == 0]
    right = sum(list(WEIGHTS)[int(np.argmax(r.p))] == kinds[r.doc_id] for r in held_out)
    assert right >= 0.9 * len(held_out)
    tokens, p, rate = np.array([r.tokens for r in got]), np.array([r.p for r in got]), np.array([r.rate for r in got])
    reached, have = (rate * tokens) @ p, tokens @ p
    wanted = np.array(list(WEIGHTS.values())) / WEIGHTS["good"] * have[0]
    assert np.allclose(reached / have.sum(), np.minimum(wanted, have) / have.sum(), atol=0.02)
    assert rate.min() >= 0 and rate.max() <= 1
    assert abs(sum(r.copies * r.tokens for r in got) / (rate * tokens).sum() - 1) < 0.1


def least_squares(tokens, p, weights, most, rounds=5000):
    """Plain projected gradient with small steps: the totals and the sum of squares it ends with."""
    have = tokens @ p
    share = np.array(list(weights.values()))
    target = share / share[0] * have[0]
    rate = np.ones(len(tokens))
    for _ in range(rounds):
        rate = np.clip(rate - 0.5 * p @ (((rate * tokens) @ p - target) / have), 0, most)
    total = (rate * tokens) @ p
    return total, ((total - target) ** 2 / have).sum(), ((have - target) ** 2 / have).sum()


@pytest.mark.parametrize(("weights", "most", "focus"), [
    ({"good": 0.8, "low": 0.15, "toxic": 0.05}, 1.0, 0.3), ({"good": 0.8, "low": 0.15, "toxic": 0.05}, 3.0, 1.0),
    ({"good": 0.9, "low": 0.07, "toxic": 0.0}, 1.0, 0.1), ({"good": 0.2, "low": 0.7, "toxic": 0.1}, 2.0, 0.3),
])
def test_squares_are_as_low_as_plain_projected_gradient_gets_them(spark, weights, most, focus):
    rng = np.random.default_rng(1)
    tokens, p = rng.integers(1, 100, 300), rng.dirichlet(np.full(3, focus), 300)
    rows = [(i, int(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(tokens, p, strict=True))]
    members = spark.createDataFrame(rows, "doc_id long, tokens long, p array<double>").repartition(4)
    steps = mixing.fit_rates(members, list(weights), weights, "good", most)
    got = {r.doc_id: r.rate for r in members.withColumn("rate", mixing.rate_of(steps, F.col("p"), most)).collect()}
    rate = np.ones(300)
    for g in steps:
        rate = np.clip(rate - p @ np.array(g), 0, most)
    assert len(steps) < mixing.ROUNDS and np.allclose([got[i] for i in range(300)], rate, atol=1e-9)
    total, squares, before = least_squares(tokens, p, weights, most)
    have = tokens @ p
    target = np.array(list(weights.values())) / weights["good"] * have[0]
    reached = (rate * tokens) @ p
    assert ((reached - target) ** 2 / have).sum() <= 1.03 * squares + 1e-4 * before
    assert np.allclose(reached / have.sum(), total / have.sum(), atol=0.02)


def test_mix_repeats_and_drops_rows(spark):
    pairs, kinds = corpus(5, 200)
    table = docs(spark, pairs)
    mixed = mixing.mix(table, label_rows(spark, kinds), {"good": 0.5, "low": 0.4, "toxic": 0.1}, "good", most=3.0)
    assert mixed.columns == table.columns
    count = {}
    for r in mixed.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert max(count.values()) > 1 and min(count.get(i, 0) for i, k in kinds.items() if k == "toxic") == 0


def test_awkward_rows(spark):
    _, kinds = corpus()
    table = docs(spark, awkward())
    got = mixing.mixed(table, label_rows(spark, {1: "good", 2: "low", 3: "good"}), WEIGHTS, "good")
    assert got.count() == len(awkward())
    alone = mixing.mixed(table, label_rows(spark, {1: "low", 2: "low"}), WEIGHTS, "low").collect()
    assert {tuple(r.p) for r in alone} == {(0.0, 1.0, 0.0)}
    none = mixing.mixed(table, spark.createDataFrame([], LABELS), WEIGHTS, "good").collect()
    assert {tuple(r.p) for r in none} == {(1.0, 0.0, 0.0)} and {r.copies for r in none} == {1}
    assert mixing.mix(table.limit(0), label_rows(spark, {1: "good", 2: "low"}), WEIGHTS, "good").count() == 0


@pytest.mark.parametrize(("shares", "weights", "rates"), [
    ((0.985, 0.005, 0.01), (0.98, 0.019, 0.001), (1.0, 1.0, 0.1005)),
    ((0.8, 0.19, 0.01), (0.8, 0.19, 0.001), (1.0, 1.0, 0.1)),
    ((0.96, 0.005, 0.035), (0.9, 0.07, 0.03), (1.0, 1.0, 0.9143)),
    ((0.93, 0.02, 0.05), (0.9, 0.07, 0.03), (1.0, 1.0, 0.62)),
])
def test_rare_domains_reach_their_targets(spark, shares, weights, rates):
    """Sure posteriors: every domain has one rate, its target over what it has."""
    rows = [(int(1e6 * s), [float(i == k) for i in range(3)]) for k, s in enumerate(shares)]
    members = spark.createDataFrame(rows, "tokens long, p array<double>")
    steps = mixing.fit_rates(members, list(WEIGHTS), dict(zip(WEIGHTS, weights, strict=True)), "good", 1.0)
    got = {r.p.index(1.0): r.rate for r in members.withColumn("rate", mixing.rate_of(steps, F.col("p"), 1.0)).collect()}
    assert np.allclose([got[k] for k in range(3)], rates, atol=1e-3)


def test_soft_rare_domains_reach_their_targets(spark):
    """Blurred posteriors with one percent of the tokens in a domain."""
    rng = np.random.default_rng(5)
    kinds = rng.choice(3, 4000, p=[0.79, 0.2, 0.01])
    p = 0.97 * np.eye(3)[kinds] + 0.03 * rng.dirichlet([40, 9, 1], 4000)
    tokens = rng.integers(20, 200, 4000)
    rows = [(int(t), [float(x) for x in q]) for t, q in zip(tokens, p, strict=True)]
    members = spark.createDataFrame(rows, "tokens long, p array<double>").repartition(4)
    weights = {"good": 0.8, "low": 0.1, "toxic": 0.004}
    steps = mixing.fit_rates(members, list(weights), weights, "good", 1.0)
    rate = np.array([(r.rate, r.tokens, *r.p) for r in members.withColumn("rate", mixing.rate_of(steps, F.col("p"), 1.0)).collect()])
    have, reached = rate[:, 1] @ rate[:, 2:], (rate[:, 0] * rate[:, 1]) @ rate[:, 2:]
    target = np.array(list(weights.values())) / 0.8 * have[0]
    assert np.allclose(reached / target, 1, atol=0.01) and len(steps) < mixing.ROUNDS


def test_clashing_columns_are_kept(spark):
    pairs, kinds = corpus(7, 120)
    table = docs(spark, pairs).selectExpr("*", "'a' AS _id", "'b' AS _copies", "'c' AS _copy", "'d' AS _p", "1 AS tokens", "'e' AS rate")
    got = mixing.mix(table, label_rows(spark, kinds), WEIGHTS, "good", most=2.0)
    assert got.columns == table.columns
    assert {tuple(r)[-6:] for r in got.collect()} == {("a", "b", "c", "d", 1, "e")}


@pytest.mark.parametrize("share", [0.12, 0.01])
def test_toxic_documents_do_not_leave_the_pipeline(spark, share):
    """The pipeline's mixing stage: confidently toxic rows go and good rows stay, rare or not."""
    import corpus_pipeline

    rng = random.Random(9)
    n, toxic = 2000, round(2000 * share)
    pairs = [(i, prose(rng, rng.randint(20, 120), 300) + (" idiot scum trash moron" if i < toxic else "")) for i in range(n)]
    folder = tempfile.mkdtemp(prefix="run-")
    label_rows(spark, {i: "toxic" if i < toxic else "good" for i in range(n)}).write.parquet(f"{folder}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.mixing_weights(spark, docs(spark, pairs), folder).collect()}
    assert not kept & set(range(toxic)) and len(kept) >= 0.99 * (n - toxic)
