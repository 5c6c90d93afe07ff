import random

import numpy as np
from pyspark.sql import functions as F

from pagewright.llm import decontaminate as dc
from tests.llm.helpers import awkward, docs, prose

BENCH = "item_id long, text string, doc_id string, passage string, share string"


def bench(spark, pairs):
    return spark.createDataFrame([(i, t, "d", "p", "s") for i, t in pairs], BENCH)


def planted(seed=8):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.randint(15, 60), 3000)) for i in range(30)] + [(30, prose(rng, 150, 3000)), (31, "four words at most"), (32, None), (33, "")]
    clean = [(i, prose(rng, rng.randint(20, 600), 3000)) for i in range(120)]
    leaks, want = [], set()
    for k in range(60):
        item = rng.randrange(30)
        words = items[item][1].split()
        if k % 3 == 1:  # paraphrase: a tenth of the words replaced, one dropped, one added
            for at in rng.sample(range(len(words)), len(words) // 10):
                words[at] = "changed"
            words.insert(rng.randrange(len(words)), "extra")
        host = prose(rng, rng.randint(0, 500), 3000).split()
        at = rng.randint(0, len(host))
        text = " ".join([*host[:at], *words, *host[at:]])
        leaks.append((1000 + k, text.upper().replace(" ", "\n") if k % 3 == 2 else text))
        want.add((1000 + k, item))
    long = prose(rng, 30000, 3000).split()
    leaks.append((2000, " ".join(long[:20000] + items[30][1].split()[40:120] + long[20000:])))
    want.add((2000, 30))
    return items, clean, leaks, want


def test_leaks_are_found_and_clean_documents_are_not(spark):
    items, clean, leaks, want = planted()
    got = dc.contaminated(docs(spark, clean + leaks + awkward()), bench(spark, items + items[:3]))
    rows = got.collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert len(rows) == len(found) and found == want
    assert all(0.6 <= r.share <= 1.0001 and r.cosine >= 0.4 for r in rows)


def test_blocks_and_cells_change_nothing(spark, monkeypatch):
    """Not the pairs, and cosines by no more than the rounding of the decomposition's sums."""
    items, _, leaks, want = planted(9)
    found = []
    for block, windows, cell in ((1 << 16, 2048, 256), (7, 3, 256), (1 << 16, 2048, 4)):
        for name, value in (("BLOCK", block), ("WINDOWS", windows), ("CELL", cell)):
            monkeypatch.setattr(dc, name, value)
        rows = dc.contaminated(docs(spark, leaks), bench(spark, items)).collect()
        found.append(sorted((r.doc_id, r.item_id, r.share, r.start, r.cosine) for r in rows))
    assert [r[:4] for r in found[0]] == [r[:4] for r in found[1]] == [r[:4] for r in found[2]] and {r[:2] for r in found[0]} == want
    assert np.ptp([[r[4] for r in rows] for rows in found], axis=0).max() < 1e-6


def test_cells_keep_nine_of_ten_pairs():
    rng = np.random.default_rng(4)
    targets = rng.standard_normal((6000, 64)).astype(np.float32)
    targets /= np.linalg.norm(targets, axis=1, keepdims=True)
    windows = targets[:2000] + 0.1 * rng.standard_normal((2000, 64)).astype(np.float32)
    windows /= np.linalg.norm(windows, axis=1, keepdims=True)
    centres, cell = dc.cells_of(targets)
    order = np.argsort(cell, kind="stable")
    bounds = np.searchsorted(cell[order], np.arange(len(centres) + 1))
    w, t = dc.near_pairs(windows, centres, bounds, targets[order], 0.5 + dc.ROUNDING)
    got, exact = set(zip(w.tolist(), order[t].tolist())), windows @ targets.T
    want = set(zip(*(x.tolist() for x in np.nonzero(exact >= 0.5))))
    assert len(centres) > dc.PROBES and got <= want and len(got) >= 0.9 * len(want) >= 1800
    assert np.isclose(dc.exact_cosine(windows[w[0]], targets[order][t[0]]), exact[w[0], order[t[0]]], atol=1e-5)


def test_short_items(spark):
    items = bench(spark, [(1, "four words at most"), (2, "a b"), (3, "a b"), (4, "?"), (5, "one two three four five")])
    table = docs(spark, [(1, "here are FOUR words, at most!"), (2, "four words or at most"), (3, "x a b a b"), (4, None)])
    assert dc.contaminated(table, items).count() == 0
    got = dc.contaminated(table, items, short_items=True).collect()
    assert sorted((r.doc_id, r.item_id, r.start) for r in got) == [(1, 1, 2), (3, 2, 1), (3, 3, 1)]
    got = dc.contaminated(table, items, min_words=2).collect()
    assert {(1, 1), (3, 2), (3, 3)} <= {(r.doc_id, r.item_id) for r in got}


def test_the_answer_column_decides(spark):
    text = "what is the tallest tower in the town of example where the river bends twice"
    items = bench(spark, [(1, text)]).withColumn("answer", F.lit("the old granary"))
    both = docs(spark, [(1, f"{text} it is the old granary"), (2, f"{text} nobody knows")])
    assert [(r.doc_id, r.item_id) for r in dc.contaminated(both, items).collect()] == [(1, 1)]


def test_empty_tables(spark):
    items, clean, _, _ = planted()
    assert dc.contaminated(docs(spark, []), bench(spark, items)).count() == 0
    assert dc.contaminated(docs(spark, clean), bench(spark, [])).count() == 0
    assert dc.contaminated(docs(spark, clean[:3]), bench(spark, [(1, None)])).count() == 0


def test_subsequences_equal_a_table():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert dc.common_length(a, b) == table[-1, -1]


def test_the_svd_is_close_to_the_exact_one(spark):
    rng = random.Random(3)
    texts = [prose(rng, 30, 12) for _ in range(60)]
    passages = spark.createDataFrame([(t,) for t in texts], "passage string").repartition(5)
    idf, terms = np.ones(dc.DIMS), dc.Terms()
    matrix = np.zeros((len(texts), dc.DIMS))
    for row, text in zip(matrix, texts, strict=True):
        ids, weights = dc._vector(text.encode().split(), terms, idf)
        row[ids] = weights
    axes = dc.randomised_svd(passages, idf, rank=12)
    exact = np.linalg.svd(matrix, compute_uv=False)[:12]
    assert np.allclose(np.linalg.norm(matrix @ axes, axis=0)[: len(exact)], exact, rtol=1e-6)


def test_search_recall_against_brute_force(spark):
    """Of the windows that hold an item word by word, how many become candidates."""
    items, _, leaks, want = planted(10)
    strict = dc.contaminated(docs(spark, leaks), bench(spark, items), cosine=-1.0).collect()
    normal = dc.contaminated(docs(spark, leaks), bench(spark, items)).collect()
    pairs = lambda rows: {(r.doc_id, r.item_id) for r in rows}
    assert len(pairs(normal) & pairs(strict)) >= 0.9 * len(pairs(strict))


def test_items_without_an_answer_are_judged_by_their_share(spark):
    """Items cut short or with words replaced, against an exhaustive check of all spans."""
    rng = random.Random(12)
    items = [(i, prose(rng, rng.randint(15, 59), 3000)) for i in range(40)]
    leaks = []
    for k in range(160):
        words = items[k % 40][1].split()
        if k // 40 == 0:
            words = words[: -(-len(words) * 4 // 5)]
        elif k // 40 == 1:
            words = words[: -(-len(words) * 65 // 100)]
        elif k // 40 == 2:
            for at in rng.sample(range(len(words)), len(words) * 3 // 10):
                words[at] = "changed"
        else:  # the tail alone is another one
            words[-5:] = ["other"] * 5
        host = prose(rng, rng.randint(0, 200), 3000).split()
        at = rng.randint(0, len(host))
        leaks.append((k, " ".join([*host[:at], *words, *host[at:]])))
    want = set()
    for k, text in leaks:
        words = text.encode().split()
        for i, item in items:
            passage = item.encode().split()
            spans = range(0, max(1, len(words) - dc.STRIDE), dc.STRIDE)
            if any(dc.common_length(passage, words[max(0, lo - dc.STRIDE) : lo + dc.WINDOW + dc.STRIDE]) >= 0.6 * len(passage) for lo in spans):
                want.add((k, i))
    assert {(k, k % 40) for k in range(160)} <= want
    for table in (bench(spark, items), bench(spark, items).withColumn("answer", F.lit(None).cast("string"))):
        got = {(r.doc_id, r.item_id) for r in dc.contaminated(docs(spark, leaks), table).collect()}
        assert got <= want and len(got) >= 0.97 * len(want)
