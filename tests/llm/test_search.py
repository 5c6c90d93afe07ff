import math
import random
import re
from collections import Counter

import pytest

from pagewright.llm import search
from tests.llm.helpers import awkward, docs, prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(TERM.findall((text or "").translate(AZ)))


def plain_search(items, pairs, top=50):
    found = [(k, terms(t)) for k, t in pairs]
    found = [(k, c) for k, c in found if c]
    n_docs, n_terms = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    rows = []
    for i, wanted in asked.items():
        scores = []
        for key, c in found:
            m, score = 50 + 50 * c.total() * n_docs // n_terms, 0
            for t in wanted:
                if c[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        rows += [(i, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return rows


def item_rows(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, root string, score int")


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("block_cost", [search.BLOCK_COST, 100])
def test_search_equals_brute_force(spark, block_cost):
    rng = random.Random(8)
    pairs = awkward() + [(1000 + i, prose(rng, rng.randint(1, 200), 300)) for i in range(300)]
    shared = [prose(rng, 12, 300) for _ in range(4)]
    items = [(i, f"{rng.choice(shared)}, {rng.choice(shared)}! {prose(rng, 5, 300).upper()}") for i in range(25)]
    items += [(25, items[3][1]), (26, None), (27, ""), (28, "?!"), (29, "unknownword"), (30, "W1 w1 w2"), (30, "w3"), (None, "w5 w6"), (31, "w7")]
    got = search.search(item_rows(spark, items), docs(spark, pairs), block_cost=block_cost)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert in_order(got.collect()) == in_order(plain_search(items, pairs))


def test_ties_go_to_the_smallest_id(spark):
    pairs = [(i, "alpha beta") for i in range(200, 0, -1)] + [(500 + i, "gamma delta") for i in range(900)]
    got = search.search(item_rows(spark, [(1, "beta")]), docs(spark, pairs).repartition(7), top=20).orderBy("rank").collect()
    assert [(r["rank"], r.doc_id) for r in got] == [(i, i) for i in range(1, 21)]


def test_items_share_nodes(spark):
    """Two halves that always come together are one node each, however many items hold them."""
    left, right = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    sets = {f"x{i}": left for i in range(5)} | {f"y{i}": right for i in range(5)} | {f"z{i}": left + right for i in range(5)}
    pairs = spark.createDataFrame([(k, t) for k, ts in sets.items() for t in ts], "who string, term string")
    graph = search.sharing_graph(pairs)
    counts = {name: graph.select(name).distinct().count() for name in ("root", "c")}
    assert counts == {"root": 3, "c": 2}
    assert graph.count() == pairs.count()


def test_empty_tables(spark):
    some, none = docs(spark, [(1, "alpha")]), docs(spark, [])
    items = item_rows(spark, [(1, "alpha")])
    assert search.search(items, none).count() == 0
    assert search.search(items.limit(0), some).count() == 0
    assert search.search(items, some).count() == 1
