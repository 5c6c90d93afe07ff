import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagewright.llm import simhash
from tests.llm.helpers import awkward, docs, prose


def brute_fingerprint(text, size=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), set()).add(fps[i])
    return {f: min(g) for g in groups.values() for f in g}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_equals_brute_force(spark):
    pairs = awkward()
    got = simhash.simhash_components(docs(spark, pairs)).collect()
    want = {t: brute_fingerprint(t) for _, t in pairs}
    owner = brute_components(list(want.values()), 2)
    first = {}
    for i, t in pairs:
        key = owner[want[t]]
        first[key] = min(x for x in (first.get(key), i) if x is not None) if (first.get(key), i) != (None, None) else None
    assert len(got) == len(pairs)
    expected = sorted((str(i), want[t], str(first[owner[want[t]]])) for i, t in pairs)
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == expected
    assert simhash.simhash_components(docs(spark, pairs).limit(0)).count() == 0


def clustered(seed, n):
    rng = random.Random(seed)
    fps = {0, (1 << 64) - 1}
    while len(fps) < n:
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(rng.choice([0, 0, 3, 12])):
            base ^= 1 << rng.randrange(64)
            if rng.random() < 0.6:
                base ^= 1 << rng.randrange(64)
            fps.add(base)
    return sorted(fps)


@pytest.mark.parametrize(("radius", "task_rows"), [(2, 4096), (2, 3), (3, 4096), (0, 2)])
def test_trie_links_join_what_a_loop_joins(spark, radius, task_rows):
    """With three rows to a task every close group goes through several splits."""
    fps = clustered(radius, 250)
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = simhash.trie_links(table, radius, task_rows)
    labels = {r.node: r.label for r in simhash.components(links).collect()}
    got = {f: labels.get(signed(f), signed(f)) for f in fps}
    want = brute_components(fps, radius)
    parts = lambda d: sorted(sorted(f for f in d if d[f] == v) for v in set(d.values()))
    assert parts(got) == parts(want)


def test_one_dense_group_is_split(spark):
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a, 64)})
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = simhash.trie_links(table, 2, task_rows=200)
    assert links.count() < 64 * len(fps)  # not the pairs: there are over half a million
    labels = {r.label for r in simhash.components(links).collect()}
    assert len(labels) == 1


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000 + i, 1000) for i in range(1, 50)] + [(5, 5)]
    got = {r.node: r.label for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[1000 + i] == 1000 for i in range(1, 50))
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_trie_pairs_are_exact():
    fps = np.array(clustered(9, 200), np.uint64)
    start = tuple(np.array([x]) for x in (0, len(fps), 0, len(fps), 0))
    a, b = simhash.trie_pairs(fps, start, 2, 0)
    got = sorted(tuple(sorted((int(fps[i]), int(fps[j])))) for i, j in zip(a, b, strict=True))
    want = sorted((int(x), int(y)) for x in fps for y in fps if x < y and int(x ^ y).bit_count() <= 2)
    assert got == want


def one_of_each(pairs):
    """The ids that stay, by brute force; None stays only in a class without ids."""
    fps = [brute_fingerprint(t) for _, t in pairs]
    label = brute_components(fps, 2)
    best = {}
    for (key, _), fp in zip(pairs, fps, strict=True):
        old = best.get(label[fp], (True, 0))
        best[label[fp]] = min(old, (key is None, key or 0))
    return sorted(None if null else key for null, key in best.values() if not null) + [None for null, _ in best.values() if null]


def test_one_of_each_group_stays(spark):
    rng = random.Random(4)
    pairs = awkward()
    for i in range(60):
        words = prose(rng, 600, 5000).split()
        pairs.append((1000 + i, " ".join(words)))
        for k in range(3):
            words[rng.randrange(600)] = f"z{k}"
            pairs.append((2000 + 10 * i + k, " ".join(words)))
    table = docs(spark, pairs)
    kept = simhash.drop_near_duplicates(table)
    assert kept.columns == table.columns
    rows = kept.collect()
    assert [r.doc_id for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))] == one_of_each(pairs)
    assert {r["_row"] for r in rows} == {"r"} and len(rows) < len(pairs) - 100
    assert simhash.drop_near_duplicates(table.limit(0)).count() == 0


def test_a_hot_group_of_copies(spark):
    text = F.when(F.col("id") < 1000, "one two three four five six").otherwise(F.concat(F.lit("text "), F.col("id")))
    table = spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text"))
    classes = simhash.simhash_components(table).select("component_id").distinct()
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(table).collect()) == sorted(r[0] for r in classes.collect())
