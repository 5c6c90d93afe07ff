import zlib
from collections import Counter, defaultdict

from pagewright.llm import sharding
from tests.llm.helpers import awkward, docs


def test_every_row_gets_a_place(spark):
    pairs = awkward()
    got = sharding.assign(docs(spark, pairs), 5).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(str(i) for i, _ in pairs)
    for r in got:
        text = next(t for i, t in pairs if i == r.doc_id and zlib.crc32((t or "").encode()) == r.text_crc32)
        assert r.size == len((text or "").encode()) + 16
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(5))


def test_balance_and_whole_groups(spark):
    pairs = [(i, f"text {i % 150} " * (1 + i % 7)) for i in range(1500)]
    got = sharding.assign(docs(spark, pairs), 8).collect()
    sizes, rows, homes = Counter(), Counter(), defaultdict(set)
    for r in got:
        sizes[r.shard] += r.size
        rows[r.shard] += 1
        homes[r.text_crc32].add(r.shard)
    assert max(sizes.values()) < 1.1 * min(sizes.values()) and max(rows.values()) < 1.2 * min(rows.values())
    assert all(len(h) == 1 for h in homes.values())


def test_a_group_of_a_third_is_cut(spark):
    pairs = [(i, "the same text again") for i in range(1000)] + [(1000 + i, f"own text number {i}") for i in range(2000)]
    got = sharding.assign(docs(spark, pairs), 8).collect()
    rows = Counter(r.shard for r in got)
    assert len(rows) == 8 and max(rows.values()) < 1.1 * 3000 / 8


def test_documents_keep_their_columns(spark):
    pairs = awkward()
    table = docs(spark, pairs)
    got = sharding.shard_documents(table, 4)
    assert got.columns == [c for c in table.columns if c != "shard"] + ["shard", "slot"]
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted((str(i), str(t)) for i, t in pairs)
    assert sharding.shard_documents(table.limit(0), 4).count() == 0
    assert sharding.assign(table.limit(0), 4).count() == 0


def test_cells_follow_the_groups_and_the_shards():
    assert [sharding.cells_for(n, s) for n, s in ((1, 40), (10**10, 40), (10**10, 10**5), (5, 10**7))] == [256, 9536, 10, 1]


def test_the_placing_rule(spark):
    """Each unit goes to the bin whose remainder has the highest dot product with it; cells do not mix."""
    import random

    import numpy as np

    rng = random.Random(1)
    rows = [(cell, k, rng.randint(1, 90), rng.randint(1, 20), rng.randint(1, 5)) for cell in (0, 1) for k in range(50)]
    table = spark.createDataFrame(rows, "cell int, unit int, bytes long, tokens long, rows long").coalesce(1)
    capacity, weights = {"bytes": 600.0, "tokens": 180.0, "rows": 50.0}, (4.0, 1.0, 1.0)
    got = [r.bin for r in sharding._pack(table.sortWithinPartitions("cell", "unit"), ["cell", "unit"], 3, capacity, weights).collect()]
    want = []
    for cell in (0, 1):
        left = np.ones((3, 3))
        for _, _, *load in rows[cell * 50 : cell * 50 + 50]:
            load = np.array(load) / list(capacity.values())
            want.append(int(np.argmax([sum(w * r * x for w, r, x in zip(weights, b, load, strict=True)) for b in left])))
            left[want[-1]] -= load
    assert got == want
