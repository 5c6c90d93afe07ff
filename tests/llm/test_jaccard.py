import random
import re

import numpy as np
import pytest

from pagewright.llm import jaccard
from tests.llm.helpers import awkward, docs, prose

WORD = re.compile("[^\x20\x09-\x0d]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_components(pairs, size=5, percent=80):
    sets = []
    for _, text in pairs:
        words = WORD.findall((text or "").translate(AZ))
        size_ = min(size, len(words)) or 1
        sets.append({tuple(words[i : i + size_]) for i in range(len(words) - size_ + 1)})
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    names = {}
    for i, (key, _) in enumerate(pairs):
        if sets[i] and key is not None:
            names[find(i)] = min(key, names.get(find(i), key))
    return [(key, len(s), names.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(pairs, sets, strict=True))]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


def changed(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    """Texts with near copies of all degrees, and passages that many texts hold."""
    rng = random.Random(seed)
    pairs, passages = awkward(seed), [prose(rng, 60, 5000) for _ in range(3)]
    for i in range(40):
        base = prose(rng, rng.randint(5, 150), 2000)
        if i % 3 == 0:
            base += " " + rng.choice(passages) + " " + rng.choice(passages)
        for k in range(rng.randint(1, 6)):
            pairs.append((1000 + 10 * i + k, changed(rng, base, rng.randint(0, len(base.split()) // 25 + 1)).title()))
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize(("seed", "percent", "block_entries", "members"), [(1, 80, 1 << 22, 256), (2, 80, 3000, 4), (3, 50, 3000, 4)])
def test_components_equal_brute_force(spark, monkeypatch, seed, percent, block_entries, members):
    monkeypatch.setattr(jaccard, "MEMBERS", members)
    pairs = corpus(seed)
    got = jaccard.jaccard_components(docs(spark, pairs), 5, percent, block_entries=block_entries)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert in_order(got.collect()) == in_order(plain_components(pairs, percent=percent))


def test_bounds_are_exact(spark):
    """Similarities of exactly 0.8 and just under it, also where the sizes differ by the whole bound."""
    words = [f"v{i}" for i in range(1004)]
    pairs = [(1, " ".join(words)), (2, " ".join(words[:804])), (3, " ".join(["x", *words[:803]]))]
    pairs += [(10, "p q r s t u v w x y z a b c"), (11, "p q r s t u v w x y z a"), (12, "p q r s t u v w x y z a b")]
    assert in_order(jaccard.jaccard_components(docs(spark, pairs)).collect()) == in_order(plain_components(pairs))


def test_a_large_group_with_its_base_in_the_middle(spark, monkeypatch):
    """Variants at 0.82 to the base and 0.68 to each other; only the base holds them together."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(504)]
    pairs = []
    for k in range(600):
        words, at = list(base), rng.sample(range(10, 490, 10), 10)
        for i in at:
            words[i] = f"c{k}x{i}"
        pairs.append((k if k < 300 else k + 1, " ".join(words)))
    pairs.append((300, " ".join(base)))
    for large in (4096, 100):
        monkeypatch.setattr(jaccard, "LARGE", large)
        got = jaccard.jaccard_components(docs(spark, pairs)).collect()
        assert {r.component_id for r in got} == {0}


def test_overlaps():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.int64)) for _ in range(20)]
    common, first = jaccard.overlaps(rows[:8], rows[8:])
    assert common.tolist() == [[len(set(a) & set(b)) for b in rows[8:]] for a in rows[:8]]
    assert first.tolist() == [[min(set(a.tolist()) & set(b.tolist()), default=0) for b in rows[8:]] for a in rows[:8]]


def test_bounds_discard_no_similar_pair():
    """Rows whose rarest entries are known: what can be discarded is not similar."""
    rng = np.random.default_rng(3)
    discarded = 0
    for _ in range(300):
        base = rng.choice(400, 60, replace=False)
        pair = [np.sort(np.unique(np.concatenate([base, rng.choice(400, rng.integers(0, 14))]))[: rng.integers(50, 75)].astype(np.int64)) for _ in range(2)]
        n = [len(x) + int(rng.integers(0, 9)) for x in pair]  # some entries that no other row has
        blocks = []
        for x, size in zip(pair, n, strict=True):
            head = len(x) - -(-80 * size // 100) + 1
            if head <= 0:
                break
            blocks.append(([x[:head]], np.array([size]), np.array([len(x)])))
        if len(blocks) < 2:
            continue
        common = len(set(pair[0]) & set(pair[1]))
        similar = 180 * common >= 80 * sum(n)
        kept = bool(jaccard.may_link(*blocks, 80)[0][0, 0])
        assert kept or not similar
        discarded += not kept
    assert discarded > 20


def test_empty_table(spark):
    assert jaccard.jaccard_components(docs(spark, [])).count() == 0
    got = jaccard.jaccard_components(docs(spark, [(1, None), (2, ""), (3, "one")])).collect()
    assert in_order(got) == [(1, 0, 1), (2, 0, 2), (3, 1, 3)]


def test_a_block_hands_on_a_spanning_forest():
    base = np.arange(100, dtype=np.uint64)
    entries = [np.delete(base, k) for k in range(30)] + [np.arange(200, 300, dtype=np.uint64)]
    n, labels = np.array([len(e) for e in entries]), np.arange(31)
    i, j = np.nonzero(np.triu(np.ones((31, 31), bool), 1))
    linked = jaccard.spanning(i, j, labels, entries, n, 80)
    assert linked.sum() == 29 and not (j[linked] == 30).any()  # 435 pairs of near copies are similar
    assert jaccard.spanning(i, j, np.append(np.zeros(30, int), 30), entries, n, 80).sum() == 0


def test_a_row_takes_few_partners_in_a_round(spark):
    rows = [((c, 0), node, 100, True, node) for c in range(50) for node in range(20) if (node * 7 + c) % 3]
    schema = "column struct<entry:long,class:long>, node long, n long, home boolean, label long"
    pairs = jaccard.round_pairs(spark.createDataFrame(rows, schema), 80, 0)
    assert 19 <= pairs.distinct().count() <= 20 * jaccard.PARTNERS
