import hashlib
import random
import zlib

import numpy as np
import pytest

from pagewright.llm import queries, runs
from tests.llm.helpers import awkward, docs, prose


def plain_runs(words, least=24, exponent=3):
    """All runs, one period after the other."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((lo, hi - lo, q) for (lo, hi), q in found.items())


def plain_row(key, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(key).encode())
    if key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def random_words(rng):
    kind = rng.randrange(5)
    n = rng.randint(0, 400)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    words = []
    while len(words) < n:
        unit = [rng.randrange(3 if kind < 3 else 50) for _ in range(rng.randint(1, 1 + n // 4))]
        words += (unit * 12)[: rng.randint(1, 6 * len(unit))] if rng.random() < 0.6 else unit
    return words


def test_transform_is_a_convolution():
    rng = np.random.default_rng(1)
    for p, g in runs.PRIMES:
        a, b = (rng.integers(0, p, (32, 3)).astype(np.uint64) for _ in range(2))
        back = runs.inverse_transform(runs.transform(a, p, g), p, g)
        assert (back == a).all()
        got = runs.inverse_transform(runs.transform(a, p, g) * runs.transform(b, p, g) % np.uint64(p), p, g)
        want = [[sum(int(a[i, c]) * int(b[(k - i) % 32, c]) for i in range(32)) % p for c in range(3)] for k in range(32)]
        assert got.tolist() == want


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [random_words(rng) for _ in range(60)]
    bounds = np.cumsum([0, *map(len, texts)])
    found = runs.find_runs(np.array([w for t in texts for w in t], np.int64), bounds)
    want = [(int(bounds[k]) + s, int(bounds[k]) + s + length, q) for k, t in enumerate(texts) for s, length, q in plain_runs(t)]
    assert found == sorted(want, key=lambda r: (r[0], r[2]))


def test_large_codes_need_several_primes():
    codes = np.tile(np.arange(3 << 18, dtype=np.int64)[-5000:], 3)
    assert runs.find_runs(codes, np.array([0, len(codes)])) == [(0, 15000, 5000)]


def test_long_text_of_one_word():
    assert runs.find_runs(np.zeros(1 << 19, np.int64), np.array([0, 1 << 19])) == [(0, 1 << 19, 1)]


def test_too_short_runs_are_refused():
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(30, np.int64), np.array([0, 30]), least=10)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    pairs = awkward() + [(1000 + i, prose(rng, rng.randint(0, 300), 30)) for i in range(150)]
    pairs += [(5000, "la " * 700), (5001, ("a b c d e f g " * 5).strip()), (5002, None)]
    docs(spark, pairs).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_block_convolution(spark, str(tmp_path))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.columns == columns
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((k, *plain_row(k, t)) for k, t in pairs), key=key)


def test_empty_table(spark):
    assert runs.collapse_runs(docs(spark, [])).count() == 0
