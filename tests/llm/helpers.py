"""Small tables with awkward rows."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, row string, rows string, p string, h1 string, node string, fp string, _row string"


def docs(spark, pairs):
    """(doc_id, text) pairs as documents with further columns whose names clash with inner ones."""
    rows = [(i, t, "en", "s", len(t or ""), "x", "y", "z", "p", "h", "n", "f", "r") for i, t in pairs]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n, words=400):
    vocabulary = [f"w{k}" for k in range(words)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def awkward(seed=1, n=30):
    """Ordinary texts plus NULL, empty, blank, one very long, copies, repeated rows and repeated ids."""
    rng = random.Random(seed)
    pairs = [(i, prose(rng, rng.randint(1, 80))) for i in range(n)]
    same = prose(rng, 60)
    pairs += [(100 + i, same) for i in range(40)]
    pairs += [(200, None), (201, ""), (202, " \n\t "), (203, prose(rng, 20000)), (204, "Ärger über\u00a0Öl\r\nzwei"), (205, "a" * 50000)]
    pairs += [pairs[3], pairs[3], (7, "another text under a used id"), (None, "no id here"), (None, None)]
    return pairs
