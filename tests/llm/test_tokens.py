import random

import pytest

from pagewright.llm import tokens
from tests.llm.helpers import awkward, docs


@pytest.fixture(scope="module")
def unigram():
    """The same model in another library, with byte pieces for what no piece covers."""
    from tokenizers import Tokenizer, models

    pieces = tokens.load_pieces()
    vocabulary = [("<unk>", 0.0), *pieces.items(), *((f"<0x{b:02X}>", 0.0) for b in range(256))]
    return Tokenizer(models.Unigram(vocabulary, 0, True))


def test_counts_equal_another_unigram(spark, unigram):
    rng = random.Random(5)
    letters = "etaoinshrdlu ETAOéüßñ漢字😀012.,-­"
    pairs = awkward()[:-2] + [(1000 + i, "".join(rng.choice(letters) for _ in range(rng.randint(1, 200)))) for i in range(300)]
    got = {}
    for r in tokens.count_tokens(docs(spark, pairs)).collect():
        got.setdefault(r.doc_id, set()).add((r.n_pretokens, r.n_tokens))
    for i, text in pairs:
        if i == 205:  # one word of 50,000 letters: too slow for the other library's lattice
            continue
        words = (text or "").encode().split()
        total = sum(len(unigram.encode(tokens.SPACE + w.decode()).ids) for w in words)
        assert (len(words), total) in got[i], text
    assert {n for n, _ in got[205]} == {1} and got[201] == {(0, 0)} == got[200]


def test_a_small_trie_gives_the_same_counts():
    pieces = {tokens.SPACE: -1.0, "a": -2.0, "b": -2.0, "ab": -2.5, tokens.SPACE + "a": -2.0, "abab": -3.0}
    trie, small = tokens.ForwardTrie(pieces), tokens.ForwardTrie(pieces, nodes=20)
    rng, seen = random.Random(6), set()
    for _ in range(500):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        seen.add(tokens.SPACE + word)
        want = brute(tokens.SPACE + word, pieces, small.unknown)
        assert trie.counts[word.encode()] == small.counts[word.encode()] == want
    assert len(trie.score) - 1 == len({w[:n] for w in seen for n in range(1, len(w) + 1)}) > len(small.score)


def brute(word, pieces, unknown):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[end - 1][0] + unknown, best[end - 1][1] - len(word[end - 1].encode()))]
        options += [(best[s][0] + pieces[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in pieces]
        best.append(max(options))
    return -best[-1][1]


def test_empty_table(spark):
    assert tokens.count_tokens(docs(spark, [])).count() == 0
