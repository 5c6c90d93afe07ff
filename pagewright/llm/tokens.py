"""Unigram token counts by dynamic programming over a trie.

Each task inserts the distinct pre-tokens of its documents in a trie. The forward value of a node, the
best score of any segmentation of the path to it and the number of pieces in that segmentation, depends
on its prefix alone, so it is computed once for all pre-tokens that share it; a pre-token's count is
stored at its last node. A task drops its trie when it has grown to ``NODES`` nodes and goes on with an
empty one: that bounds memory and changes no count. Nothing is shuffled.

The pieces are those of a public SentencePiece file. Its ranks give the scores: the piece of rank r has
log probability -log(r + 1). A letter that no piece covers costs 10 more than the worst piece and counts
as its UTF-8 bytes. Pre-tokens are words between ASCII white space, each with the mark for a preceding
space. Of equal scores the segmentation with fewer pieces wins.

NULL and empty texts have no tokens. A word of any length is one path. Repeated rows are counted alike.
An empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pagewright.llm.common import by_value

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
NODES = 1_000_000
PENALTY = 10.0


def load_pieces(path: str = MODEL) -> dict[str, float]:
    """Piece -> log probability by rank; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return {piece: -math.log(rank + 1) for rank, piece in enumerate(normal, 1)}


class ForwardTrie:
    """Trie of pre-tokens; node 0 is the root. ``counts`` maps a word, as UTF-8 without the space mark,
    to its terminal count and inserts it where it is new."""

    def __init__(self, pieces: dict[str, float], nodes: int = NODES):
        self.pieces, self.nodes = pieces, nodes
        self.unknown = min(pieces.values(), default=0.0) - PENALTY
        ends: dict[str, set[int]] = {}
        for piece in pieces:
            ends.setdefault(piece[-2:], set()).add(len(piece))
        # lengths of the pieces that end in two letters (or are one letter)
        self.lengths = {end: sorted(lengths) for end, lengths in ends.items()}
        self.counts = Terminals(self)
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}  # by node and letter as one number
        self.score, self.used = [0.0], [0]
        self.counts.clear()

    def insert(self, word: str) -> int:
        """The number of pieces of ``word``; nodes that it shares with earlier words are not worked out again."""
        children, score, used, pieces, lengths = self.children, self.score, self.used, self.pieces, self.lengths
        path, node = [0], 0
        for i, letter in enumerate(word, 1):
            key = node << 21 | ord(letter)
            node = children.get(key, 0)
            if not node:
                before = path[-1]
                best, n = score[before] + self.unknown, used[before] + len(letter.encode("utf-8", "surrogatepass"))
                value = pieces.get(letter)
                if value is not None:
                    best, n = score[before] + value, used[before] + 1
                for length in lengths.get(word[i - 2 : i], ()) if i > 1 else ():
                    if length > i:
                        break
                    value = pieces.get(word[i - length : i])
                    if value is not None:
                        start = path[i - length]
                        value += score[start]
                        if value > best or (value == best and used[start] + 1 < n):
                            best, n = value, used[start] + 1
                node = children[key] = len(score)
                score.append(best)
                used.append(n)
            path.append(node)
        return used[node]


class Terminals(dict):
    def __init__(self, trie: ForwardTrie):
        self.trie = trie

    def __missing__(self, word: bytes) -> int:
        if len(self.trie.score) > self.trie.nodes:
            self.trie.clear()
        self[word] = found = self.trie.insert(SPACE + word.decode())
        return found


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """(key, n_pretokens, n_tokens) per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(load_pieces(model))  # the vocabulary: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ForwardTrie(sent.value)
        for batch in batches:
            words_in, tokens_in = [], []
            for value in batch.column(1):
                words = (value.as_py() or "").encode().split()
                words_in.append(len(words))
                tokens_in.append(sum(map(trie.counts.__getitem__, words)))
            columns = [batch.column(0), pa.array(words_in, pa.int64()), pa.array(tokens_in, pa.int64())]
            yield pa.record_batch(columns, names=[key, "n_pretokens", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_pretokens long, n_tokens long")


by_value(__name__)
