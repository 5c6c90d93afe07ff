"""Benchmark decontamination by latent semantic retrieval.

1. Statistics: in how many passages (runs of ``WINDOW`` words) of all documents each hashed term occurs.
2. Index: the TF-IDF matrix of the benchmark's passages is factored by a randomised SVD whose products
   with the matrix run as Spark jobs; only D x L matrices of fixed size reach the driver.
3. Search: overlapping windows of every document are folded into the latent space, all their words with
   them, so that a cosine depends on nothing but the window and the passage. The passages lie in cells around
   the centres of a k-means; a window is compared with those of its ``PROBES`` nearest cells, and windows
   with a cosine of at least ``cosine`` are candidates. One pass over the documents searches ``BLOCK``
   passages (a stated query set against all rows, in blocks).
4. Check: a candidate counts if the longest common subsequence of words covers ``share`` of the passage
   and, where the column ``answer`` has a value, half of that answer.

Words are runs of ASCII letters and digits and of other letters, with A-Z lower-cased. Items under
``min_words`` words are no evidence of anything and are not searched, unless ``short_items`` is set: then they
are found where their words stand one after the other, exactly. NULL and empty texts match nothing. Repeated
rows and repeated items each give their pair once. A document of any length is searched in blocks.
Without documents or items the result is empty. Further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import by_value
from pagewright.sources.storage import stored

DIMS = 1 << 13  # hashed terms
RANK, EXTRA = 64, 8
WINDOW, STRIDE = 64, 32  # a window is two strides
BLOCK = 1 << 16  # passages of one pass: 64 MB of words and vectors at most, in every task
CELL = 256  # passages of a cell, about
PROBES = 12
WINDOWS = 2048  # searched at a time
CHECKED, MARKS = 128, 4096  # windows whose words are compared at a time, by so many marks
ROUNDING = 1e-4  # of a cosine in a product of matrices
SPAN = 1 << 14  # words of a document that are searched at a time
COUNTED = 256  # passages whose terms are counted at a time
PIECE = 1 << 14  # bytes of a text whose words are hashed at a time
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD).split()


# a word's hash is a polynomial in its bytes, so all words of a text come from one running sum
_BASE = 0x9E3779B97F4A7C15
_TURN = pow(_BASE, -1, 1 << 64)


# a plain table, as a cached function would not travel to the workers as code
_TABLES: dict[int, list[np.ndarray]] = {}


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if n not in _TABLES:
        _TABLES.clear()
        factors = [np.full(n, base, np.uint64) for base in (_BASE, _TURN)]
        for f in factors:
            f[0] = 1
        _TABLES[n] = [np.multiply.accumulate(f) for f in factors]
    return _TABLES[n]


class Words:
    """The words of a text: its cleaned bytes, where each word begins and ends, and the words' terms."""

    def __init__(self, text: str | None) -> None:
        self.data = (text or "").encode().translate(_WORD)
        letters = np.frombuffer(self.data, np.uint8)
        edges = np.flatnonzero(np.diff(letters != 32, prepend=False, append=False))
        self.begins, self.ends = edges[::2], edges[1::2]
        self.terms = np.empty(len(self.begins), np.int64)
        at = 0
        while at < len(self.begins):  # PIECE bytes at a time, more where a word is longer
            low = int(self.begins[at])
            stop = max(at + 1, int(np.searchsorted(self.ends, low + PIECE, "right")))
            high = int(self.ends[stop - 1])
            power, turn = _powers(max(PIECE, 1 << (high - low).bit_length()))
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((letters[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=sums[1:])
            first = self.begins[at:stop] - low
            hashes = (sums[self.ends[at:stop] - low] - sums[first]) * turn[first]
            hashes ^= hashes >> np.uint64(32)
            hashes *= np.uint64(0xD6E8FEB86659FD93)
            hashes ^= hashes >> np.uint64(32)
            self.terms[at:stop] = hashes % np.uint64(DIMS)
            at = stop

    def __len__(self) -> int:
        return len(self.begins)

    def spelled(self, lo: int, hi: int) -> list[bytes]:
        return [self.data[a:b] for a, b in zip(self.begins[lo:hi].tolist(), self.ends[lo:hi].tolist(), strict=True)]


class Terms(dict):
    """Hashed term of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = int(Words(word.decode()).terms[0])
        return found


def term_counts(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Passages that have each term, and the number of passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, n = np.zeros(DIMS, np.int64), 0
        marks = np.zeros((COUNTED, DIMS), bool)  # passage by term
        held: list[np.ndarray] = []

        def count() -> None:
            # the terms of some passages at once
            sizes = np.array([len(h) for h in held])
            marks[np.repeat(np.arange(len(held)), sizes), np.concatenate(held)] = True
            have[:] += marks[: len(held)].sum(axis=0)
            marks[: len(held)] = False

        for batch in batches:
            for value in batch.column(0):
                terms = Words(value.as_py()).terms
                for lo in range(0, len(terms), WINDOW):
                    held.append(terms[lo : lo + WINDOW])
                    n += 1
                    if len(held) == COUNTED:
                        count()
                        held.clear()
        if held:
            count()
        ids = np.flatnonzero(have)
        yield pa.record_batch([pa.array(np.append(ids, -1)), pa.array(np.append(have[ids], n))], names=["term", "n"])

    parts = docs.select(text).mapInArrow(run, "term long, n long")
    # DIMS + 1 rows at most
    found = parts.groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts, total = np.zeros(DIMS, np.int64), 0
    for row in found:
        if row["term"] < 0:
            total = row["n"]
        else:
            counts[row["term"]] = row["n"]
    return counts, total


def item_passages(benchmark: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """(key, part, passage, answer): items of over WINDOW words are cut into half-overlapping passages; the
    part of an item of under ``min_words`` words is -1."""
    answered = "answer" in benchmark.columns
    kind = benchmark.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                words = words_of(batch.column(1)[i].as_py())
                answer = words_of(batch.column(2)[i].as_py()) if answered else []
                if len(words) < min_words:
                    if words:
                        rows.append((batch.column(0)[i].as_py(), -1, b" ".join(words).decode(), b" ".join(answer).decode()))
                    continue
                for part, lo in enumerate(range(0, max(1, len(words) - STRIDE), STRIDE)):
                    passage = words[lo : lo + WINDOW]
                    rows.append((batch.column(0)[i].as_py(), part, b" ".join(passage).decode(), b" ".join(answer).decode()))
            columns = zip(*rows, strict=True) if rows else ((), (), (), ())
            kinds = (batch.schema.field(0).type, pa.int32(), pa.string(), pa.string())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[key, "part", "passage", "answer"])

    chosen = benchmark.select(key, text, *(["answer"] if answered else []))
    return chosen.mapInArrow(run, f"`{key}` {kind}, part int, passage string, answer string")


def _vector(words: list[bytes], terms: Terms, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, tf = np.unique(np.fromiter(map(terms.__getitem__, words), np.int64), return_counts=True)
    weights = tf * idf[ids]
    return ids, weights / (np.linalg.norm(weights) or 1.0)


def randomised_svd(passages: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Right singular vectors (DIMS x at most ``rank``) of the TF-IDF matrix of ``passages``, by random
    projection with one power step. The matrix stays in Spark; sums of fixed size come back."""
    context = passages.sparkSession.sparkContext
    texts = passages.select("passage").rdd

    def product(basis: np.ndarray, gram: bool) -> np.ndarray | None:
        """X'(X basis), or with ``gram`` (X basis)'(X basis)."""
        sent = context.broadcast((basis, idf))

        def add(total, row):
            matrix, weights = sent.value
            ids, x = _vector(words_of(row["passage"]), Terms(), weights)
            y = x @ matrix[ids]
            if total is None:
                total = np.zeros((y.size, y.size) if gram else matrix.shape)
            if gram:
                total += np.outer(y, y)
            else:
                total[ids] += np.outer(x, y)
            return total

        merge = lambda a, b: b if a is None else a if b is None else a + b
        found = texts.treeAggregate(None, add, merge)
        sent.destroy()
        return found

    basis = np.random.default_rng(seed).standard_normal((DIMS, rank + EXTRA))
    for _ in range(2):
        found = product(basis, gram=False)
        if found is None:
            return np.zeros((DIMS, 1))
        basis = np.linalg.qr(found)[0]
    values, turn = np.linalg.eigh(product(basis, gram=True))
    order = np.argsort(-values)[:rank]
    order = order[values[order] > 1e-9 * max(values.max(), 1e-30)]
    return basis @ turn[:, order] if len(order) else np.zeros((DIMS, 1))


def common_length(left: list, right: list) -> int:
    """Length of the longest common subsequence; one machine-word row of bits for ``left``."""
    places: dict = {}
    for i, word in enumerate(left):
        places[word] = places.get(word, 0) | 1 << i
    mask = (1 << len(left)) - 1
    row = mask
    for word in right:
        hit = row & places.get(word, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(left) - row.bit_count()


def cells_of(targets: np.ndarray, rounds: int = 8, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Centres and the cell of each target, by k-means on directions."""
    n = max(1, len(targets) // CELL)
    centres = targets[np.random.default_rng(seed).permutation(len(targets))[:n]]
    for _ in range(rounds if n > 1 else 0):
        cell = (targets @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, targets)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
    return centres, (targets @ centres.T).argmax(axis=1)


def near_pairs(windows: np.ndarray, centres: np.ndarray, bounds: np.ndarray, targets: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(window, target) of the pairs with a cosine of ``cosine`` or more, up to rounding, by window; the targets
    of cell c are bounds[c] to bounds[c + 1]. With no more cells than probes all pairs are compared."""
    if len(centres) > PROBES:
        nearest = np.argpartition(-(windows @ centres.T), PROBES, axis=1)[:, :PROBES]
    else:
        nearest = np.broadcast_to(np.arange(len(centres)), (len(windows), len(centres)))
    order = np.argsort(nearest, axis=None, kind="stable")
    cell, window = nearest.ravel()[order], order // nearest.shape[1]
    ends = np.searchsorted(cell, np.arange(len(centres) + 1))
    found = []
    for c in np.unique(cell):
        rows = window[ends[c] : ends[c + 1]]
        w, t = np.nonzero(windows[rows] @ targets[bounds[c] : bounds[c + 1]].T >= cosine - ROUNDING)
        found.append((rows[w], t + bounds[c]))
    w, t = (np.concatenate([np.empty(0, np.int64), *(x[k] for x in found)]) for k in range(2))
    order = np.argsort(w, kind="stable")
    return w[order], t[order]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """A product of matrices rounds by their shapes, a sum per pair does not."""
    return float(a.astype(np.float64) @ b.astype(np.float64))


def search(
    docs: DataFrame, block: list[tuple], idf: np.ndarray, axes: np.ndarray, key: str, item: tuple[str, pa.DataType, str],
    text: str, cosine: float, share: float,
) -> DataFrame:
    """(key, item, cosine, share, start) of the verified windows of ``docs``, stored; block holds rows (item,
    passage words, answer words, short)."""
    terms = Terms()
    latent = (idf[:, None] * axes).astype(np.float32)
    passages, shorts = [b for b in block if not b[3]], {}
    for owner, words, answer, short in block:
        if short:
            shorts.setdefault(len(words), {}).setdefault(tuple(words), []).append((owner, answer))
    vectors = [_vector(words, terms, idf) for _, words, _, _ in passages]
    targets = np.stack([x @ axes[ids] for ids, x in vectors]) if passages else np.zeros((0, axes.shape[1]))
    targets = (targets / np.maximum(np.linalg.norm(targets, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    centres, cell = cells_of(targets) if passages else (np.zeros((1, axes.shape[1]), np.float32), np.empty(0, int))
    order = np.argsort(cell, kind="stable")
    bounds = np.searchsorted(cell[order], np.arange(len(centres) + 1))
    sorted_passages = [passages[i] for i in order]
    # the passages' words by a few bits of their terms, filled up with one that no text has
    longest = max((len(b[1]) for b in passages), default=1)
    listed = np.full((len(passages), longest), MARKS, np.int32)
    for row, (_, words, _, _) in zip(listed, sorted_passages, strict=True):
        row[: len(words)] = [terms[w] % MARKS for w in words]
    least = np.array([share * len(b[1]) for b in sorted_passages])
    # at most BLOCK passages of WINDOW words and their vectors
    sent = docs.sparkSession.sparkContext.broadcast((latent, centres, bounds, targets[order], sorted_passages, shorts, np.abs(latent).max(axis=1) > 1e-6, listed, least))
    name, arrow_kind, kind = item

    def folded(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First words of the windows, and their vectors, SPAN words at a time."""
        vectors, heavy = sent.value[0], sent.value[6]
        for lo in range(0, len(words), SPAN):
            # a block takes the first window of the next one along
            part = words.terms[lo : lo + SPAN + WINDOW]
            # terms of no passage at all are zero in the latent space
            at = np.flatnonzero(heavy[part])
            # sums of half windows; a window is two of them
            halves = np.zeros((-(-len(part) // STRIDE) + 1, vectors.shape[1]), np.float32)
            if len(at):
                half = at // STRIDE
                begin = np.flatnonzero(np.diff(half, prepend=-1))
                halves[half[begin]] = np.add.reduceat(vectors[part[at]], begin, axis=0)
            starts = np.arange(0, max(1, min(SPAN, len(part) - STRIDE)), STRIDE)
            sums = halves[: len(starts)] + halves[1 : len(starts) + 1]
            yield starts + lo, sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)

    def verified(held: list[tuple]) -> Iterator[tuple]:
        """held: (document, its words, first words, vectors)."""
        _, centres, bounds, aims, items, _, _, listed, least = sent.value
        owner = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
        starts, vectors = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
        w, t = near_pairs(vectors, centres, bounds, aims, cosine)
        there = np.zeros((CHECKED, MARKS + 1), np.uint8)  # window by marks of its words
        edges = np.append(np.flatnonzero(np.diff(w, prepend=-1)), len(w))
        for k in range(0, len(edges) - 1, CHECKED):
            own = edges[k : k + CHECKED + 1]
            places = []
            for row, at in enumerate(w[own[:-1]]):
                _, words = held[owner[at]][:2]
                start = int(starts[at])
                places.append((words, max(0, start - STRIDE), start + WINDOW + STRIDE, start, at))
                there[row, words.terms[places[-1][1] : places[-1][2]] % MARKS] = 1
            rows, aim = np.repeat(np.arange(len(places)), np.diff(own)), t[own[0] : own[-1]]
            # no subsequence can hold words whose marks, or that themselves, the span does not have
            marks = listed[aim]
            marks += (rows * (MARKS + 1)).astype(np.int32)[:, None]
            enough = there.ravel()[marks].sum(axis=1, dtype=np.uint8) >= least[aim]
            there[: len(places)] = 0
            last, have = None, set()
            for row, i in zip(rows[enough].tolist(), aim[enough].tolist(), strict=True):
                words, lo, hi, start, at = places[row]
                if row != last:
                    last, have = row, set(words.spelled(lo, hi))
                if sum(map(have.__contains__, items[i][1])) < least[i]:
                    continue
                near = exact_cosine(vectors[at], aims[i])
                if near < cosine:
                    continue
                item, passage, answer, _ = items[i]
                span = words.spelled(lo, hi)
                covered = common_length(passage, span) / len(passage)
                if covered >= share and 2 * common_length(answer, span) >= len(answer):
                    yield held[owner[at]][0], item, near, covered, start

    def exact(doc, words: list[bytes]) -> Iterator[tuple]:
        for n, wanted in sent.value[5].items():
            seen = set()
            for start in range(len(words) - n + 1):
                run = tuple(words[start : start + n])
                if run in wanted and run not in seen:
                    seen.add(run)
                    span = words[max(0, start - STRIDE) : start + WINDOW + STRIDE]
                    yield from ((doc, item, 1.0, 1.0, start) for item, answer in wanted[run] if 2 * common_length(answer, span) >= len(answer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        any_passage, any_short = bool(sent.value[4]), bool(sent.value[5])
        for batch in batches:
            rows, held, n = [], [], 0
            for doc, value in zip(batch.column(0), batch.column(1), strict=True):
                doc, words = doc.as_py(), Words(value.as_py())
                if any_short:
                    rows += exact(doc, words.spelled(0, len(words)))
                for starts, vectors in folded(words) if any_passage else ():
                    held.append((doc, words, starts, vectors))
                    n += len(starts)
                    if n >= WINDOWS:
                        rows += verified(held)
                        held, n = [], 0
            rows += verified(held) if held else []
            columns = zip(*rows, strict=True) if rows else ((),) * 5
            kinds = (batch.schema.field(0).type, arrow_kind, pa.float64(), pa.float64(), pa.int64())
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[key, name, "cosine", "share", "start"]
            )

    own = docs.schema[key].dataType.simpleString()
    found = docs.select(key, text).mapInArrow(run, f"`{key}` {own}, `{name}` {kind}, cosine double, share double, start long")
    found = stored(found, "leaks")
    sent.destroy()
    return found


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text",
    cosine: float = 0.4, share: float = 0.6, min_words: int = 5, short_items: bool = False,
) -> DataFrame:
    """(doc_id, item_id, cosine, share, start): one row per document and item that it contains, with its
    best window. The documents are read once for their statistics and once for each BLOCK passages."""
    spark = docs.sparkSession
    passages = stored(item_passages(benchmark, item, text, min_words), "passages")
    passages = passages if short_items else passages.filter("part >= 0")
    counts, total = term_counts(docs, text)
    idf = np.log((total + 1) / (counts + 1)) + 0.1
    axes = randomised_svd(passages.filter("part >= 0"), idf)
    from pyspark.sql.pandas.types import to_arrow_type

    kind = benchmark.schema[item].dataType
    column = (item, to_arrow_type(kind), kind.simpleString())
    found, block = spark.createDataFrame([], f"`{key}` {docs.schema[key].dataType.simpleString()}, `{item}` {column[2]}, cosine double, share double, start long"), []

    def searched(block: list) -> DataFrame:
        return search(docs, block, idf, axes, key, column, text, cosine, share)

    # passages come to the driver one partition at a time and leave in blocks of BLOCK
    for row in passages.toLocalIterator():
        block.append((row[item], row["passage"].encode().split(), row["answer"].encode().split(), row["part"] < 0))
        if len(block) == BLOCK:
            found, block = found.unionByName(searched(block)), []
    if block:
        found = found.unionByName(searched(block))
    best = F.max(F.struct("share", "cosine", (-F.col("start")).alias("back"))).alias("best")
    pairs = found.groupBy(key, item).agg(best)
    return pairs.select(
        key, item, F.col("best.cosine").alias("cosine"), F.col("best.share").alias("share"), (-F.col("best.back")).alias("start")
    )


by_value(__name__)
