"""Periodic runs of words, found by block convolution.

A run is a maximal stretch of words with smallest period q that is at least ``exponent`` periods and ``least``
words long. Each period belongs to one dyadic scale: blocks of B words, B a power of two, serve the periods
from B to 2 B - 1 (the smallest B, 8, serves 1 to 15). A run of three periods holds a block that begins at
a multiple of B together with its copy one period later. So for each aligned block the sums of squared
differences to all places of the window that follows are worked out, as sums of squares less twice a
correlation, and a sum of zero is an occurrence at that distance. The correlation is a number-theoretic
transform modulo as many primes as it takes for the product to exceed every possible sum, so zero means
equal. The blocks of many documents are transformed together, in pieces of bounded size. An occurrence at
distance d is a seed: it is extended to both sides as far as words d apart are equal. Seeds inside a stretch
that a smaller period has already given are skipped, because a multiple of a period has the same stretch.

NULL and empty texts have no words and no runs. Repeated rows are each judged on their own. A text of any
length is one task's work, n log(n)^2 for n words, with memory for its words and one piece. An empty table
gives an empty result. Only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import by_value

# primes c * 2^k + 1 below 2^30, each with a generator
PRIMES = ((998244353, 3), (469762049, 3), (754974721, 11), (167772161, 3))
SMALLEST = 8  # words of the shortest block
PIECE = 1 << 17  # numbers that are transformed together
BATCH_WORDS = 1 << 16  # words of short documents that are searched together

Rewrite = Callable[[object, list[bytes]], list[bytes]]


def _mod(x: np.ndarray, p: int) -> np.ndarray:
    q = x // np.uint64(p)
    q *= np.uint64(p)
    return np.subtract(x, q, out=q)


# a plain table, as a cached function would not travel to the workers as code
_ROOTS: dict[tuple, np.ndarray] = {}


def _powers(size: int, p: int, generator: int, inverse: bool) -> np.ndarray:
    """The first size / 2 powers of a root of unity of order ``size``, as a column."""
    found = _ROOTS.get((size, p, inverse))
    if found is not None:
        return found
    root = pow(generator, (p - 1) // size, p)
    root = pow(root, p - 2, p) if inverse else root
    out = np.ones(1, np.uint64)
    while len(out) < size // 2:
        out = np.concatenate([out, _mod(out * np.uint64(pow(root, len(out), p)), p)])
    _ROOTS[size, p, inverse] = out[:, None]
    return out[:, None]


def transform(x: np.ndarray, p: int, generator: int) -> np.ndarray:
    """Number-theoretic transform along the first axis, result in bit-reversed order."""
    size, m = x.shape
    half, big = size // 2, np.uint64(p)
    while half:
        pair = x.reshape(-1, 2, half, m)
        out = np.empty_like(pair)
        total = np.add(pair[:, 0], pair[:, 1], out=out[:, 0])
        np.minimum(total, total - big, out=total)
        diff = pair[:, 0] + (big - pair[:, 1])
        diff *= _powers(2 * half, p, generator, False)
        out[:, 1] = _mod(diff, p)
        x, half = out.reshape(size, m), half // 2
    return x


def inverse_transform(x: np.ndarray, p: int, generator: int) -> np.ndarray:
    """Inverse of :func:`transform`."""
    size, m = x.shape
    half, big = 1, np.uint64(p)
    while half < size:
        pair = x.reshape(-1, 2, half, m)
        out = np.empty_like(pair)
        second = _mod(pair[:, 1] * _powers(2 * half, p, generator, True), p)
        total = np.add(pair[:, 0], second, out=out[:, 0])
        np.minimum(total, total - big, out=total)
        diff = np.add(pair[:, 0], big - second, out=out[:, 1])
        np.minimum(diff, diff - big, out=diff)
        x, half = out.reshape(size, m), 2 * half
    return _mod(x * np.uint64(pow(size, p - 2, p)), p)


def occurrences(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int, near: int, far: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of all copies of the blocks at ``starts`` that begin ``near`` to ``far`` words later
    and end by ``ends``. ``codes`` holds small whole numbers, one per word."""
    top = int(codes.max()) + 1
    size = 1 << (far - near + block - 1).bit_length()
    primes, product = [], 1
    for p, g in PRIMES:
        primes.append((p, g))
        product *= p
        if product > top * top * block:
            break
    squares = np.concatenate([[0], np.cumsum(codes.astype(np.int64) ** 2)])
    places, distances = [], []
    lags = np.arange(far - near + 1)
    step = max(1, PIECE // size)
    for lo in range(0, len(starts), step):
        s, e = starts[lo : lo + step], ends[lo : lo + step]
        own = np.zeros((size, len(s)), np.uint64)
        own[-np.arange(block) % size] = codes[s + np.arange(block)[:, None]]
        after = np.zeros((size, len(s)), np.uint64)
        width = far - near + block
        after[:width] = codes[np.minimum(s + near + np.arange(width)[:, None], len(codes) - 1)]
        first = s + near + lags[:, None]
        fits = first + block <= e
        first = np.minimum(first, len(codes) - block)
        wanted = squares[s + block] - squares[s] + squares[first + block] - squares[first]
        same = fits
        for p, g in primes:
            both = _mod(transform(own, p, g) * transform(after, p, g), p)
            cross = inverse_transform(both, p, g)[: far - near + 1]
            same = same & (_mod(wanted.astype(np.uint64), p) == _mod(cross + cross, p))
        lag, which = np.nonzero(same)
        places.append(s[which])
        distances.append(lag + near)
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *places]), np.concatenate([empty, *distances])


def extent(codes: np.ndarray, place: int, distance: int, begin: int, end: int) -> tuple[int, int]:
    """The stretch around ``place``, inside [begin, end), in which words ``distance`` apart are equal."""
    lo, hi, step = place, place, 64
    while hi + distance < end:
        n = min(step, end - distance - hi)
        off = np.flatnonzero(codes[hi : hi + n] != codes[hi + distance : hi + distance + n])
        if len(off):
            hi += int(off[0])
            break
        hi, step = hi + n, 2 * step
    step = 64
    while lo > begin:
        n = min(step, lo - begin)
        off = np.flatnonzero(codes[lo - n : lo] != codes[lo - n + distance : lo + distance])
        if len(off):
            lo += int(off[-1]) + 1 - n
            break
        lo, step = lo - n, 2 * step
    return lo, hi + distance


def find_runs(codes: np.ndarray, bounds: np.ndarray, least: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs; document i has the words ``bounds[i]`` to ``bounds[i + 1]``. ``least``
    has to be 24 or more and ``exponent`` 3 or more, or blocks could miss a run."""
    if least < 3 * SMALLEST or exponent < 3:
        raise ValueError("runs need at least 24 words and 3 periods")
    sizes = np.diff(bounds)
    found: dict[tuple[int, int], int] = {}
    cover = np.zeros(len(codes) + 1, np.int64)  # where the stretches end that began at or before a word
    block = SMALLEST
    while len(sizes) and max(3 * block, least) <= sizes.max():
        near, far = (1, 2 * block - 1) if block == SMALLEST else (block, 2 * block - 1)
        blocks = np.where(sizes >= max(3 * block, least), (sizes - near) // block, 0)
        owner = np.repeat(np.arange(len(sizes)), blocks)
        starts = bounds[owner] + block * (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
        places, distances = occurrences(codes, starts, bounds[owner + 1], block, near, far)
        seeds = cover[places] < places + distances + block
        places, distances = places[seeds], distances[seeds]
        order = np.lexsort((places, distances))
        values, firsts = np.unique(distances[order], return_index=True)
        fresh = []
        for d, at in zip(values, np.split(places[order], firsts[1:]), strict=False):
            at = at[cover[at] < at + d + block]
            k = 0
            while k < len(at):
                doc = int(np.searchsorted(bounds, at[k], "right")) - 1
                lo, hi = extent(codes, int(at[k]), int(d), int(bounds[doc]), int(bounds[doc + 1]))
                if hi - lo >= max(least, exponent * d):
                    found.setdefault((lo, hi), int(d))
                fresh.append((lo, hi, int(d)))
                k = int(np.searchsorted(at, hi - d - block, "right"))
            # a stretch hides its multiples where a block is at least a period long
            if fresh and (d < block or d == values[-1]):
                for lo, hi, q in fresh:
                    cover[lo] = max(cover[lo], hi)
                np.maximum.accumulate(cover, out=cover)
                fresh = []
        block *= 2
    return [(lo, hi, q) for (lo, hi), q in sorted(found.items(), key=lambda x: (x[0][0], x[1]))]


def _searched(batch: list[tuple[object, list[bytes]]], least: int, exponent: int) -> list[tuple[list[dict], str]]:
    """Runs and collapsed text of each (key, words)."""
    codes, bounds = [], [0]
    for _, words in batch:
        ids: dict[bytes, int] = {}
        codes.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words)))
        bounds.append(bounds[-1] + len(words))
    edges = np.array(bounds)
    runs = find_runs(np.concatenate([*codes, np.empty(0, np.int64)]), edges, least, exponent)
    per: list[list[dict]] = [[] for _ in batch]
    for lo, hi, q in runs:
        doc = int(np.searchsorted(edges, lo, "right")) - 1
        per[doc].append({"start": lo - bounds[doc], "length": hi - lo, "period": q})
    out = []
    for (_, words), own in zip(batch, per, strict=True):
        if own:
            dropped = np.zeros(len(words) + 1, np.int64)
            for r in own:
                dropped[r["start"] + r["period"]] += 1
                dropped[r["start"] + r["length"]] -= 1
            words = [w for w, gone in zip(words, np.cumsum(dropped[:-1]), strict=True) if not gone]
        out.append((own, b" ".join(words).decode()))
    return out


def collapse_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 24, exponent: int = 3, rewrite: Rewrite | None = None
) -> DataFrame:
    """(key, runs, collapsed) per row: the runs (start, length, period) of its words by start and period,
    and the words that no run holds after its first period, joined by spaces. ``rewrite`` gets the key and
    the words and gives the words to search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            found, held, n = [], [], 0
            for name, value in zip(batch.column(0), batch.column(1), strict=True):
                words = (value.as_py() or "").encode().split()
                words = rewrite(name.as_py(), words) if rewrite else words
                held.append((None, words))
                n += len(words)
                if n >= BATCH_WORDS:
                    found += _searched(held, least, exponent)
                    held, n = [], 0
            found += _searched(held, least, exponent)
            yield pa.record_batch(
                [batch.column(0), pa.array([f[0] for f in found], kinds), pa.array([f[1] for f in found], pa.string())],
                names=[key, "runs", "collapsed"],
            )

    kind = docs.schema[key].dataType.simpleString()
    kinds = f"`{key}` {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(key, text).mapInArrow(run, kinds)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, the earliest of equal ones; NULL without runs."""
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(more(r, best), r).otherwise(best))


by_value(__name__)
