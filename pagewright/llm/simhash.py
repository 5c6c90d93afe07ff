"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Two walkers go down the trie together, adding up the bits in which their nodes differ, and turn back
once the sum exceeds the budget. To share this work out, the trie is also built on rotated
fingerprints: a budget of r bits over r + 1 blocks leaves one block without any difference, and in the
trie that begins with that block both walkers stay on one node down to its end. Each such node is a
task. A task with very many fingerprints is split into pairs of deeper nodes until it fits
(:func:`split_tasks`), so no group of close copies has to fit in one task. Inside a task a node is a
range of the sorted fingerprints and all node pairs of a level move in one array operation.

Copies collapse to their fingerprint before the join, tasks return a star per local component in place
of all pairs, and the components are put together by alternating large and small stars, the state of
each round stored in the shared folder.

NULL and empty texts have no words and the fingerprint zero, which links like any other. Repeated rows
and repeated ids are members of the same class; a NULL doc_id is a member but never names a class
unless all its members are NULL. An empty table gives an empty result. Further columns are not read, and
:func:`drop_near_duplicates` keeps all of them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import LOWER, by_value, free_name
from pagewright.sources.storage import discard, stored

BITS = 64
STEP = 4  # bits that one split of a large task goes deeper
TASK_ROWS = 4096  # fingerprints above which a task is split
BLOCK = 1 << 14  # shingles hashed at a time


def shingles(words: list[bytes], size: int) -> Iterator[bytes]:
    """All runs of ``size`` words, repeats included; the whole sequence if it is shorter."""
    if not words:
        return iter(())
    if len(words) < size:
        return iter((b" ".join(words),))
    return map(b" ".join, zip(*(islice(words, k, None) for k in range(size)), strict=False))


def shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the shingles, in blocks."""
    runs, digest = shingles(words, size), xxhash.xxh64_intdigest
    while True:
        block = np.fromiter((digest(s, 42) for s in islice(runs, BLOCK)), np.uint64)
        if not len(block):
            return
        yield block


def fingerprint(blocks: Iterator[np.ndarray]) -> int:
    """Bit i is 1 if it is set in over half the hashes; zero without hashes."""
    ones, n = np.zeros(BITS, np.int64), 0
    for block in blocks:
        bits = np.unpackbits(block.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(block)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER).split()


def fingerprints(docs: DataFrame, size: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) per row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(words_of(t.as_py()), size)) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.int64())], names=[key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fp long")


def trie_pairs(fps: np.ndarray, start: np.ndarray, radius: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints at most ``radius`` bits apart. ``start`` holds node pairs at ``depth``
    as columns (a_lo, a_hi, b_lo, b_hi, bits spent); each node is a range of ``fps``, sorted inside."""
    left, right = [], []
    state = start
    for level in range(depth, BITS + 1):
        a_lo, a_hi, b_lo, b_hi, spent = state
        single = (a_hi - a_lo == 1) & (b_hi - b_lo == 1)
        if single.any():  # two leaves: what is left of the budget decides
            a, b, used = a_lo[single], b_lo[single], spent[single]
            tail = fps[a] ^ fps[b]
            if level < BITS:
                tail = tail & np.uint64((1 << (BITS - level)) - 1)
                close = (a != b) & (np.bitwise_count(tail) + used <= radius)
            else:
                close = a != b
            left.append(a[close])
            right.append(b[close])
            a_lo, a_hi, b_lo, b_hi, spent = (x[~single] for x in state)
        if level == BITS or not len(a_lo):
            break
        ones = np.concatenate([[0], np.cumsum((fps >> np.uint64(BITS - 1 - level)) & np.uint64(1))]).astype(np.int64)
        a_mid = a_hi - (ones[a_hi] - ones[a_lo])
        b_mid = b_hi - (ones[b_hi] - ones[b_lo])
        same = a_lo == b_lo
        children = [
            (a_lo, a_mid, b_lo, b_mid, spent),
            (a_mid, a_hi, b_mid, b_hi, spent),
            (a_lo, a_mid, b_mid, b_hi, spent + 1),
            (*(x[~same] for x in (a_mid, a_hi, b_lo, b_mid)), spent[~same] + 1),
        ]
        state = tuple(np.concatenate(c) for c in zip(*children, strict=True))
        a_lo, a_hi, b_lo, b_hi, spent = state
        alive = (a_lo < a_hi) & (b_lo < b_hi) & (spent <= radius)
        alive &= ~((a_lo == b_lo) & (a_hi - a_lo == 1))
        state = tuple(x[alive] for x in state)
    return np.concatenate([*left, np.empty(0, np.int64)]), np.concatenate([*right, np.empty(0, np.int64)])


def star(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the pairs."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def split_tasks(rows: DataFrame, radius: int, task_rows: int) -> DataFrame:
    """Rows (r, depth, p, q, spent, fp) whose tasks have over ``task_rows`` rows go to tasks STEP bits
    deeper, again and again; ``rows`` come back with the size of their task. p and q are the two nodes."""
    task, done = ["r", "depth", "p", "q", "spent"], None
    while True:
        sizes = rows.groupBy(*task).agg(F.count("*").alias("n")).filter("n > 1")
        sized = stored(rows.join(sizes, task), "simhash-tasks")
        ready = sized.filter((F.col("n") <= task_rows) | (F.col("depth") >= BITS))
        done = ready if done is None else done.unionByName(ready)
        heavy = sized.filter((F.col("n") > task_rows) & (F.col("depth") < BITS)).drop("n")
        if heavy.isEmpty():
            return done
        own = F.expr(f"shiftrightunsigned(fp, {BITS - STEP} - depth) & {(1 << STEP) - 1}L")
        # the child of this row, and each child of the other node that the budget still allows
        other = F.explode(F.array(*[F.lit(k).cast("long") for k in range(1 << STEP)])).alias("other")
        base = lambda c: F.shiftleft(F.col(c), STEP)
        deep = heavy.select(*task, "fp", own.alias("own"), other, (F.col("depth") + STEP).alias("down"))
        deep = deep.withColumn("bits", F.col("spent") + F.bit_count(F.col("own").bitwiseXOR(F.col("other"))))
        deep = deep.filter(F.col("bits") <= radius)
        diagonal = F.col("p") == F.col("q")
        mine = F.expr(f"shiftrightunsigned(fp, {BITS} - depth)") == F.col("p")
        p = F.when(diagonal, base("p") + F.least("own", "other")).when(mine, base("p") + F.col("own"))
        q = F.when(diagonal, base("q") + F.greatest("own", "other")).when(mine, base("q") + F.col("other"))
        rows = deep.select(
            "r", F.col("down").alias("depth"), p.otherwise(base("p") + F.col("other")).alias("p"),
            q.otherwise(base("q") + F.col("own")).alias("q"), F.col("bits").alias("spent"), "fp",
        )


def trie_links(nodes: DataFrame, radius: int = 2, task_rows: int = TASK_ROWS) -> DataFrame:
    """Links (a, b) that join exactly the fingerprints of ``nodes`` (distinct, column fp) that a chain of
    steps of at most ``radius`` bits joins."""
    blocks = radius + 1
    ends = [round(k * BITS / blocks) // STEP * STEP for k in range(blocks)] + [BITS]
    turns = F.array(*[
        F.struct(F.lit(k).alias("r"), F.lit(ends[k + 1] - ends[k]).alias("depth"), F.lit(ends[k]).alias("turn"))
        for k in range(blocks)
    ])
    turned = nodes.select("fp", F.explode(turns).alias("t")).select("t.*", "fp")
    turned = turned.withColumn("fp", F.expr("shiftleft(fp, turn) | CASE WHEN turn = 0 THEN 0L ELSE shiftrightunsigned(fp, 64 - turn) END"))
    rows = turned.withColumn("p", F.expr("shiftrightunsigned(fp, 64 - depth)"))
    rows = rows.select("r", "depth", "p", F.col("p").alias("q"), F.lit(0).alias("spent"), "fp")
    tasks = split_tasks(rows, radius, task_rows)

    def solve(chunk: pa.Table) -> pa.RecordBatch:
        r, depth, p, q, spent = (chunk.column(c).to_numpy() for c in ("r", "depth", "p", "q", "spent"))
        fps = chunk.column("fp").to_numpy().view(np.uint64)
        fresh = np.ones(len(r), bool)
        fresh[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in (r, depth, p, q, spent)])
        lo = np.flatnonzero(fresh)
        hi = np.append(lo[1:], len(r))
        left, right = [], []
        for d in np.unique(depth[lo]):
            at = depth[lo] == d
            a_lo, b_hi = lo[at], hi[at]
            off = p[a_lo] != q[a_lo]
            # two nodes: the rows of p come first, as p < q in the sorted order
            node = (fps >> np.uint64(BITS - int(d))) if d < BITS else fps
            firsts = np.concatenate([[0], np.cumsum(node == p.view(np.uint64))])
            mid = a_lo + firsts[b_hi] - firsts[a_lo]
            start = (a_lo, np.where(off, mid, b_hi), np.where(off, mid, a_lo), b_hi, spent[a_lo].astype(np.int64))
            full = (start[0] < start[1]) & (start[2] < start[3])
            found = trie_pairs(fps, tuple(x[full] for x in start), radius, int(d))
            left.append(found[0])
            right.append(found[1])
        label = star(len(fps), np.concatenate(left), np.concatenate(right))
        tied = np.flatnonzero(label != np.arange(len(fps)))
        turn = np.array(ends, np.uint64)[r[tied]]
        back = lambda x: ((x >> turn) | (x << ((np.uint64(BITS) - turn) % np.uint64(BITS)))).view(np.int64)
        a, b = back(fps[label[tied]]), back(fps[tied])
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole tasks at a time: the last task of what was read waits for its remaining rows."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 8 * TASK_ROWS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            keys = [rows.column(c).to_numpy() for c in ("r", "depth", "p", "q", "spent")]
            cut = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in keys]))
            end = int(cut[-1]) + 1 if len(cut) else 0
            if end:
                yield solve(rows.slice(0, end))
            held = rows.slice(end).to_batches()
        if held and sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held).combine_chunks())

    task = ["r", "depth", "p", "q", "spent"]
    # signed order of fp keeps the two halves of the top bit in the wrong order; the shift mends it
    order = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))
    dealt = tasks.repartition(*task).sortWithinPartitions(*task, order)
    return dealt.select(*task, "fp").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every linked node; label is the smallest node reachable. Alternates large and
    small stars until nothing changes; each round is stored."""
    edges = links.filter("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    edges, before = stored(edges.distinct(), "edges"), None
    while True:
        both = edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").filter("m <> v").select(F.col("m").alias("low"), F.col("v").alias("high"))
        large = large.distinct()
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high")
        small = small.select(F.explode(F.array(
            F.struct(F.col("m").alias("low"), F.col("high").alias("high")),
            F.struct(F.col("m").alias("low"), F.col("low").alias("high")),
        )).alias("e")).select("e.*").filter("low <> high")
        last, edges = edges, stored(small.distinct(), "edges")
        discard(last)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("high").alias("node"), F.col("low").alias("label"))


def simhash_components(docs: DataFrame, size: int = 3, radius: int = 2, task_rows: int = TASK_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``."""
    marked = stored(fingerprints(docs, size), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    links = trie_links(nodes.select("fp"), radius, task_rows)
    labels = components(links).withColumnRenamed("node", "fp")
    named = nodes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    firsts = named.groupBy("label").agg(F.min("first").alias("component_id"))
    return marked.join(named.select("fp", "label").join(firsts, "label").drop("label"), "fp")


def drop_near_duplicates(docs: DataFrame, size: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class of ``docs``: that with the smallest key (NULL last), of several the first read."""
    row = free_name(docs.columns, "_row")
    # the number of a row is fixed by writing it down
    whole = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    marked = stored(fingerprints(whole.select(F.col(row).alias("row"), text), size, "row", text), "fingerprints")
    keyed = marked.join(whole.select(F.col(row).alias("row"), F.col(key).alias("id")), "row")
    first = F.min(F.struct(F.col("id").isNull().alias("null"), "id", "row")).alias("first")
    nodes = stored(keyed.groupBy("fp").agg(first), "nodes")
    labels = components(trie_links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    classes = nodes.join(labels, "fp", "left").groupBy(F.coalesce("label", "fp").alias("label")).agg(F.min("first").alias("first"))
    kept = classes.select(F.col("first.row").alias(row))
    return whole.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


by_value(__name__)
