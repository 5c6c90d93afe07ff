"""Ranked lexical search: all items against all documents, shared parts of the items scored once.

1. The documents become a forward index, one row each: its terms, their counts and its length. It is written
   once, and nothing after it reads a text.
2. Sets of terms that items share are mined from the table of items and terms. Min-hashes of a term's items
   put terms together that stand in the same items; the finest cell holds exactly the terms of one set of
   items. An item's terms fall into cells inside cells, and a part is named by a hash of what it holds. So
   equal parts of different items are one node, and the nodes of the four levels (items, two of min-hash
   cells, sets of terms that always come together) form a directed acyclic graph that items share.
3. Items are dealt into blocks of bounded size, similar ones together. For a block each task keeps a table of
   accumulators, one row per node and one column per document at hand: first the scores of single terms,
   then level by level the sums over a node's children, each node once however many items hold it.
4. A task keeps the best documents of each item; these meet in two steps, by item and a part of the key,
   then by item.

NULL and empty texts have no terms: they are never found, and they count in no statistic. Rows with one
item id are one item with the terms of all of them; an item without terms finds nothing. NULL is an item id
like others. Repeated rows of documents and repeated ids are documents of their own, a NULL id comes after
all others of its score. Empty tables give an empty result. Only ids and texts are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import by_value
from pagewright.operators.hotkeys import chunk
from pagewright.sources.storage import stored

BLOCK_COST = 1 << 16  # of the items that are scored together: their terms, and ROOT_COST for each
ROOT_COST = 32
ROWS = 256  # texts taken apart at a time
CELLS = 1 << 20  # accumulators held at a time
HELD = 1 << 18  # candidates held before the worse ones go
PARTS = 32  # of an item's candidates
# letters A-Z lower-cased, other ASCII signs that are no digits or letters blank, on UTF-8 bytes
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def forward_index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, terms, counts) of each row with terms; n is the number of terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (batch.slice(lo, ROWS) for batch in batches for lo in range(0, batch.num_rows, ROWS))
        for batch in pieces:
            found = [Counter((t.as_py() or "").encode().translate(TERMS).split()) for t in batch.column(1)]
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            terms = pa.array([w for f in found for w in f], pa.string())
            counts = pa.array([c for f in found for c in f.values()], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, x) for x in (terms, counts)]
            n = pa.array([f.total() for f in found], pa.int64())
            rows = pa.record_batch([batch.column(0), n, *lists], names=["key", "n", "terms", "counts"])
            yield rows.filter(pc.greater(rows.column("n"), 0))

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"key {kind}, n long, terms array<string>, counts array<int>")


def weights_of(index: DataFrame, wanted: DataFrame, n_docs: int) -> DataFrame:
    """(term, w) of the terms in ``wanted`` that some document holds."""
    df = index.select(F.explode("terms").alias("term")).join(wanted, "term").groupBy("term").agg(F.count("*").alias("df"))
    return df.select("term", F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long").alias("w"))


def sharing_graph(pairs: DataFrame) -> DataFrame:
    """``pairs`` (who, term) with root, a, b and c: the nodes of the four levels that hold the term for this
    item, each named by a hash of all that it holds."""
    who = lambda seed: F.xxhash64("who", F.lit(seed))
    marks = pairs.groupBy("term").agg(
        F.min(who(1)).alias("h1"), F.min(who(2)).alias("h2"),
        F.concat_ws(",", F.count("*"), F.bit_xor(who(3)), F.bit_xor(who(4))).alias("h3"),
    )
    graph = pairs.join(marks, "term")
    held, inner, cells = graph, "term", ["who", "h1", "h2", "h3"]
    for name in ("c", "b", "a", "root"):
        content = F.sha2(F.array_join(F.array_sort(F.collect_set(inner)), " "), 256)
        held = held.groupBy(*cells).agg(content.alias(name))
        graph = graph.join(held, cells)
        inner, cells = name, cells[:-1]
    return graph.drop("h1", "h2", "h3")


def blocks_of(graph: DataFrame, block_cost: int) -> DataFrame:
    """(root, block, place): roots that hold the same nodes stand together, and the blocks, cut from that
    order, cost at most ``block_cost`` and one root more."""
    roots = graph.groupBy("root").agg(F.min("a").alias("near"), F.count_distinct("term").alias("n"))
    costs = chunk(roots.withColumn("cost", F.col("n") + ROOT_COST), [F.lit(0)], ["near", "root"])
    before = costs.running("before", "sum", F.col("cost"), exclusive=True).done()
    dealt = before.withColumn("block", F.floor(F.col("before") / block_cost).cast("long"))
    place = F.row_number().over(Window.partitionBy("block").orderBy("root")) - 1
    return dealt.select("root", "block", place.alias("place"))


class Block:
    """The graph of one block of items as arrays: per level the children of each node, end to end."""

    def __init__(self, rows: list, weights: dict[str, int]) -> None:
        below = {t: k for k, t in enumerate(sorted({r["term"] for r in rows}))}
        self.terms = list(below)
        self.weights = np.array([weights[t] for t in self.terms], np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for child, parent in (("term", "c"), ("c", "b"), ("b", "a"), ("a", "root")):
            edges = sorted({(r[parent], below[r[child]]) for r in rows})
            names = sorted({e[0] for e in edges})
            starts = np.flatnonzero([k == 0 or edges[k][0] != edges[k - 1][0] for k in range(len(edges))])
            self.levels.append((np.array([e[1] for e in edges]), starts))
            below = {name: k for k, name in enumerate(names)}
        self.roots = len(below)
        self.width = max(len(self.terms), max(len(children) for children, _ in self.levels))

    def scores(self, contributions: np.ndarray) -> np.ndarray:
        """Scores of the roots from those of the terms; columns are documents."""
        for children, starts in self.levels:
            contributions = np.add.reduceat(contributions[children], starts, axis=0)
        return contributions


def _best(root: np.ndarray, key: np.ndarray, null: np.ndarray, score: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the ``top`` best of each root, in order, and their ranks from 0."""
    order = np.lexsort((key, null, -score, root))
    root = root[order]
    first = np.flatnonzero(np.append(True, root[1:] != root[:-1])) if len(root) else np.empty(0, np.int64)
    rank = np.arange(len(root)) - np.repeat(first, np.diff(np.append(first, len(root))))
    return order[rank < top], rank[rank < top]


def scan_block(index: DataFrame, block: Block, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(place, key, score): of each task the ``top`` best documents of every root."""
    terms, weights = pa.array(block.terms, pa.string()), block.weights
    step = max(1, CELLS // block.width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.ones(block.roots, np.int64)
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)]
        fresh: list[tuple[np.ndarray, ...]] = []

        def settle() -> None:
            joined = [np.concatenate([h, *(f[k] for f in fresh)]) for k, h in enumerate(held)]
            fresh.clear()
            kept, rank = _best(*joined, top)
            held[:] = [x[kept] for x in joined]
            last = rank == top - 1
            least[held[0][last]] = held[3][last]

        for batch in batches:
            keys = batch.column(0).cast(pa.int64())
            null = keys.is_null().to_numpy(zero_copy_only=False)
            key = keys.fill_null(0).to_numpy()
            n = batch.column(1).to_numpy()
            sizes = pc.list_value_length(batch.column(2)).to_numpy()
            at = pc.index_in(batch.column(2).flatten(), value_set=terms).fill_null(-1).to_numpy()
            known = at >= 0
            at, doc = at[known], np.repeat(np.arange(len(n)), sizes)[known]
            tf = batch.column(3).flatten().to_numpy()[known].astype(np.int64)
            m = 50 + 50 * n * n_docs // n_terms
            share = weights[at] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
            for lo in range(0, len(n), step):
                hi = min(lo + step, len(n))
                cut = slice(*np.searchsorted(doc, (lo, hi)))
                table = np.zeros((len(terms), hi - lo), np.int64)
                table[at[cut], doc[cut] - lo] = share[cut]
                scores = block.scores(table)
                root, column = np.nonzero(scores >= least[:, None])
                fresh.append((root, key[lo + column], null[lo + column], scores[root, column]))
                if sum(len(f[0]) for f in fresh) >= HELD:
                    settle()
        settle()
        yield pa.record_batch(
            [pa.array(held[0].astype(np.int32)), pa.array(held[1], mask=held[2]), pa.array(held[3])], names=["place", "key", "score"]
        )

    return index.mapInArrow(run, "place int, key long, score long")


def search(
    items: DataFrame, docs: DataFrame, top: int = 50, item: str = "item_id", key: str = "doc_id", text: str = "text",
    block_cost: int = BLOCK_COST,
) -> DataFrame:
    """(item, rank, key, score): the ``top`` best rows of ``docs`` for each item, scores above 0 only."""
    index = stored(forward_index(docs, key, text), "forward-index")
    totals = index.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    # who: the item's id as a text that is never NULL
    asked = forward_index(items, item, text).select(F.col("key").alias("item"), F.explode("terms").alias("term"))
    asked = stored(asked.withColumn("who", F.to_json(F.struct("item"))).distinct(), "item-terms")
    weights = stored(weights_of(index, asked.select("term").distinct(), totals["docs"]), "term-weights")
    graph = stored(sharing_graph(asked.select("who", "term").join(weights.select("term"), "term")), "sharing-graph")
    roots = stored(blocks_of(graph, block_cost), "roots")
    nodes = stored(graph.drop("who").distinct().join(weights, "term").join(roots, "root"), "nodes")
    last = roots.agg(F.max("block")).first()[0]
    found = docs.sparkSession.createDataFrame([], "place int, key long, score long, block long")
    for number in range(0 if last is None else last + 1):
        rows = nodes.filter(F.col("block") == number).drop("block", "place").collect()
        if not rows:  # one root beyond the size of a block leaves the next numbers unused
            continue
        block = Block(rows, {r["term"]: r["w"] for r in rows})
        best = scan_block(index, block, totals["docs"], totals["terms"], top)
        found = found.unionByName(stored(best.withColumn("block", F.lit(number).cast("long")), "candidates"))
    better = [F.desc("score"), F.asc_nulls_last("key")]
    part = F.pmod(F.xxhash64("key"), F.lit(PARTS)).alias("part")
    of_part = Window.partitionBy("block", "place", "part").orderBy(*better)
    found = found.withColumn("part", part).withColumn("rank", F.row_number().over(of_part)).filter(F.col("rank") <= top)
    of_root = Window.partitionBy("block", "place").orderBy(*better)
    found = found.withColumn("rank", F.row_number().over(of_root)).filter(F.col("rank") <= top)
    named = graph.select("who", "root").distinct().join(roots, "root").join(asked.select("who", "item").distinct(), "who")
    found = found.join(named, ["block", "place"])
    return found.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


by_value(__name__)
