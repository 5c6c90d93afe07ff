"""N-gram Jaccard join as a blocked sparse matrix product.

The matrix has a row per distinct set of n-grams and a column per n-gram; rows times rows are the overlaps.

1. Column blocks: tasks over the texts hand on their part of the matrix cut by columns. A column block counts
   its columns; entries of columns with one row go, as no product can use them. What is left, keyed by how
   often the n-gram occurs and then by its hash, is handed on cut by rows.
2. Row blocks put the rows together. A row of n n-grams needs ceil(s n) in common with any partner, so rows
   with fewer kept entries go, and of the others only the rarest k - ceil(s n) + 1 of k entries can be the
   first column that a pair has in common: the bound that keeps frequent columns out of the product.
3. The product runs over these columns. A column splits into classes of sizes that can meet; columns with the
   same members are one. Every member is multiplied with one member of its column, in large columns with a
   few more, and rows that are linked need no further product among themselves. The pairs that are then still open are
   multiplied block by block of members, so that no column has to fit in one task: a task accumulates the
   overlaps of the rows' rare parts and discards pairs that cannot reach the bound of their sizes any more.
   Those that are left, unless the task has linked their rows already, are multiplied in full by the same task,
   which hands on links and no pairs.
4. Connected components of all links.

Documents with equal sets are one row of the matrix and linked. NULL and empty texts have no n-grams and no
links. Repeated rows and ids are members like others; a NULL id names a class only if all its members are
NULL. A text of any length is one task's work, its set of n-grams in memory. An empty table gives an empty
result. Only the id and the text are read. N-grams are told apart by 64-bit hashes, sets by 128-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import LOWER, by_value
from pagewright.llm.simhash import components
from pagewright.sources.storage import stored

BLOCK_ENTRIES = 1 << 22  # of the matrix in one column or row block, about
PIECE_ENTRIES = 1 << 20  # handed on at a time
MEMBERS = 256  # of a column in one block of the product
LARGE = 4096  # members of a column that get further rounds
ROUNDS, PICKS = 4, 8  # products of a column's members with one of them, and with a few in further rounds
PARTNERS = 4  # picked members that a row is multiplied with in a round, whatever the number of its columns
_ODD = np.random.default_rng(23).integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64((1 << 57) - 1)
LONGS = "array<long>"


def ngrams(text: str | None, size: int) -> np.ndarray:
    """The distinct n-grams of ``size`` words as sorted hashes; of a shorter text all its words as one."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    each = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):  # a polynomial in the word hashes, mixed again after each word
        out = (out ^ each[k : len(each) - size + 1 + k]) * _ODD[k % 8]
        out ^= out >> np.uint64(32)
    return np.unique(out)


def _names(grams: np.ndarray) -> tuple[int, int]:
    data = grams.tobytes()
    return tuple(xxhash.xxh64_intdigest(data, seed) - (1 << 63) for seed in (1, 2))


def named_sets(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, n, t1, t2) per row: how many n-grams there are and the name of their set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in batch.column(1):
                grams = ngrams(t.as_py(), size)
                found.append((len(grams), *_names(grams)))
            columns = [pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ((), (), ()))]
            yield pa.record_batch([batch.column(0), *columns], names=["key", "n", "t1", "t2"])

    return docs.select(key, text).mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, n long, t1 long, t2 long")


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))


def _cut(block: np.ndarray, owner: np.ndarray, t1: np.ndarray, t2: np.ndarray, n: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """One row per block: the matrix rows that have entries in it (t1, t2, n), the number of entries of
    each, and the entries. ``owner`` is the matrix row of an entry, in rising order."""
    order = np.argsort(block, kind="stable")  # the entries of a row stand together
    block, owner, values = block[order], owner[order], values[order]
    fresh = np.flatnonzero(np.append(len(block) > 0, (block[1:] != block[:-1]) | (owner[1:] != owner[:-1])))
    counts = np.diff(np.append(fresh, len(block)))
    rows, of = owner[fresh], block[fresh]
    first = np.flatnonzero(np.append(len(of) > 0, of[1:] != of[:-1]))
    ends = np.append(first, len(of))
    entry_ends = np.append(fresh[first], len(block))
    return pa.record_batch(
        [pa.array(of[first].astype(np.int64)), _lists(ends, t1[rows]), _lists(ends, t2[rows]), _lists(ends, n[rows]),
         _lists(ends, counts.astype(np.int64)), _lists(entry_ends, values)],
        names=["block", "t1", "t2", "n", "counts", "entries"],
    )


PARTS = f"block long, t1 {LONGS}, t2 {LONGS}, n {LONGS}, counts {LONGS}, entries {LONGS}"


def _gathered(batches: Iterator[pa.RecordBatch], own_rows: bool) -> tuple[np.ndarray, ...]:
    """(t1, t2, n, owner, entries) of all parts. With ``own_rows`` copies of a row in one block, which come
    from different tasks over the texts, count once; else parts of a row are put together."""
    columns: list[list[np.ndarray]] = [[] for _ in range(6)]
    for batch in batches:
        columns[5].append(np.repeat(batch.column("block").to_numpy(), batch.column("t1").value_lengths().to_numpy()))
        for k, name in enumerate(("t1", "t2", "n", "counts", "entries")):
            columns[k].append(batch.column(name).flatten().to_numpy())
    t1, t2, n, counts, entries, block = (np.concatenate([np.empty(0, np.int64), *c]) for c in columns)
    order = np.lexsort((block, t2, t1))
    changes = lambda x: np.append(len(order) > 0, x[order][1:] != x[order][:-1])[: len(order)]
    fresh = changes(t1) | changes(t2)
    row = np.empty(len(order), np.int32)
    row[order] = np.cumsum(fresh) - 1
    firsts = order[fresh]
    owner = np.repeat(row, counts)
    if own_rows:
        keep = np.zeros(len(order), bool)
        keep[order[fresh | changes(block)]] = True
        keep = np.repeat(keep, counts)
        owner, entries = owner[keep], entries[keep]
    return t1[firsts], t2[firsts], n[firsts], owner, entries.view(np.uint64)


def column_parts(docs: DataFrame, text: str, size: int, blocks: int) -> DataFrame:
    """The matrix of the texts cut into column blocks. Of copies met in one task the first is handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        names, grams, n = [], [], 0

        def cut() -> pa.RecordBatch:
            t1, t2 = np.array(names, np.int64).reshape(-1, 2).T
            sizes = np.array([len(g) for g in grams], np.int64)
            values = np.concatenate([np.empty(0, np.uint64), *grams])
            block = (values >> np.uint64(20)) % np.uint64(blocks)
            return _cut(block, np.repeat(np.arange(len(grams), dtype=np.int32), sizes), t1, t2, sizes, values)

        for batch in batches:
            for t in batch.column(0):
                found = ngrams(t.as_py(), size)
                name = _names(found)
                if not len(found) or name in seen:
                    continue
                seen.add(name)
                names.append(name)
                grams.append(found)
                n += len(found)
                if n >= PIECE_ENTRIES:
                    yield cut()
                    names, grams, n = [], [], 0
        yield cut()

    return docs.select(text).mapInArrow(run, PARTS)


def row_parts(parts: DataFrame, blocks: int) -> DataFrame:
    """Column blocks to row blocks: entries of columns with one row are gone, the others are keyed by a
    class of how many rows the column has and then by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t1, t2, n, owner, entries = _gathered(batches, own_rows=True)
        order = np.argsort(entries)
        owner, entries = owner[order], entries[order]
        first = np.flatnonzero(np.append(len(entries) > 0, entries[1:] != entries[:-1]))
        rows = np.diff(np.append(first, len(entries)))
        shared = np.repeat(rows > 1, rows)
        often = np.minimum(63, 3 * np.log2(np.repeat(rows[rows > 1], rows[rows > 1]))).astype(np.uint64)
        keyed, owner = (often << np.uint64(57)) | (entries[shared] & _LOW), owner[shared]
        order = np.argsort(owner, kind="stable")
        owner, keyed = owner[order], keyed[order]
        yield _cut(t1.view(np.uint64)[owner] % np.uint64(blocks), owner, t1, t2, n, keyed)

    return parts.repartition(blocks, "block").mapInArrow(run, PARTS)


def live_rows(parts: DataFrame, blocks: int, percent: int) -> DataFrame:
    """(t1, t2, n, entries, head): the rows that can have a partner, their entries from the rarest on, and
    how many of these can be the first in common with one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t1, t2, n, owner, entries = _gathered(batches, own_rows=False)
        order = np.lexsort((entries, owner))
        owner, entries = owner[order], entries[order]
        kept = np.bincount(owner, minlength=len(n)).astype(np.int64)
        head = kept - (n * percent + 99) // 100 + 1
        live = head > 0
        ends = np.cumsum(np.append(0, kept[live]))
        yield pa.record_batch(
            [pa.array(t1[live]), pa.array(t2[live]), pa.array(n[live]), _lists(ends, entries[np.repeat(live, kept)]), pa.array(head[live])],
            names=["t1", "t2", "n", "entries", "head"],
        )

    return parts.repartition(blocks, "block").mapInArrow(run, f"t1 long, t2 long, n long, entries {LONGS}, head long")


def shared_columns(rows: DataFrame, percent: int) -> DataFrame:
    """(column, node, n, home) of the columns to multiply: a row stands in the class of its size and, as a
    guest, in the next one, and pairs of two guests meet in the class below. Of columns with the same
    members one is left."""
    width = float(np.log(101 / percent))  # a little more than the ratio of sizes that can meet
    sized = rows.withColumn("class", F.floor(F.log("n") / width))
    at = sized.select("node", "n", "class", F.explode(F.slice("entries", F.lit(1), F.col("head").cast("int"))).alias("entry"))
    stands = F.explode(F.array(*[F.struct((F.col("class") + k).alias("class"), F.lit(k == 0).alias("home")) for k in (0, 1)]))
    at = at.withColumn("stands", stands).select("entry", "stands.*", "node", "n")
    mark = lambda seed: F.bit_xor(F.xxhash64("node", "home", F.lit(seed)))
    groups = at.groupBy("entry", "class").agg(
        F.count("*").alias("members"), F.count_if("home").alias("homes"), mark(1).alias("m1"), mark(2).alias("m2")
    )
    groups = groups.filter("members > 1 AND homes > 0").groupBy("class", "members", "m1", "m2").agg(F.min("entry").alias("entry"))
    chosen = at.join(groups.select("entry", "class"), ["entry", "class"])
    return chosen.select(F.struct("entry", "class").alias("column"), "node", "n", "home")


def with_labels(columns: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return columns.withColumn("label", F.col("node"))
    return columns.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def still_open(columns: DataFrame) -> DataFrame:
    """The rows of ``columns``, with labels, whose column has members of several labels, one of them at
    home; ``top`` is its most frequent label."""
    # a member weighs as much as its entries, so that a block holds MEMBERS rows or BLOCK_ENTRIES entries
    weight = F.sum(1 + F.col("n") * (MEMBERS / BLOCK_ENTRIES))
    parts = columns.groupBy("column", "label").agg(F.count("*").alias("k"), weight.alias("w"), F.count_if("home").alias("h"))
    mixed = parts.groupBy("column").agg(
        F.max(F.struct("k", "label", "w")).alias("top"), F.sum("k").alias("members"), F.sum("w").alias("weight"), F.sum("h").alias("homes")
    )
    return columns.join(mixed.filter("members > top.k AND homes > 0").drop("homes"), "column")


def verified(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose rows are similar."""
    left = rows.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("entries").alias("ea"))
    right = rows.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("entries").alias("eb"))
    both = stored(pairs.distinct(), "pairs").join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("ea", "eb"))
    return both.filter((100 + percent) * common >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def round_pairs(open_rows: DataFrame, percent: int, seed: int, picks: int = 1) -> DataFrame:
    """(a, b): members of a column and ``picks`` of its members at home, which hashes choose. A row stands in many
    columns, of near copies with almost the same members, so of their picks it takes the first by the hash, which
    tends to be that of its neighbours too, and a few others; what they leave open stays open."""
    order = lambda k: F.struct(F.xxhash64("node", F.lit(seed), F.lit(k)).alias("order"), "node", "n", "label")
    picked = open_rows.filter("home").groupBy("column").agg(F.array(*[F.min(order(k)) for k in range(picks)]).alias("p"))
    pairs = open_rows.join(picked.select("column", F.explode("p").alias("p")), "column").filter("label <> p.label")
    pairs = pairs.filter(100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n"))
    first = F.min_by("p.node", F.struct("p.order", "p.node"))
    others = [F.min_by("p.node", F.struct(F.xxhash64("p.node", F.lit(seed), F.lit(-k)), "p.node")) for k in range(1, PARTNERS)]
    taken = pairs.groupBy("node").agg(F.array_distinct(F.array(first, *others)).alias("with")).select("node", F.explode("with").alias("with"))
    return taken.select(F.least("node", "with").alias("a"), F.greatest("node", "with").alias("b"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The product of two blocks of rows: how many entries each row has in common with each other, and the
    smallest of them (0 without any)."""
    values, at = np.unique(np.concatenate(right), return_inverse=True)
    owner = np.repeat(np.arange(len(right)), [len(r) for r in right])[np.argsort(at, kind="stable")]
    counts = np.bincount(at, minlength=len(values))
    begins = np.cumsum(counts) - counts
    common, first = np.empty((len(left), len(right)), np.int64), np.zeros((len(left), len(right)), np.int64)
    for i, row in enumerate(left):
        found = np.minimum(np.searchsorted(values, row), len(values) - 1)
        found = np.sort(found[values[found] == row])[::-1]
        n = counts[found]
        places = np.arange(n.sum()) + np.repeat(begins[found] - np.cumsum(n) + n, n)
        common[i] = np.bincount(owner[places], minlength=len(right))
        first[i, owner[places]] = np.repeat(values[found], n)  # the last one stays
    return common, first


def may_link(left: tuple, right: tuple, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of one block can be similar to which of another, and the smallest entry that both heads
    have. A block is (heads, sizes, entries kept).
    Of two rows, an entry of one's head that comes before the end of the other's head is in that head or not
    in the other row at all, so the entries that a row surely has alone are counted; what is left has to
    reach the overlap that the sizes ask for."""
    common, first = overlaps(left[0], right[0])
    sizes = left[1][:, None] + right[1]
    least = (percent * sizes + 99 + percent) // (100 + percent)
    out = common > 0
    for rows, others, shared, turn in ((left, right, common, lambda x: x), (right, left, common.T, np.transpose)):
        ends = np.array([h[-1] for h in others[0]], np.int64).view(np.uint64)
        within = np.stack([np.searchsorted(h.view(np.uint64), ends, "right") for h in rows[0]])
        out &= turn(rows[2][:, None] - (within - shared)) >= least
    return out, first


def spanning(left: np.ndarray, right: np.ndarray, labels: np.ndarray, entries: list[np.ndarray], n: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs (left, right) of row numbers are similar, but for those whose rows the pairs before
    them or their ``labels`` connect: at most as many as there are labels, less one."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while x in up:
            up[x] = x = up.get(up[x], up[x])
        return x

    out = np.zeros(len(left), bool)
    for at, (i, j) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        a, b = root(int(labels[i])), root(int(labels[j]))
        if a == b:
            continue
        common = len(np.intersect1d(entries[i], entries[j], assume_unique=True))
        if (100 + percent) * common >= percent * (int(n[i]) + int(n[j])):
            up[a], out[at] = b, True
    return out


def block_links(open_rows: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect what all links between rows of open columns with different labels connect. A
    pair is looked at in the first of the columns that both heads have (columns with the same members are left
    as their first). The members with a column's most frequent label have blocks of their own, which are not
    multiplied among themselves."""
    own, others = F.ceil(F.col("top.w") / MEMBERS), F.ceil((F.col("weight") - F.col("top.w")) / MEMBERS)
    top, dealt = F.col("label") == F.col("top.label"), F.xxhash64("node")
    dealt = open_rows.withColumn("block", F.when(top, others + F.pmod(dealt, own)).otherwise(F.pmod(dealt, others)))
    against = F.explode(F.sequence(F.lit(0).cast("long"), F.when(top, others).otherwise(others + own) - 1))
    dealt = dealt.withColumn("against", against)
    tasks = dealt.select(
        "column", F.least("block", "against").alias("p"), F.greatest("block", "against").alias("q"), "block", "node", "label", "n", "home"
    )

    def run(found: pa.Table) -> pa.Table:
        nodes, labels, n, kept, home, block, p, q = (
            found.column(c).to_numpy() for c in ("node", "label", "n", "kept", "home", "block", "p", "q")
        )
        entries = [e.values.to_numpy() for e in found.column("entries")]
        heads = [e[:h] for e, h in zip(entries, found.column("head").to_pylist(), strict=True)]
        left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
        a = b = np.empty(0, np.int64)
        if len(left) and len(right):
            part = lambda at: ([heads[i] for i in at], n[at], kept[at])
            close, first = may_link(part(left), part(right), percent)
            close &= (labels[left][:, None] != labels[right]) & (home[left][:, None] | home[right])
            close &= first == found.column("column")[0]["entry"].as_py()
            i, j = np.nonzero(close)
            i, j = left[i], right[j]
            linked = spanning(i, j, labels, entries, n, percent)
            a, b = nodes[i[linked]], nodes[j[linked]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    kept = rows.select("node", F.size("entries").cast("long").alias("kept"), "entries", "head")
    return tasks.join(kept, "node").groupBy("column", "p", "q").applyInArrow(run, "a long, b long")


def jaccard_labels(rows: DataFrame, percent: int) -> DataFrame | None:
    """(node, label) of the rows that have a link; None if there are none."""
    columns, labels, last = stored(shared_columns(rows, percent), "columns"), None, False
    for seed in range(ROUNDS + 1):
        open_rows = stored(still_open(with_labels(columns, labels)), "open")
        if open_rows.isEmpty():
            break
        many = open_rows.filter(F.col("members") > LARGE)
        if seed == 0:
            found = verified(round_pairs(open_rows, percent, seed), rows, percent)
        elif seed < ROUNDS and not many.isEmpty():
            found = verified(round_pairs(many, percent, seed, PICKS), rows, percent)
        else:
            found, last = block_links(open_rows, rows, percent), True
        if labels is not None:
            found = found.unionByName(labels.select(F.col("label").alias("a"), F.col("node").alias("b")))
        labels = components(found)
        if last:
            break
    return labels


def jaccard_components(
    docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", block_entries: int = BLOCK_ENTRIES
) -> DataFrame:
    """(key, n_shingles, component_id) per row of ``docs``: documents are linked if the n-grams that both have
    are at least ``percent`` hundredths of those that either has."""
    marked = stored(named_sets(docs, key, text, size), "named-sets")
    sets = marked.filter("n > 0").groupBy("t1", "t2").agg(F.min("key").alias("first"), F.max("n").alias("n"))
    entries = sets.agg(F.sum("n")).first()[0] or 0
    blocks = 1 + entries // block_entries
    parts = row_parts(column_parts(docs, text, size, blocks), blocks)
    live = live_rows(parts, blocks, percent).withColumn("node", F.monotonically_increasing_id())
    rows = stored(live, "live-rows")
    labels = jaccard_labels(rows.select("node", "n", "entries", "head"), percent)
    if labels is None:
        named = sets.withColumn("component", F.col("first"))
    else:
        linked = with_labels(rows.select("node", "t1", "t2"), labels).drop("node")
        firsts = linked.join(sets, ["t1", "t2"]).groupBy("label").agg(F.min("first").alias("component"))
        named = sets.join(linked.join(firsts, "label").drop("label"), ["t1", "t2"], "left")
        named = named.withColumn("component", F.coalesce("component", "first"))
    out = marked.join(named.select("t1", "t2", "component"), ["t1", "t2"], "left")
    own = F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))


by_value(__name__)
