"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Documents with equal texts form a group, and a group is placed whole on the shard where the dot product
of its (bytes, tokens, rows) with what the shard has left is highest, large groups first. A group over
a whole shard is cut into pieces of about a quarter shard, because no placing could balance it.

One such pass is sequential, so it runs at two levels. Groups are dealt by hash into cells, as many as their
number asks for, and each cell packs its own groups into one bin per shard, streaming them in sorted order
with only the bins in memory. Then the bins of all cells and the pieces of large groups, BINS at most, are
packed into the shards in the same way.

A NULL text counts no bytes and no tokens and is a group of its own, apart from the empty text. Ties
go to the lowest shard, rows of a group keep their read order. Repeated rows are rows. An empty table
gives an empty result. Further columns are kept by :func:`shard_documents` (shard and slot, if they are
there, are replaced) and not read by :func:`assign`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import by_value, free_name
from pagewright.sources.storage import stored

HEADER = 16  # bytes that a row takes besides its text
DIMS = ("bytes", "tokens", "rows")
WEIGHTS = (4.0, 1.0, 1.0)  # of a shard's residual bytes, tokens and rows in the dot product
CELLS, SALTS = 256, 64  # at least
UNITS = 1 << 20  # groups of a cell and rows of a numbered part, about
BINS = 1 << 20  # that one task packs, unless there are more shards


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + HEADER).cast("long")


def _pack(rows: DataFrame, unit: list[str], bins: int, capacity: dict[str, float], weights) -> DataFrame:
    """``unit`` columns and ``bin``; ``rows`` are sorted by ``cell`` and size inside each partition."""
    scale = np.array([1.0 / max(capacity[d], 1e-9) for d in DIMS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, left = None, None
        for batch in batches:
            loads = np.stack([batch.column(d).to_numpy(zero_copy_only=False) for d in DIMS], axis=1) * scale
            chosen = np.empty(len(loads), np.int32)
            for k, (at, load) in enumerate(zip(batch.column("cell").to_pylist(), loads, strict=True)):
                if at != cell:
                    cell, left = at, np.ones((bins, len(DIMS)))
                best = int(np.argmax(left @ (load * weights)))
                left[best] -= load
                chosen[k] = best
            yield pa.record_batch([*(batch.column(c) for c in unit), pa.array(chosen)], names=[*unit, "bin"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in unit)
    return rows.select(*dict.fromkeys([*unit, "cell", *DIMS])).mapInArrow(run, f"{kinds}, bin int")


def _largest(capacity: dict[str, float]) -> Column:
    return F.greatest(*[F.col(d) / F.lit(max(capacity[d], 1e-9)) for d in DIMS])


def cells_for(groups: int, shards: int) -> int:
    """Cells of about UNITS groups, CELLS at least, as long as their bins are BINS at most."""
    return max(1, min(max(CELLS, groups // UNITS), BINS // shards))


def place(rows: DataFrame, shards: int, weights=WEIGHTS) -> DataFrame:
    """Stored rows (row, group, size, tokens, ...) with ``shard``."""
    copies = F.count("*")
    groups = rows.groupBy("group", "size", "tokens").agg(copies.alias("rows"))
    groups = groups.withColumns({"bytes": F.col("size") * F.col("rows"), "tokens": F.col("tokens") * F.col("rows")})
    groups = stored(groups.select("group", *DIMS), "groups")
    total = groups.agg(*[F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMS], F.count("*").alias("n")).first().asDict()
    cells = cells_for(total["n"], shards)
    shard = {d: total[d] / shards for d in DIMS}
    heavy_share = _largest(shard)
    # fewer groups than shards can be over a whole shard in each dimension, so this table is bounded
    heavy = groups.filter(heavy_share > 1).select("group", F.ceil(heavy_share * 4).alias("pieces"))
    rows = rows.join(F.broadcast(heavy), "group", "left")
    rows = rows.withColumn("piece", F.coalesce(F.pmod(F.xxhash64("row"), "pieces"), F.lit(-1).cast("long"))).drop("pieces")
    light = groups.filter(heavy_share <= 1)
    light = light.withColumn("cell", F.pmod(F.xxhash64("group"), F.lit(cells)).cast("int"))
    inner = {d: total[d] / shards / cells for d in DIMS}
    dealt = light.repartition(cells, "cell").sortWithinPartitions("cell", _largest(inner).desc(), "group")
    binned = _pack(dealt, ["group", "cell", *DIMS], shards, inner, weights)
    binned = stored(binned, "bins")
    # BINS bins at most and a bounded number of pieces
    sums = [F.sum(d).alias(d) for d in DIMS]
    bins = binned.groupBy("cell", "bin").agg(*sums).withColumn("group", F.lit(None).cast(rows.schema["group"].dataType))
    pieces = rows.filter("piece >= 0").groupBy("group", "piece").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), copies.alias("rows")
    )
    units = bins.select(F.col("cell").alias("old"), F.col("bin").cast("long").alias("part"), "group", *DIMS).unionByName(
        pieces.select(F.lit(-1).alias("old"), F.col("piece").alias("part"), "group", *DIMS)
    )
    units = units.withColumn("cell", F.lit(0)).repartition(1)
    units = units.sortWithinPartitions(_largest(shard).desc(), "old", "part", "group")
    placed = stored(_pack(units, ["old", "part", "group"], shards, shard, weights), "placed")
    of_bins = placed.filter("old >= 0").select(F.col("old").alias("cell"), F.col("part").cast("int").alias("bin"), F.col("bin").alias("shard"))
    of_pieces = placed.filter("old < 0").select("group", F.col("part").alias("piece"), F.col("bin").alias("shard"))
    whole = binned.select("group", "cell", "bin").join(F.broadcast(of_bins), ["cell", "bin"])
    whole = whole.select("group", F.lit(-1).cast("long").alias("piece"), "shard")
    return rows.join(whole.unionByName(of_pieces), ["group", "piece"]).drop("piece")


def number(rows: DataFrame, shards: int) -> DataFrame:
    """Add ``slot`` to stored rows: 0, 1, ... in each shard, numbered in salted parts of about UNITS rows that
    are then strung together."""
    salts = max(SALTS, rows.count() // (shards * UNITS))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    sizes = rows.groupBy("shard", "salt").agg(F.count("*").alias("n"))
    # shards * salts rows, one for UNITS rows or fewer
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from"))
    inside = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("row"))
    numbered = rows.withColumn("at", inside).join(starts, ["shard", "salt"])
    return numbered.withColumn("slot", (F.col("from") + F.col("at") - 1).cast("long")).drop("salt", "at", "from")


def _facts(text: Column) -> dict[str, Column]:
    key = F.struct(F.xxhash64(text).alias("h"), F.crc32(text).alias("c"), text.isNull().alias("null"))
    tokens = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return {"group": key, "size": text_size(text), "tokens": tokens,
            "text_crc32": F.crc32(F.coalesce(text, F.lit("")))}


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", weights=WEIGHTS) -> DataFrame:
    """(key, size, text_crc32, tokens, shard, slot) per row of ``docs``."""
    narrow = docs.select(key, *[c.alias(n) for n, c in _facts(F.col(text)).items()])
    rows = stored(narrow.withColumn("row", F.monotonically_increasing_id()), "sizes")
    placed = stored(place(rows, shards, weights).drop("group"), "shards")
    return number(placed, shards).drop("row")


def shard_documents(docs: DataFrame, shards: int, text: str = "text", weights=WEIGHTS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``. The rows are stored once with a number, which ties each to
    its place whatever repeats."""
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    row = free_name(docs.columns, "_row")
    whole = stored(docs.select(*[F.col(f"`{c}`") for c in kept], F.monotonically_increasing_id().alias(row)), "rows")
    narrow = whole.select(F.col(row).alias("row"), *[c.alias(n) for n, c in _facts(F.col(text)).items()])
    placed = stored(place(stored(narrow, "sizes"), shards, weights).drop("group"), "shards")
    slots = number(placed, shards).select(F.col("row").alias(row), "shard", "slot")
    return whole.join(slots, row).drop(row)


by_value(__name__)
