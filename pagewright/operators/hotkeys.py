"""Running values per group that survive a group of any size.

``Window.partitionBy(key)`` puts a whole group into one task, which is wrong when one product or one run
holds a third of the table. Here rows are range-partitioned on (group, order), so that a group is cut
into ordered chunks of about equal size; a running value is then the value inside the chunk, combined
with one number per earlier chunk of the group. There is one plan for groups of all sizes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.sources.storage import ensure_checkpoint_dir, stored

_GROUP, _CHUNK = "_group", "_chunk"
_FOLDS = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class Chunks:
    """Rows with their group as one value and a chunk number that follows row order."""

    rows: DataFrame
    order: tuple[str, ...]

    def with_column(self, name: str, value: Column) -> Chunks:
        return Chunks(self.rows.withColumn(name, value), self.order)

    def running(self, name: str, kind: str, value: Column, exclusive: bool = False) -> Chunks:
        """Add ``name``: sum, max, min or last of ``value`` over the group's rows up to this one, this one
        included unless ``exclusive`` (before the first value NULL, for sums 0). NULLs count for none."""
        fold = _FOLDS.get(kind)
        last = -1 if exclusive else Window.currentRow
        in_order = [F.col(c).asc_nulls_last() for c in self.order]
        at = F.struct(*[x for c in self.order for x in (F.col(c).isNull(), F.col(c))])
        if kind == "last":
            fold = lambda v: F.last(v, ignorenulls=True)
        frame = Window.partitionBy(_GROUP, _CHUNK).orderBy(*in_order)
        inside = fold(value).over(frame.rowsBetween(Window.unboundedPreceding, last))
        # one row per group and chunk: as many as there are groups, and one more per chunk boundary
        of_chunk = F.max_by(value, F.when(value.isNotNull(), at)) if kind == "last" else fold(value)
        per_chunk = self.rows.groupBy(_GROUP, _CHUNK).agg(of_chunk.alias("_chunk_value"))
        earlier = Window.partitionBy(_GROUP).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carried = per_chunk.select(_GROUP, _CHUNK, fold("_chunk_value").over(earlier).alias("_carried"))
        carried = stored(carried.filter(F.col("_carried").isNotNull()), "carried")
        rows = self.rows.withColumn("_own", inside).join(carried, [_GROUP, _CHUNK], "left")
        merged = {
            "sum": F.coalesce(F.col("_carried"), F.lit(0)) + F.coalesce(F.col("_own"), F.lit(0)),
            "max": F.greatest("_carried", "_own"),
            "min": F.least("_carried", "_own"),
            "last": F.coalesce("_own", "_carried"),
        }[kind]
        return Chunks(rows.withColumn(name, merged).drop("_carried", "_own"), self.order)

    def numbered(self, name: str) -> Chunks:
        """Add ``name``: 1, 2, 3, ... within the group."""
        return self.running(name, "sum", F.lit(1).cast("bigint"))

    def done(self) -> DataFrame:
        return self.rows.drop(_GROUP, _CHUNK)


def group_of(keys) -> Column:
    """The keys as one text that is never NULL, so that it can be joined on."""
    return F.to_json(F.struct(*keys)).alias(_GROUP)


def chunk(rows: DataFrame, keys, order) -> Chunks:
    """Prepare running values per group.

    ``order`` must order the rows of a group completely. The rows are checkpointed, because the chunk
    is the partition a row landed in and a lost executor must not be able to change it.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    spread = [F.col(_GROUP), *[F.col(c).asc_nulls_last() for c in order]]
    ranged = rows.withColumn(_GROUP, group_of(keys)).repartitionByRange(*spread)
    return Chunks(ranged.withColumn(_CHUNK, F.spark_partition_id()).checkpoint(), tuple(order))


def number_rows(rows: DataFrame, order, name: str, start: int = 1) -> DataFrame:
    """``start``, ``start`` + 1, ... over the whole table by ``order``: rows are range-partitioned and
    numbered inside each partition, then shifted by the sizes of the partitions before (one small row
    each)."""
    ensure_checkpoint_dir(rows.sparkSession)
    ranged = rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    fixed = ranged.withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_at", 33)
    sizes = fixed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row per partition of the exchange above, so this window is bounded by the partition count
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    numbered = fixed.withColumn("_part", part).join(F.broadcast(shifts), "_part")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn(name, (F.col("_shift") + inside + start).cast("bigint")).drop("_at", "_part", "_shift")
