"""Stage tables that grow: one row per key, the first by order, kept up to date batch by batch.

A store is a folder of Parquet files, cut into slices by a hash of the key (folders) and within a slice into
buckets by the key (files, sorted by it). A batch is brought to one row per key, shuffled to the buckets and
joined with the stored rows bucket by bucket and slice by slice (a few together where there are many), so the
stored side is read where it lies and never shuffled, only from slices that the batch touches, and a task has one
bucket of few slices in memory. Slices in which a row is new or comes before the stored one are
written anew; all others stay as they are.

The order of a row is its own (say, when it was crawled), so batches may come in any order and merging a
batch again changes nothing. One writer at a time. A merge that fails before its commit leaves the store as
it was; run it again.
"""

from __future__ import annotations

import functools
import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.operators.clean import keep_first, key_digest
from pagewright.sources.io import exists
from pagewright.sources.storage import stored

_KEY, _SLICE = "_key", "_slice"
GROUPS = 16  # of slices, which are joined apart from each other


@dataclass(frozen=True)
class Store:
    """A stored table with one row per ``keys``, the first by ``order``."""

    spark: SparkSession
    path: str
    table: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: str
    slices: int
    buckets: int

    def read(self) -> DataFrame:
        return self.spark.table(self.table).select(*self.schema.names)


def create_store(
    spark: SparkSession, path: str, schema: T.StructType, keys, order: str = "ord", slices: int = 64, buckets: int = 16
) -> Store:
    """An empty store in a new folder. ``slices`` times ``buckets`` files is what a full table has at least,
    so they should follow its expected size; a batch of few keys touches few slices. NULL keys equal each
    other; a NULL order comes after all others. Rows of one key and order count as copies of one row."""
    taken = {f.lower() for f in schema.names} & {_KEY, _SLICE}
    if taken or order not in schema.names or not set(keys) <= set(schema.names):
        raise ValueError(f"the table needs the columns {[*keys, order]} and none named {_KEY} or {_SLICE}")
    spec = {"schema": schema.json(), "keys": list(keys), "order": order, "slices": slices, "buckets": buckets}
    spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.text(f"{path}/spec")
    return open_store(spark, path)


def open_store(spark: SparkSession, path: str) -> Store:
    """The store in the folder ``path``, of this session or an earlier one."""
    spec = json.loads("".join(r["value"] for r in spark.read.text(f"{path}/spec").collect()))
    schema = T.StructType.fromJson(json.loads(spec["schema"]))
    name = "store_" + hashlib.sha256(path.encode()).hexdigest()[:24]
    # the session's catalog knows the folder as a bucketed table; the files are all there is to it
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}, {_KEY} BINARY, {_SLICE} INT) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({_SLICE}) "
            f"CLUSTERED BY ({_KEY}) SORTED BY ({_KEY}) INTO {spec['buckets']} BUCKETS LOCATION '{path}/rows'"
        )
        if exists(spark, f"{path}/rows"):
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return Store(spark, path, name, schema, tuple(spec["keys"]), spec["order"], spec["slices"], spec["buckets"])


def _placed(store: Store, rows: DataFrame) -> DataFrame:
    named = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in store.schema])
    first = keep_first(named, store.keys, store.order).withColumn(_KEY, key_digest(store.keys))
    return first.withColumn(_SLICE, F.pmod(F.xxhash64(_KEY), F.lit(store.slices)).cast("int"))


def _slices_of(rows: DataFrame) -> list[int]:
    return [r[0] for r in rows.select(_SLICE).distinct().collect()]


def _groups(slices) -> list[list[int]]:
    """The slices dealt into GROUPS at most."""
    slices = sorted(slices)
    return [slices[k::GROUPS] for k in range(min(len(slices), GROUPS))]


def _by_group(slices, joined, none: DataFrame) -> DataFrame:
    """What ``joined`` gives for each group of slices, put together; ``none`` where there is no slice."""
    parts = [joined(group) for group in _groups(slices)]
    return functools.reduce(DataFrame.unionByName, parts) if parts else none


def changes_of(store: Store, batch: DataFrame) -> DataFrame:
    """The rows of ``batch`` (placed, one per key) that are new or come before the stored row of their key,
    with ``_new``."""
    earlier = F.col(store.order).isNotNull() & (F.col("_had").isNull() | (F.col(store.order) < F.col("_had")))
    fresh = F.col("_known").isNull()

    def joined(group: list[int]) -> DataFrame:
        old = store.spark.table(store.table).filter(F.col(_SLICE).isin(group))
        old = old.select(_KEY, F.col(store.order).alias("_had"), F.lit(True).alias("_known"))
        both = batch.filter(F.col(_SLICE).isin(group)).join(old, _KEY, "left")
        return both.filter(fresh | earlier).withColumn("_new", fresh).drop("_had", "_known")

    return _by_group(_slices_of(batch), joined, batch.limit(0).withColumn("_new", F.lit(True)))


def merged_rows(store: Store, changes: DataFrame, slices: list[int]) -> DataFrame:
    """All rows of ``slices`` with the changes in place, ready to be written."""
    names = [*store.schema.names, _KEY, _SLICE]
    was, now = F.struct(*names).alias("_was"), F.struct(*names).alias("_now")

    def joined(group: list[int]) -> DataFrame:
        old = store.spark.table(store.table).filter(F.col(_SLICE).isin(group))
        both = old.select(_KEY, was).join(changes.filter(F.col(_SLICE).isin(group)).select(_KEY, now), _KEY, "full")
        return both.select(F.coalesce("_now", "_was").alias("_row")).select(*[F.col(f"_row.{c}") for c in names])

    return _by_group(slices, joined, changes.select(*names).limit(0))


def _dealt(store: Store, rows: DataFrame) -> DataFrame:
    """``rows`` with a bucket of each slice in one task, and as many tasks as buckets and groups of slices."""
    groups = min(store.slices, GROUPS)
    bucket = F.pmod(F.hash(_KEY), F.lit(store.buckets))
    return rows.repartitionById(groups * store.buckets, F.pmod(F.col(_SLICE), F.lit(groups)) * store.buckets + bucket)


def merge(store: Store, rows: DataFrame) -> dict[str, int]:
    """Merge a batch into the store. Returns how many rows are new, how many took the place of a stored row,
    and how many slices were written."""
    batch = stored(_placed(store, rows), "batch", _SLICE)
    changes = stored(changes_of(store, batch), "changes", _SLICE)
    counts = changes.agg(F.count_if("_new").alias("new"), F.count_if(~F.col("_new")).alias("replaced")).first()
    slices = _slices_of(changes)
    if slices:
        first = store.spark.table(store.table).isEmpty()
        out = merged_rows(store, changes, slices) if not first else _dealt(store, changes.drop("_new"))
        out = out.select(*store.schema.names, _KEY, _SLICE)
        out.write.insertInto(store.table, overwrite=True)
        store.spark.catalog.refreshTable(store.table)
    return {"new": counts["new"], "replaced": counts["replaced"], "slices": len(slices)}
