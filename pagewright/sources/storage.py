"""Where intermediate tables go: always a folder that the driver and all executors share.

Every scratch table goes with the application at the latest. Loops and pipelines that know when a table has
had its last reader let it go before, by :func:`discard` or at the end of a :func:`scratch_scope`."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_scopes: list[list[str]] = []  # scratch paths of the scopes that are open, the innermost last


def _located(spark: SparkSession, path: str):
    """Hadoop's path and file system; a path without a scheme lies in the default file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return target, files


def _on_local_disk(spark: SparkSession, path: str) -> bool:
    """Whether the path lies on the local disk of one machine out of several."""
    if spark.sparkContext.master.startswith("local"):
        return False
    scheme = path.split("/", 1)[0].rpartition(":")[0]
    return (scheme or _located(spark, path)[1].getUri().getScheme()) == "file"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. It is what ``spark.checkpoint.dir`` names; where that is unset,
    a folder of this application under the SQL warehouse, removed at exit.

    Raises ValueError where that fall-back would be a local disk of a cluster. A folder that is named is
    taken, as only the cluster knows what is mounted everywhere, with a warning if it looks like a local one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work/{context.applicationId}"
            if _on_local_disk(spark, shared):
                raise ValueError(f"set spark.checkpoint.dir to a shared folder; {shared} is a local one")
            path, files = _located(spark, shared)
            files.mkdirs(path)
            files.deleteOnExit(path)
        elif _on_local_disk(spark, shared):
            warnings.warn(f"spark.checkpoint.dir names {shared}, which has to be mounted on every machine", stacklevel=2)
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed at exit."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    target, files = _located(spark, path)
    files.deleteOnExit(target)
    for scope in _scopes[-1:]:
        scope.append(path)
    return path


def stored(rows: DataFrame, name: str, *by: str) -> DataFrame:
    """``rows`` written once as Parquet in the shared folder, in folders ``by`` columns if any are given, and
    read back: a cut in the lineage that a lost executor cannot take away."""
    path = scratch_path(rows.sparkSession, name)
    nothing = [f.name for f in rows.schema if f.dataType == T.NullType()]  # Parquet has no such type
    kept = rows.drop(*nothing)
    (kept.write.partitionBy(*by) if by else kept.write).parquet(path)
    back = rows.sparkSession.read.schema(kept.schema).parquet(path)
    if nothing:
        back = back.withColumns({c: F.lit(None) for c in nothing}).select(*rows.columns)
    back._scratch_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete what :func:`stored` wrote for these tables; nothing may read them, or what is derived from
    them and not stored itself, afterwards."""
    for table in tables:
        path = getattr(table, "_scratch_path", None)
        if path is not None:
            _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    target, files = _located(spark, path)
    files.delete(target, True)
    files.cancelDeleteOnExit(target)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Scratch tables made inside go when the block ends, but for those stored ones that are added to the
    list it gives. After an error all of them stay for a look, until the application ends."""
    kept: list[DataFrame] = []
    _scopes.append([])
    try:
        yield kept
    except BaseException:
        _scopes.pop()
        raise
    paths = _scopes.pop()
    keep = {getattr(t, "_scratch_path", None) for t in kept}
    for path in paths:
        if path in keep:
            for scope in _scopes[-1:]:
                scope.append(path)
        else:
            _delete(spark, path)
