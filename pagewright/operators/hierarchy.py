"""Counts and ratios on every level of a breadcrumb, per band and in total, from one pass.

A row of the path ``A > B > C`` counts for the levels 0 (all rows), 1 (``A``), 2 (``A > B``) and 3, and on
each of them for its band and for all bands together, by grouping sets over its prefixes. Distinct counts are
those of each group itself, not sums of the groups below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = " > "


def prefixes(path: Column, separator: str = SEPARATOR, depth: int | None = None) -> Column:
    """(level, node) of a path from level 0, the node ``''``, on; NULL and empty paths are on level 0 only.
    Parts are trimmed and empty ones left out; ``depth`` is the last level."""
    parts = F.transform(F.split(F.coalesce(path, F.lit("")), f"\\Q{separator.strip()}\\E"), lambda p: F.trim(p))
    parts = F.filter(parts, lambda p: p != "")
    last = F.size(parts) if depth is None else F.least(F.size(parts), F.lit(depth))
    node = lambda level: F.array_join(F.slice(parts, F.lit(1), level), separator)
    return F.transform(F.sequence(F.lit(0), last), lambda level: F.struct(level.alias("level"), node(level).alias("node")))


def level_rollup(
    rows: DataFrame, path: str, band: str, distinct: dict[str, Column] | None = None, shares: dict[str, Column] | None = None,
    depth: int | None = None, separator: str = SEPARATOR,
) -> DataFrame:
    """level, node, band, all_bands (whether the row is the total over the bands, its band being NULL),
    n_rows, a distinct count for each of ``distinct`` and the share of rows for each condition of ``shares``
    (NULL counts as not met). A NULL band is a band of its own. Distinct values are compared by 64-bit hashes
    twice over; partial groups meet before the shuffle, so the node of all rows is no large group."""
    distinct, shares = distinct or {}, shares or {}
    ident = lambda value: F.when(value.isNotNull(), F.struct(F.xxhash64(value, F.lit(0)), F.xxhash64(value, F.lit(1))))
    marks = [ident(v).alias(f"_d_{name}") for name, v in distinct.items()]
    marks += [F.coalesce(v, F.lit(False)).cast("double").alias(f"_s_{name}") for name, v in shares.items()]
    flat = rows.select(F.explode(prefixes(F.col(path), separator, depth)).alias("at"), F.col(band).alias("band"), *marks)
    flat = flat.select("at.level", "at.node", "band", *[c for c in flat.columns if c[:3] in ("_d_", "_s_")])
    level, node, of_band = F.col("level"), F.col("node"), F.col("band")
    grouped = flat.groupingSets([[level, node, of_band], [level, node]], level, node, of_band)
    return grouped.agg(
        F.grouping("band").cast("boolean").alias("all_bands"), F.count("*").alias("n_rows"),
        *[F.count_distinct(f"_d_{name}").alias(name) for name in distinct], *[F.avg(f"_s_{name}").alias(name) for name in shares],
    )
