"""Mergeable aggregates: the state of distinct counts and quantiles as columns of a table.

States are kept per fine group (say, product and day), stored, and merged for any coarser group or period
without another look at the rows. A distinct count is an HLL sketch of 2^``lg_k`` registers (standard error
1.04 / sqrt(2^lg_k): 1.6 % at 12), quantiles are a KLL sketch (error of a rank about 1.65 % at k = 200). Both
have a bounded size whatever they have seen, partial states meet before a shuffle, and whatever the order of
merges, the result is within the bounds (not the same to the last digit, as a sketch that has seen rows one
by one is read out more closely than one that was merged).

NULLs count for no state; a group without values has a state of nothing, whose count is 0 and whose quantiles
are NULL. A NULL key is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K, K = 12, 200
_HLL, _KLL, _ROWS = "_hll", "_kll", "n_rows"


def state_columns(states: DataFrame) -> tuple[list[str], list[str]]:
    """The names of the distinct counts and of the quantiles that a table has states of."""
    ends = lambda end: [c.removesuffix(end) for c in states.columns if c.endswith(end)]
    return ends(_HLL), ends(_KLL)


def sketch_states(
    rows: DataFrame, by, distinct: dict[str, Column] | None = None, quantiles: dict[str, Column] | None = None,
    lg_k: int = LG_K, k: int = K,
) -> DataFrame:
    """``by``, n_rows, and one binary state per measure: name_hll for each of ``distinct``, name_kll for each
    of ``quantiles`` (numbers)."""
    states = [F.count("*").alias(_ROWS)]
    for name, value in (distinct or {}).items():
        states.append(F.hll_sketch_agg(value.cast("string"), F.lit(lg_k)).alias(name + _HLL))
    for name, value in (quantiles or {}).items():
        states.append(F.kll_sketch_agg_double(value.cast("double"), F.lit(k)).alias(name + _KLL))
    return rows.groupBy(*by).agg(*states)


def merge_states(states: DataFrame, by=()) -> DataFrame:
    """The states of coarser groups; without ``by`` that of all rows. States of tables that were made at
    different times can be put together by a union before."""
    counts, ranks = state_columns(states)
    merged = [F.sum(_ROWS).alias(_ROWS)]
    merged += [F.hll_union_agg(c + _HLL).alias(c + _HLL) for c in counts]
    merged += [F.kll_merge_agg_double(c + _KLL).alias(c + _KLL) for c in ranks]
    return states.groupBy(*by).agg(*merged)


def estimates(states: DataFrame, shares=(0.5,)) -> DataFrame:
    """The states read out: name for a distinct count, name_p50 and so on for quantiles; states are dropped."""
    counts, ranks = state_columns(states)
    found = {c: F.coalesce(F.hll_sketch_estimate(c + _HLL), F.lit(0)) for c in counts}
    for c in ranks:
        state = F.col(c + _KLL)
        some = F.kll_sketch_get_n_double(state) > 0
        for share in shares:
            label = f"{c}_p{share * 100:g}".replace(".", "_")
            found[label] = F.when(some, F.kll_sketch_get_quantile_double(state, F.lit(float(share))))
    return states.withColumns(found).drop(*[c + _HLL for c in counts], *[c + _KLL for c in ranks])


def append_states(states: DataFrame, path: str, period: str) -> None:
    """Add states to a stored table that is cut by the column ``period``; periods come once each, and writing
    one again puts the new states in the place of the old ones."""
    writer = states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(period).parquet(path)
