"""Chat formatting after collapsing cumulative snapshots.

A log often holds a conversation once per turn, each snapshot a prefix of the next. The rolling key of
the first n turns is the XOR of 2 x 64 hash bits of (position, role, text) over them, so it can be
summed up in blocks: a conversation of any length is worked on ``BLOCK`` turn numbers at a time, and
only one row per block is strung together. A conversation whose whole key equals the rolling key of a
longer one is dropped by an anti-join; of equal ones the smallest conv_id stays. What is left is
rendered, at most ``PART`` turns to a row.

Turns are ordered by turn number, NULL first; ties by a hash of their content. Each repeated row is a
turn. Rows with a NULL conv_id form one conversation. A NULL role is written as ``unknown`` and a NULL
text as empty; both differ from the real word and the empty text when conversations are compared.
Control marks inside texts are broken up. An empty table gives an empty result. Further columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.sources.storage import stored

BLOCK = 512
PART = 256
START, END = "<|im_start|>", "<|im_end|>"


def _before(columns: dict[str, str], fold) -> dict[str, Column]:
    line = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first())
    line = line.rowsBetween(Window.unboundedPreceding, -1)
    return {new: F.coalesce(fold(old).over(line), F.lit(0)).cast("long") for new, old in columns.items()}


def _same_block(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    other = blocks.withColumnsRenamed({"conv_id": "_conv", "block": "_block"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("block").eqNullSafe(F.col("_block"))
    return rows.join(other, same).drop("_conv", "_block")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, h1, h2, pos, k1, k2) per turn: its position from 1 and the rolling key up to it."""
    rows = turns.select(
        "conv_id", "turn", F.floor(F.col("turn") / BLOCK).alias("block"),
        # NULL and empty differ
        F.xxhash64(F.col("role").isNull(), "role", F.col("text").isNull(), "text").alias("h1"),
        F.xxhash64(F.lit("second"), F.col("text").isNull(), "text", F.col("role").isNull(), "role").alias("h2"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "h1", "h2")
    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    starts = sizes.select("conv_id", "block", *[c.alias(n) for n, c in _before({"from": "n"}, F.sum).items()])
    placed = _same_block(rows.withColumn("at", F.row_number().over(inside)), starts)
    placed = placed.withColumn("pos", F.col("from") + F.col("at")).withColumns(
        {"e1": F.xxhash64("pos", "h1"), "e2": F.xxhash64("pos", "h2")}
    )
    placed = stored(placed.drop("from"), "turns")
    sums = placed.groupBy("conv_id", "block").agg(F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"))
    sums = sums.select("conv_id", "block", *[c.alias(n) for n, c in _before({"b1": "x1", "b2": "x2"}, F.bit_xor).items()])
    running = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rolled = placed.withColumns({"r1": F.bit_xor("e1").over(running), "r2": F.bit_xor("e2").over(running)})
    keyed = _same_block(rolled, sums)
    return keyed.select(
        "conv_id", "turn", "h1", "h2", "pos",
        F.col("b1").bitwiseXOR(F.col("r1")).alias("k1"), F.col("b2").bitwiseXOR(F.col("r2")).alias("k2"),
    )


def maximal(keyed: DataFrame) -> DataFrame:
    """conv_id and number of turns of the conversations that are no copy and no prefix of another."""
    key = ["pos", "k1", "k2"]
    ends = keyed.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("end")).select("conv_id", "end.*")
    lengths = ends.select(F.col("conv_id").alias("_conv"), F.col("pos").alias("n"))
    inner = keyed.join(lengths, F.col("conv_id").eqNullSafe(F.col("_conv"))).filter("pos < n")
    inner = inner.select(*key).distinct()
    # copies meet in one aggregate; a NULL conv_id stays only without a named copy
    owners = ends.groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    return owners.join(inner, key, "left_anti").select("conv_id", F.col("pos").alias("n_turns"))


def render_turn(role: Column, text: Column) -> Column:
    clean = lambda c: F.replace(c, F.lit("<|im_"), F.lit("<| im_"))
    return F.concat(
        F.lit(START), clean(F.coalesce(role, F.lit("unknown"))), F.lit("\n"),
        clean(F.coalesce(text, F.lit(""))), F.lit(END + "\n"),
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, text): the maximal conversations, parts of at most PART turns in order."""
    keyed = stored(prefixes(turns), "keyed")
    kept = maximal(keyed).select(F.col("conv_id").alias("_conv"))
    rows = turns.select(
        "conv_id", "turn", render_turn(F.col("role"), F.col("text")).alias("line"),
        F.xxhash64(F.col("role").isNull(), "role", F.col("text").isNull(), "text").alias("h1"),
    )
    mine = F.col("conv_id").eqNullSafe(F.col("_conv"))
    places = keyed.join(kept, mine, "left_semi")
    # equal turns of a conversation are alike, so each takes one of their places
    twin = Window.partitionBy("conv_id", "turn", "h1").orderBy("pos")
    places = places.withColumn("twin", F.row_number().over(twin)).select(
        F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.col("h1").alias("_h1"), F.col("twin").alias("_twin"), "pos"
    )
    rows = rows.join(kept, mine, "left_semi").withColumn("twin", F.row_number().over(Window.partitionBy("conv_id", "turn", "h1").orderBy("line")))
    same = mine & F.col("turn").eqNullSafe(F.col("_turn")) & (F.col("h1") == F.col("_h1")) & (F.col("twin") == F.col("_twin"))
    lines = rows.join(places, same).select("conv_id", "pos", "line", F.floor((F.col("pos") - 1) / PART).alias("part"))
    parts = lines.groupBy("conv_id", "part").agg(
        F.count("*").alias("n_turns"), F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("lines")
    )
    return parts.select("conv_id", "part", "n_turns", F.array_join("lines.line", "").alias("text"))
