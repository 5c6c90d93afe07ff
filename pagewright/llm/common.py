"""Shared helpers of this folder."""

from __future__ import annotations

import json
import string
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 50_000
WHITE = r"[\x20\x09-\x0D]+"
UPPER_LETTERS, LOWER_LETTERS = string.ascii_uppercase, string.ascii_lowercase
# lower-casing of A-Z only, on UTF-8 bytes
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def by_value(module: str) -> None:
    """Send the functions of ``module`` to the workers as code, so that they need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_words(text: Column, gaps: str = WHITE) -> Column:
    """The words between ``gaps``; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gaps), "")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores as it takes to be none of ``columns``, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_az(text: Column) -> Column:
    """``text`` with A-Z lower-cased and no other letter."""
    return F.translate(text, UPPER_LETTERS, LOWER_LETTERS)


def parameter_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table made from a parameter, as one literal, so that no Python worker has to send it."""
    names = [column.split()[0] for column in schema.split(", ")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    kinds = ", ".join(": ".join(column.split(" ", 1)) for column in schema.split(", "))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kinds}>>")))


def small(rows: DataFrame, n: int) -> DataFrame:
    """``rows``, a table of ``n`` rows made from a parameter, marked for broadcast unless it is large."""
    return F.broadcast(rows) if n <= BROADCAST_ROWS else rows


by_value(__name__)
