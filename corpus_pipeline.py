"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, shards.

Each stage takes (session, documents, folder of tables), works on all rows that the stage before kept,
and its result is written as Parquet and read again as the documents of the next one. All stages but
the last return the columns of ``documents``.

NULL and empty texts have too few words for the quality rules and go in the first stage. Repeated rows and ties
are judged alike everywhere but among near-duplicates, where one row of a class stays, the first read of
those with its smallest id. An empty table stays empty. Further columns, whatever their names, come through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import decontaminate, mixing, quality, sharding, simhash
from pagewright.llm.common import table
from pagewright.llm.queries import WEIGHTS
from pagewright.sources.storage import discard, scratch_scope, stored

# no toxic document is wanted here, however rare they are
CLEAN_WEIGHTS = {**WEIGHTS, "toxic": 0.0}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the SimHash operator: three-word shingles, at most two bits apart."""
    return simhash.drop_near_duplicates(docs, size=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; a row without an id cannot be named by a leak and
    is judged with the other such rows."""
    leaks = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    leaks = leaks.select(leaks["doc_id"].alias("_leak")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["_leak"]), "left_anti")


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to CLEAN_WEIGHTS takes them, at most once each."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"), CLEAN_WEIGHTS, anchor="good")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return sharding.shard_documents(docs, 40)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_weights),
    ("sharding", shards),
]

# The classifier of the mixing stage cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch_scope(spark) as kept:
            out = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            kept.append(out)
        discard(docs)
        docs = out
    return docs
