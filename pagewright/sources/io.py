"""Readers and writers of the stage tables. Paths may be local or on any file system Spark knows,
those of page files on any that Arrow knows too."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.functions import text as tx
from pagewright.operators.hotkeys import number_rows
from pagewright.operators.pages import discover_links
from pagewright.schemas import CRAWL_MANIFEST, PAGES
from pagewright.sources import pagefiles
from pagewright.sources.storage import scratch_path, stored

_CSV = {
    "header": "true",
    "multiLine": "true",
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


_CODEC = "zstd"  # of stage tables, which are mostly text


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stage table from CSV. Without a schema every column is text; types are never guessed."""
    reader = spark.read.options(**_CSV)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def with_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns that the schema declares otherwise, cast; what does not fit is NULL."""
    casts = {
        f.name: F.col(f.name).try_cast(f.dataType)
        for f in schema
        if f.name in df.columns and f.dataType != T.StringType()
    }
    return df.withColumns(casts) if casts else df


def write_csv(df: DataFrame, path: str) -> bool:
    """Write a stage table as CSV; an empty one leaves nothing. Returns whether it was written. The plan
    runs once: the rows are counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").options(**_CSV).csv(path)
    if seen.get["rows"]:
        return True
    target = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return False


def write_stage(df: DataFrame, path: str) -> int:
    """Write a stage table as Parquet with its order in ``ord``; returns the number of rows."""
    if "ord" not in df.columns:
        raise ValueError("a stage table carries its order in the column ord")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", _CODEC).parquet(path)
    return seen.get["rows"]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def in_file_order(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a CSV table with ``ord``: 0, 1, ... by file name and position in the file. A file of
    this format is read from start to end by one task, so its rows come in order."""
    rows = read_csv(spark, path).withColumns(
        {"_file": F.col("_metadata.file_path"), "_line": F.monotonically_increasing_id()}
    )
    return number_rows(rows, ["_file", "_line"], "ord", start=0).drop("_file", "_line")


def read_stage(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stage table with its order in ``ord``: ``path``.parquet, or ``path``.csv in file order."""
    if exists(spark, f"{path}.parquet"):
        return spark.read.parquet(f"{path}.parquet")
    if exists(spark, f"{path}.csv"):
        return with_types(in_file_order(spark, f"{path}.csv"), schema)
    raise FileNotFoundError(f"there is no {path}.parquet and no {path}.csv; run the stage before first")


def load_seeds(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Seeds with a product URL, numbered from 0 in file order (``ord``); the first ``limit`` if given."""
    seeds = read_csv(spark, path)
    if "product_url" not in seeds.columns:
        raise ValueError("the seed table must include a product_url column")
    seeds = seeds.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_line": F.monotonically_increasing_id(),
            "product_url": tx.strip(tx.text_of(F.col("product_url"))),
        }
    ).filter(F.col("product_url") != "")
    seeds = number_rows(seeds, ["_file", "_line"], "ord", start=0).drop("_file", "_line")
    if seeds.isEmpty():
        raise ValueError("the seed table has no valid product_url values; fill the template rows first")
    return seeds if limit is None else seeds.filter(F.col("ord") < limit)


def seed_template(categories: DataFrame, slots: int, seed_date: str) -> DataFrame:
    """One empty seed per category (column ``category``) and slot."""
    rows = categories.select("category", F.explode(F.sequence(F.lit(1), F.lit(slots))).alias("slot"))
    return rows.select(
        F.lit("").alias("product_url"),
        F.col("category").alias("category_quota"),
        F.concat(F.lit("manual seed slot "), F.col("slot").cast("string")).alias("chosen_reason"),
        F.lit(seed_date).alias("seed_date"),
    )


def _whole(files: DataFrame) -> DataFrame:
    """``files`` without filters going down to their scan: Spark plans a Python source once per table, so two
    uses of one table with unlike filters would read the files of one of them."""
    of = {"product_idx": F.lit(0), "page_no": F.lit(0), "payload_no": F.lit(0), "stage": F.lit("")}
    return files.withColumns({c: F.coalesce(F.col(c), of[c]) for c in files.columns if c in of})


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Stored page files as rows: stage, product_idx (from 0), page_no, html."""
    return _whole(pagefiles.page_rows(spark, path))


def write_page_files(pages: DataFrame, path: str) -> None:
    """One file per page, whose name carries stage, product and page number. A page without product or number
    has no file; rows of one page are lines of one file."""
    snapshot = F.coalesce(F.col("stage") == "product_snapshot", F.lit(False))
    named = pages.select(
        F.when(snapshot, "product_snapshot").otherwise("review_harvest").alias("stage"), "product_idx",
        F.when(snapshot, 1).otherwise(F.col("page_no")).alias("page_no"), "html",
    )
    _write_lines(named.withColumnRenamed("html", "body"), ["stage"], path)


def write_payload_files(payloads: DataFrame, path: str) -> None:
    """One file per captured payload: product_idx, payload_no, body (JSON text)."""
    named = payloads.select(F.lit("payload").alias("kind"), F.lit("review_harvest").alias("stage"), "product_idx", F.col("payload_no").alias("page_no"), "body")
    _write_lines(named, ["kind", "stage"], path)


def _write_lines(rows: DataFrame, names, path: str) -> None:
    whole = rows.withColumns({c: F.col(c).cast("int") for c in ("product_idx", "page_no")})
    whole = pagefiles.by_folder(whole.filter("product_idx IS NOT NULL AND page_no IS NOT NULL"))
    lines = F.array_join(F.collect_list(F.coalesce("body", F.lit(""))), "\n")
    whole = whole.groupBy("_folder", *names, "product_idx", "page_no").agg(lines.alias("body"))
    pagefiles.write_dealt(whole, path)


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """Captured payload files as rows: product_idx, payload_no, source_url, payload (JSON text)."""
    return _whole(pagefiles.payload_rows(spark, path))


def read_rendered_files(spark: SparkSession, path: str) -> DataFrame:
    """Stored rendered pages as rows: product_idx, html."""
    return _whole(pagefiles.rendered_rows(spark, path))


def stored_pages(files: DataFrame, manifest: DataFrame, seeds: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Page files joined with the manifest and the seeds to the PAGES table, one row per file.

    The first page of a product has the seed's URL, page n the n-th link found on the first page. Final
    URL and status are those of the last manifest row of the stage and URL, by scrape time.
    """
    last = manifest.groupBy("stage", F.col("source_url").alias("url")).agg(
        F.max_by(F.struct("final_url", "status_code"), F.coalesce("scrape_time", F.lit(""))).alias("m")
    ).select("stage", "url", F.col("m.final_url").alias("final_url"), F.col("m.status_code").alias("status_code"))
    numbered = files.withColumn("page_id", F.expr("shiftleft(cast(product_idx AS bigint), 21) + page_no * 2 + cast(stage = 'product_snapshot' AS int)"))
    numbered = stored(numbered, "page-files")  # each file is opened once
    firsts = numbered.filter("page_no = 1").join(seeds.select(F.col("ord").alias("product_idx"), F.col("product_url").alias("url")), "product_idx")
    firsts = firsts.join(last, ["stage", "url"], "left").withColumn("final_url", F.coalesce("final_url", "url"))
    found = discover_links(firsts.withColumnRenamed("page_id", "_first").withColumn("page_id", F.struct("stage", "product_idx")), max_pages)
    links = found.select("page_id.stage", "page_id.product_idx", "page_no", F.col("link").alias("url")).filter("page_no > 1")
    later = numbered.filter("page_no > 1").join(links, ["stage", "product_idx", "page_no"]).join(last, ["stage", "url"], "left")
    later = later.withColumn("final_url", F.coalesce("final_url", "url"))
    return firsts.unionByName(later).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PAGES])


def captured_for(captured: DataFrame, seeds: DataFrame) -> DataFrame:
    """Payload or rendered files with the ``product_url`` of their seed; a rendered page's ``source_url``
    is that URL too."""
    named = captured.join(seeds.select(F.col("ord").alias("product_idx"), "product_url"), "product_idx")
    return named if "source_url" in named.columns else named.withColumn("source_url", F.col("product_url"))


def export_table(df: DataFrame, path: str) -> dict:
    """Write Parquet to ``path`` and CSV beside it, as gzip files, which all readers of CSV here take as they are.
    The CSV is written from the stored Parquet, so the plan runs once; the row count is observed during that
    write."""
    csv_path = f"{path.removesuffix('.parquet')}.csv"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", _CODEC).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.write.mode("overwrite").option("compression", "gzip").options(**_CSV).csv(csv_path)
    return {
        "preferred_path": path,
        "csv_fallback_path": csv_path,
        "parquet_written": True,
        "rows": seen.get["rows"],
    }


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CRAWL_MANIFEST).json(path)


def append_manifest(rows: DataFrame, path: str) -> None:
    rows.select(*CRAWL_MANIFEST.names).write.mode("append").option("ignoreNullFields", "false").json(path)


def write_stage_manifest(spark: SparkSession, values: dict, path: str) -> dict:
    """One JSON row with the row counts and paths of a stage."""
    spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return values
