"""The walk over embedded JSON as a recursive query, without a Python worker.

One step of the recursion unfolds all objects and arrays of a level. A map of texts keeps the order of an
object's members and a map of variants tells what their values are (a variant alone sorts its keys); a node's
path is the array of its positions, so paths sort in document order. Only a page's nodes meet, to be ranked.

Against :func:`pagewright.operators.pages.json_nodes`, which parses in Python: an object that names a key
twice makes its text unreadable here, a number comes as Spark writes it (equal but for very large or small
ones), a container as JSON without blanks, and nodes below ``depth`` levels are left out, which ``truncated``
tells for their page.

The session's limit on the rows of a recursion is lifted, as it would count all pages together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import html as hx
from pagewright.functions import text as tx

DEPTH = 60
MOST_DEPTH = 98  # the session's limit on the levels of a recursion is 100

_KIND = """CASE split(schema_of_variant({0}), '<')[0] WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list'
    WHEN 'STRING' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' WHEN 'VOID' THEN 'null' ELSE 'num' END"""
_MEMBERS = """transform(
    arrays_zip(map_entries(from_json(raw, 'map<string,string>')), map_values(from_json(raw, 'map<string,variant>'))),
    x -> named_struct('key', x['0'].key, 'raw', x['0'].value, 'value', x['1']))"""
_ITEMS = """transform(
    arrays_zip(from_json(raw, 'array<string>'), from_json(raw, 'array<variant>')),
    x -> named_struct('key', CAST(NULL AS STRING), 'raw', x['0'], 'value', x['1']))"""
_WALK = f"""
WITH RECURSIVE walk (page_id, blob, path, key, kind, raw, depth) AS (
  SELECT page_id, blob, array(0), CAST(NULL AS STRING), kind, CASE WHEN kind IN ('dict', 'list') THEN json ELSE CAST(value AS STRING) END, 0
  FROM (SELECT *, {_KIND.format('value')} AS kind FROM (SELECT *, try_parse_json(json) AS value FROM {{texts}}) WHERE value IS NOT NULL)
  UNION ALL
  SELECT page_id, blob, concat(path, array(place)), child.key, {_KIND.format('child.value')}, child.raw, depth + 1
  FROM walk, LATERAL posexplode(CASE kind WHEN 'dict' THEN {_MEMBERS} ELSE {_ITEMS} END) AS t(place, child)
  WHERE kind IN ('dict', 'list') AND depth < {{depth}}
)
SELECT *, CASE kind WHEN 'dict' THEN size(map_keys(from_json(raw, 'map<string,string>')))
  WHEN 'list' THEN size(from_json(raw, 'array<string>')) ELSE 0 END AS size FROM walk"""


def walk(pages: DataFrame, depth: int = DEPTH) -> DataFrame:
    """All nodes of the JSON in ``pages`` (page_id, html): page_id, blob, path, key, kind, raw (the text of a
    scalar, the JSON of a container), depth, size."""
    if not 0 < depth <= MOST_DEPTH:
        raise ValueError(f"the depth is 1 to {MOST_DEPTH}, not {depth}")
    spark = pages.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    texts = pages.select("page_id", F.posexplode(hx.json_texts(tx.text_of(F.col("html")))).alias("blob", "json"))
    return spark.sql(_WALK, texts=texts, depth=depth)


def json_nodes(pages: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per JSON node of a page as of :func:`pagewright.operators.pages.json_nodes`, with
    ``truncated``: whether the page has nodes below ``depth`` levels, which are not here."""
    page = Window.partitionBy("page_id")
    order = page.orderBy("blob", "path")
    ranked = walk(pages, depth).withColumns({
        "pos": F.row_number().over(order) - 1,
        "truncated": F.max((F.col("depth") == depth) & (F.col("size") > 0)).over(page),
    })
    text = F.when(F.col("kind") == "bool", F.initcap("raw")).when(F.col("kind").isin("str", "num"), F.col("raw"))
    return ranked.select("page_id", "blob", "pos", "key", "kind", text.alias("text"), "size", "truncated")


def deep_find(pages: DataFrame, keys, depth: int = DEPTH) -> DataFrame:
    """Every value whose key (any case) is in ``keys``: page_id, blob, path, key, kind, value, by whose blob
    and path they are in document order. Containers come as JSON text."""
    wanted = sorted({key.lower() for key in keys})
    found = walk(pages, depth).filter(F.lower("key").isin(*wanted))
    value = F.when(F.col("kind") == "bool", F.initcap("raw")).otherwise(F.col("raw"))
    return found.select("page_id", "blob", "path", "key", "kind", value.alias("value"))
