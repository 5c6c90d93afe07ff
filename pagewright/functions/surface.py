"""The functions of the library as SQL functions of a session.

After :func:`register` SQL text can call ``normalize_text(x)``, ``mask_identifier(x)``, ``numeric_string(x)``,
``extract_product_id(url)`` and, after LATERAL, ``review_rows(payload)``. They are SQL functions, so the
optimizer sees their bodies: the scalar ones stay inside the query's own code, without a Python worker. The
table function reads its JSON with the library's one Python helper.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from pagewright.functions import html as hx
from pagewright.functions import jsontree as jt
from pagewright.functions import records as rx
from pagewright.functions import text as tx

NODES = "page_json_nodes"
REVIEW_COLUMNS = (
    "review_ord INT, review_text STRING, star_rating STRING, review_time_display STRING, variant_text STRING, media_flag BOOLEAN, "
    "seller_reply_flag BOOLEAN, reviewer_name_masked STRING, helpful_count_display STRING, image_count INT, video_flag BOOLEAN"
)


def _squeezed(value: str) -> str:
    return f"trim(regexp_replace(coalesce(CAST({value} AS STRING), ''), r'[{tx.SPACES}]+', ' '))"


def _masked(value: str) -> str:
    inner = "CASE WHEN length(n) <= 2 THEN repeat('*', length(n)) ELSE concat(substring(n, 1, 1), repeat('*', length(n) - 2), right(n, 1)) END"
    return tx.sql_let(f"lower({_squeezed(value)})", "n", inner)


def _product_id(url: str) -> str:
    query, path = (f"regexp_extract({url}, r'{hx._URL}', {group})" for group in (4, 3))

    def parameter(name: str) -> str:
        raw = tx.sql_non_empty(f"regexp_extract({query}, r'[?&]{name}=([^&]+)', 1)")
        return tx.sql_let(raw, "r", "coalesce(try_url_decode(r), translate(r, '+', ' '))")

    digits = f"try_element_at(regexp_extract_all(regexp_replace({path}, r';[^/]*$', ''), r'(?U)\\d+', 0), -1)"
    return f"coalesce({parameter('itemid')}, {parameter('product_id')}, {digits}, substring(sha2({url}, 256), 1, 16))"


SCALARS = {
    "normalize_text": ("x STRING", "STRING", f"lower({_squeezed('x')})"),
    "mask_identifier": ("x STRING", "STRING", _masked("x")),
    "numeric_string": ("x STRING", "STRING", "translate(" + tx.sql_strip("coalesce(x, '')") + ", ',', '.')"),
    "extract_product_id": ("url STRING", "STRING", _product_id("url")),
}


def _review_rows() -> str:
    """The rows of a payload that have a text, in reading order; of rows with one text, star and time the first."""
    key = "concat_ws('|', r.review_text, coalesce(r.star_rating, ''), coalesce(r.review_time_display, ''))"
    keys = f"transform(texts, r -> {key})"
    first = f"filter(texts, (r, i) -> array_position({keys}, {key}) = i + 1)"
    names = ", ".join(f"row.{c.split()[0]}" for c in REVIEW_COLUMNS.split(", ")[1:])
    return f"""SELECT place, {names} FROM (
      SELECT posexplode({first}) AS (place, row) FROM (
        SELECT filter({rx.reviews_sql('fields')}, r -> r.review_text IS NOT NULL) AS texts FROM (
          SELECT {rx.candidate_fields_sql('nodes', 'found')} AS fields FROM (
            SELECT nodes, {rx.candidates_sql('nodes')} AS found FROM (SELECT {NODES}(array(payload)) AS nodes)))))"""


def register(spark: SparkSession) -> None:
    """Define the functions for the session; those of the same names are replaced."""
    spark.udf.register(NODES, jt.node_reader())
    for name, (takes, gives, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURNS {gives} RETURN {body}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION review_rows(payload STRING) RETURNS TABLE ({REVIEW_COLUMNS}) RETURN {_review_rows()}")


def names() -> list[str]:
    return [*SCALARS, "review_rows"]
