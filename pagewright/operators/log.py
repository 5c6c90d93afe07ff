"""Ordered cuts over a stored page log.

A log row is one page of a run: ``run``, ``seq`` (order in the run), ``seed`` (the product the page
was read for), ``product_id``, ``page_no`` (order within the seed), ``n`` (rows it gave) and, where
needed, ``stop_reason``. The cuts keep the rows that a run stopping at that point would have read.
Apply them as streak, cap, stop, budget: the first two look only backwards, so a blocked page that
they drop was never reached and must not stop the run. Every limit is the caller's; None keeps all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.operators.clean import keep_first
from pagewright.operators.hotkeys import chunk

def _with_streak(log: DataFrame, keys, order, empty):
    """Chunks with ``_streak``: how many rows in a row, this one included, are empty."""
    numbered = chunk(log, keys, order).numbered("_at")
    last_full = numbered.running("_full", "max", F.when(~empty, F.col("_at")))
    return last_full.with_column("_streak", F.col("_at") - F.coalesce("_full", F.lit(0)))


def streak_cut(log: DataFrame, limit: int | None = None, keys=("run", "seed")) -> DataFrame:
    """Per run and seed, drop the pages after ``limit`` pages in a row without rows."""
    if limit is None:
        return log
    streaks = _with_streak(log, keys, ["page_no"], F.col("n") == 0)
    hit = F.when(F.col("_streak") >= limit, 1)
    stopped = streaks.running("_stopped", "max", hit, exclusive=True).done()
    return stopped.filter(F.col("_stopped").isNull()).select(*log.columns)


def review_cap_cut(log: DataFrame, cap: int | None = None, keys=("run", "product_id")) -> DataFrame:
    """Per run and product, drop the pages after the one whose running count reaches ``cap``.

    The count goes on between seeds of one product: once it has reached the cap, a later seed keeps
    its pages up to the first that has rows. So a page stays when the count before it is below the
    cap or when its own seed has given no rows yet. Rows of an optional ``exempt`` column count but
    are never cut.
    """
    if cap is None:
        return log
    counted = chunk(log, keys, ["seq"]).running("_before", "sum", F.col("n"), exclusive=True).done()
    # where the cap is reached, a seed keeps its pages up to the first with rows
    seed = [*keys, "seed"]
    firsts = log.groupBy(*[F.col(c).alias(f"_{c}") for c in seed]).agg(F.min(F.when(F.col("n") != 0, F.col("seq"))).alias("_full"))
    same = F.lit(True)
    for c in seed:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    both = counted.join(firsts, same)
    keep = (F.col("_before") < cap) | F.col("_full").isNull() | (F.col("seq") <= F.col("_full"))
    if "exempt" in log.columns:
        keep = keep | F.col("exempt")
    return both.filter(keep).select(*log.columns)


def stop_fast_cut(log: DataFrame, keep_blocked: bool = False) -> DataFrame:
    """Per run, drop the first blocked page and everything after it. With ``keep_blocked`` that page
    stays, as it does in the manifest."""
    stops = log.groupBy("run").agg(
        F.min(F.when(F.col("stop_reason").isNotNull(), F.col("seq"))).alias("_stop")
    )
    stops = stops.filter(F.col("_stop").isNotNull())
    before = (F.col("seq") <= F.col("_stop")) if keep_blocked else (F.col("seq") < F.col("_stop"))
    return log.join(stops, "run", "left").filter(F.col("_stop").isNull() | before).drop("_stop")


def stop_once(log: DataFrame) -> DataFrame:
    """The rows of a log of one run up to its first blocked page, that page included. The stop is one
    value for the table, so no rows have to meet."""
    stop = log.agg(F.min(F.when(F.col("stop_reason").isNotNull(), F.col("seq"))).alias("stop")).scalar()
    return log.filter(stop.isNull() | (F.col("seq") <= stop))


def budget_cut(log: DataFrame, max_requests: int | None = None) -> DataFrame:
    """Per run, keep the first ``max_requests`` pages and say in ``over_budget`` whether the run
    wanted more."""
    if max_requests is None:
        return log.withColumn("over_budget", F.lit(False))
    numbered = chunk(log, ["run"], ["seq"]).numbered("_at").done()
    wanted = log.groupBy("run").agg((F.count("*") > max_requests).alias("over_budget"))
    return numbered.filter(F.col("_at") <= max_requests).drop("_at").join(wanted, "run")


def empty_payload_streak(log: DataFrame) -> DataFrame:
    """Add ``consecutive_empty_payloads``: pages in a row, up to this one, with an empty body
    (``is_empty``)."""
    streaks = _with_streak(log, ["run"], ["seq"], F.col("is_empty")).done()
    return streaks.select(*log.columns, F.col("_streak").alias("consecutive_empty_payloads"))


def run_summary(log: DataFrame, keys=("run",)) -> DataFrame:
    """Per run (without ``keys`` for the table as one run): pages read, the first stop reason, rows written (blocked pages write none)."""
    blocked = F.col("stop_reason").isNotNull()
    return log.groupBy(*keys).agg(
        F.count("*").alias("requests_made"),
        F.min_by("stop_reason", F.when(blocked, F.col("seq"))).alias("stop_reason"),
        F.sum(F.when(blocked, 0).otherwise(F.col("n"))).alias("rows_written"),
    )


def number_payloads(payload_rows: DataFrame, key: str = "seed") -> DataFrame:
    """Set ``review_page`` of payload rows to the rank of their payload (``payload_no``) among those
    of the same seed that gave rows."""
    gave = payload_rows.select(key, "payload_no").distinct()
    numbered = chunk(gave, [key], ["payload_no"]).numbered("review_page").done()
    return payload_rows.drop("review_page").join(numbered, [key, "payload_no"])


def choose_source(
    shells: DataFrame,
    payload_rows: DataFrame,
    card_rows: DataFrame,
    embedded_rows: DataFrame,
    key: str = "seed",
    fallback_enabled: bool = True,
) -> DataFrame:
    """Review rows of each seed from its best source, marked in ``source``.

    ``shells`` holds the keys of shell pages. For those, payload rows if there are any, else card
    rows if there are any, else the embedded rows; for all other pages the embedded rows.
    """
    embedded = embedded_rows.withColumn("source", F.lit("embedded"))
    if not fallback_enabled:
        return embedded
    keys = shells.select(key).distinct()
    payload = payload_rows.join(keys, key, "left_semi").withColumn("source", F.lit("payload"))
    with_payload = payload.select(key).distinct()
    cards = card_rows.join(keys, key, "left_semi").join(with_payload, key, "left_anti")
    cards = cards.withColumn("source", F.lit("card"))
    replaced = with_payload.unionByName(cards.select(key).distinct())
    return append_rows(payload, cards, embedded.join(replaced, key, "left_anti"))


def append_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name; a column a table lacks is NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def one_per_url(pages: DataFrame, order_by: str, stage: str | None = None) -> DataFrame:
    """The first stored page of each URL by ``order_by``; with a ``stage`` column only pages of ``stage``."""
    if stage is not None and "stage" in pages.columns:
        pages = pages.filter(F.col("stage") == stage)
    return keep_first(pages, ["url"], order_by)


def match_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Stored pages (one per URL) of each discovered link, with the link's ``page_no``."""
    stored = pages.drop("page_no").withColumnRenamed("url", "link")
    own = [c for c in stored.columns if c not in links.columns or c == "link"]
    return links.join(stored.select(*own), "link")


def missing_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Discovered links that no stored page answers."""
    return links.join(pages.select(F.col("url").alias("link")), "link", "left_anti")
