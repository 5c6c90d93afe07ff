"""Counts of events in tumbling and sliding windows over a folder that grows.

The stream's time is the latest event time that earlier batches brought, less ``delay``: the watermark. A window
is final, and written once, when the watermark has passed its end; an event that comes later counts in those of
its windows that are not final yet. What is dropped is counted after the rows of a task have met: one for each
window, group and task, so it is no more than the late rows are, and zero only without any. Rows without time
belong to no window.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed(events: DataFrame, time: str, width: str, by=(), slide: str | None = None, delay: str = "0 seconds", **measures: Column) -> DataFrame:
    """window_start, window_end, ``by``, n_rows and ``measures`` per window of ``width`` that begins every
    ``slide`` (each ``width`` without one). Works on a stream and, without lateness, on a table."""
    by = [by] if isinstance(by, str) else list(by)
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(time, delay) if events.isStreaming else timed.filter(F.col(time).isNotNull())
    span = F.window(time, width, slide) if slide else F.window(time, width)
    found = timed.groupBy(span, *by).agg(F.count("*").alias("n_rows"), *[v.alias(k) for k, v in measures.items()])
    return found.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n_rows", *measures)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> dict[str, int]:
    """Work through the files that are there now, write what is final to ``path`` and stop. The next run with
    this ``checkpoint`` goes on from there. Returns how many rows were read, and how many partial groups the
    watermark dropped."""
    query = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    batches = [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
    return {
        "rows": sum(b["numInputRows"] for b in batches),
        "dropped": sum(int(s.get("numRowsDroppedByWatermark", 0)) for b in batches for s in b["stateOperators"]),
    }
