"""Reject tables and counters taken while writing.

Rows that a run cannot store go to one table with where they came from, the reason and their text, so nothing
disappears without a trace. Counters are ``DataFrame.observe`` metrics of the very write that stores the rows: no
second pass over them is made."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REJECTS = "source string, reason string, line string, application string, run_date string"


def observed_write(df: DataFrame, write: Callable[[DataFrame, Callable], None], **metrics: Column) -> dict:
    """``write(df, mark)`` writes ``mark`` of the rows as they go to the files; returns the metrics (and ``rows``) seen
    there. The mark stands last because a range partitioning reads what is below it twice. An empty frame, which
    Spark plans away together with its metrics, has 0 rows and no other metric."""
    if df.isEmpty():
        write(df, lambda d: d)
        return {"rows": 0, **dict.fromkeys(metrics)}
    watch = Observation(uuid.uuid4().hex)
    write(df, lambda d: d.observe(watch, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in metrics.items()]))
    return dict(watch.get)


def quarantine(rejected: DataFrame, path: str, application: str, run_date: str) -> int:
    """Appends (source, reason, line) rows to the reject table; returns how many there were."""
    out = rejected.select("source", "reason", "line", F.lit(application).alias("application"), F.lit(run_date).alias("run_date"))
    return observed_write(out, lambda df, mark: mark(df).write.mode("append").parquet(path))["rows"]


def wide_row(header: Column, cells: Column) -> Column:
    """F10 for one row: text stands beyond the last named column, so its cells cannot be told apart."""
    return F.exists(F.slice(cells, F.size(header) + 1, F.greatest(F.size(cells) - F.size(header), F.lit(0))), lambda x: F.trim(x) != "")
