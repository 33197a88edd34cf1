"""Order-dependent operators over numbered lines/rows.

Input rows carry ``(group..., pos)``: a file and a line number, a project and a
row number. Everything here is an aggregation or an equi-join on unique keys, or
a chunked scan, so one very large file/group is never sorted or held by a
single task:

* first/last per group: ``min_by``/``max_by`` (partial aggregation map-side);
* line after a marker: equi-join on ``(group, pos + 1)``;
* lines between markers / running state: a two-level scan -- local state inside
  fixed-size chunks of ``pos`` (parallel windows over (group, chunk)), then the
  carry from earlier chunks (a window over one summary row per chunk), joined
  back on (group, chunk).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


CHUNK = 65536


def number_lines(df: DataFrame, text_col: str, keep: Sequence[str], pos_col: str = "line_no",
                 line_col: str = "line") -> DataFrame:
    """Split a whole text into numbered lines (1-based); a carriage return ending a line is dropped."""
    return (df.select(*keep, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias(pos_col, line_col))
              .withColumn(pos_col, (F.col(pos_col) + 1).cast("bigint"))
              .withColumn(line_col, F.regexp_replace(F.col(line_col), r"\r\z", "")))


def text_lines(text: Column) -> Column:
    """Lines of a whole text as an array (the same lines that ``number_lines`` numbers). A text is one row
    already, so positions inside it need no shuffle; the line-number forms below are for line sources."""
    return F.transform(F.split(text, "\n", -1), lambda x: F.regexp_replace(x, r"\r\z", ""))


def first_line(lines: Column, cond) -> Column:
    """1-based place of the first line for which ``cond(line)`` holds; 0 when there is none."""
    return F.array_position(F.transform(lines, cond), F.lit(True))


def lines_between_first(lines: Column, start, stop) -> Column:
    """S7 on an array: struct(first, block) -- the place of the first ``start`` line, and the lines from it up
    to (excluding) the first ``stop`` line after it; ``first`` is 0 when there is no ``start`` line."""
    first = first_line(lines, start)
    after = F.slice(lines, (first + 1).cast("int"), F.size(lines))
    end = first_line(after, stop)
    length = F.when(end > 0, end).otherwise(F.size(after) + 1)
    block = F.when(first > 0, F.slice(lines, F.greatest(first, F.lit(1)).cast("int"), length.cast("int")))
    return F.struct(first.alias("first"), block.alias("block"))


def first_by_group(df: DataFrame, group: Sequence[str], pos_col: str, value: Column, name: str) -> DataFrame:
    """Value of the first row (smallest pos) per group."""
    return df.groupBy(*group).agg(F.min_by(value, F.col(pos_col)).alias(name))


def last_by_group(df: DataFrame, group: Sequence[str], pos_col: str, value: Column, name: str) -> DataFrame:
    """Value of the last row (largest pos) per group -- 'last row wins'."""
    return df.groupBy(*group).agg(F.max_by(value, F.col(pos_col)).alias(name))


def first_match_pos(df: DataFrame, group: Sequence[str], pos_col: str, cond: Column, name: str) -> DataFrame:
    """Position of the first row satisfying ``cond`` per group (groups without a hit are absent)."""
    return df.filter(cond).groupBy(*group).agg(F.min(pos_col).alias(name))


def attach_per_group(rows: DataFrame, per_group: DataFrame, group: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a one-row-per-group table back to the rows. The per-group side is an aggregate, so
    AQE measures it at run time: under the broadcast threshold it becomes a broadcast hash join
    (the rows are not shuffled at all); beyond it, AQE's skew handling splits a hot group's
    partition, which is safe because the per-group side holds one row per key."""
    return rows.join(per_group, list(group), how)


def rows_after_marker(df: DataFrame, group: Sequence[str], pos_col: str, cond: Column,
                      offset: int = 1) -> DataFrame:
    """The row ``offset`` lines after the first row matching ``cond`` per group
    (an equi-join on the unique (group, pos) key, no window)."""
    marks = first_match_pos(df, group, pos_col, cond, "_mark").select(
        *group, (F.col("_mark") + offset).alias(pos_col))
    return df.join(marks, list(group) + [pos_col], "inner")


def rows_between_first(df: DataFrame, group: Sequence[str], pos_col: str, start: Column, stop: Column,
                       include_start: bool = True) -> DataFrame:
    """Rows from the first ``start`` row up to (excluding) the first ``stop`` row after it."""
    s = first_match_pos(df, group, pos_col, start, "_start")
    marked = attach_per_group(df, s, group)
    e = (marked.filter(stop & (F.col(pos_col) > F.col("_start")))
               .groupBy(*group).agg(F.min(pos_col).alias("_stop")))
    with_stop = attach_per_group(marked, e, group, "left")
    lo = (F.col(pos_col) >= F.col("_start")) if include_start else (F.col(pos_col) > F.col("_start"))
    hi = F.col("_stop").isNull() | (F.col(pos_col) < F.col("_stop"))
    return with_stop.filter(lo & hi).drop("_start", "_stop")


def state_before(df: DataFrame, group: Sequence[str], pos_col: str, signal: Column,
                 name: str = "state_before", chunk: int = CHUNK) -> DataFrame:
    """Last non-null ``signal`` strictly before each row, per group, in ``pos`` order.

    Two-level scan: a window inside (group, chunk) gives the local state; the carry is the last
    non-null signal of earlier chunks, computed over one summary row per chunk.
    """
    g = list(group)
    x = df.withColumn("_sig", signal).withColumn("_chunk", F.floor(F.col(pos_col) / F.lit(chunk)).cast("long"))
    w_local = Window.partitionBy(*g, "_chunk").orderBy(pos_col).rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_local", F.last("_sig", ignorenulls=True).over(w_local))
    summary = (x.filter(F.col("_sig").isNotNull())
                .groupBy(*g, "_chunk").agg(F.max_by("_sig", F.col(pos_col)).alias("_chunk_last")))
    # one row per (group, chunk); the carry is the last signal of any earlier chunk
    chunks = x.select(*g, "_chunk").distinct().join(summary, g + ["_chunk"], "left")
    w_carry = Window.partitionBy(*g).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.select(*g, "_chunk", F.last("_chunk_last", ignorenulls=True).over(w_carry).alias("_carry"))
    out = x.join(carry, g + ["_chunk"], "left")
    return (out.withColumn(name, F.coalesce(F.col("_local"), F.col("_carry")))
               .drop("_sig", "_chunk", "_local", "_carry"))


def block_lines(df: DataFrame, group: Sequence[str], pos_col: str, line_col: str,
                start_marker: str, stop_marker: str) -> DataFrame:
    """Lines after a line holding ``start_marker`` up to a line holding ``stop_marker``
    (start excluded, stop line excluded); a line holding both closes and reopens."""
    line = F.col(line_col)
    signal = (F.when(F.instr(line, start_marker) > 0, F.lit(1))
               .when(F.instr(line, stop_marker) > 0, F.lit(0)))
    st = state_before(df, group, pos_col, signal)
    return st.filter((F.col("state_before") == 1) & (F.instr(line, stop_marker) == 0)).drop("state_before")
