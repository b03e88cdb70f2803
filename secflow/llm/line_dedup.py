"""Removal of repeated lines by overlapping three-line windows, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = 3
#: A window without any such character is never judged.
NOT_BLANK = r"[^ \t\n\x0B\f\r]"


def _windows(lines: Column, width: int) -> Column:
    """(line number, two hashes) of each window of ``width`` lines; null for a blank one."""

    def window(i: Column) -> Column:
        part = [F.get(lines, i + k) for k in range(width)]
        return F.when(F.concat(*part).rlike(NOT_BLANK), F.struct(
            i.alias("line"), F.xxhash64(*part).alias("one"), F.xxhash64(F.lit(width), *reversed(part)).alias("two")))

    starts = F.when(F.size(lines) >= width, F.sequence(F.lit(0), F.size(lines) - width)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, window)


def _with_lines(text: Column, of_lines: Callable[[Column], Column]) -> Column:
    """``of_lines`` of the lines of a text. The lambda binds them once; else they are split again for each line."""
    return F.get(F.transform(F.array(F.split(text, "\n", -1)), of_lines), 0)


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = LINES,
                          carry: bool = False) -> DataFrame:
    """Drop every line that lies in a later occurrence of a window of ``width`` consecutive lines.

    Lines are the parts between line feeds. Occurrences are ordered by (id, text hash, line number);
    the first of all stays, and the lines of later ones go, overlapping windows merged. Windows are
    judged on the input. Returns ``doc_id``, ``text`` (kept lines joined by line feeds), ``n_lines``
    and ``n_removed``, one row per input row; other input columns are ignored, whatever their names, or
    with ``carry`` returned in a struct ``row`` (all input columns but the text).

    A null text is a text of one empty line. Texts of fewer lines than ``width``, and windows of blank
    lines, are never changed. A null id sorts first. Rows equal in id and text are one document for the
    comparison, and each gets the same result; equal texts under different ids lose all but the first.
    An empty table gives an empty result. A hot window is counted in partial aggregates, and the join
    that follows can be split by the planner, so no window is gathered in one task.
    """
    row = [F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("row")] if carry else []
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *row)
    base = base.withColumn("text_hash", F.xxhash64("text"))
    found = (base.select("doc_id", "text_hash", F.explode(_with_lines(F.col("text"), lambda x: _windows(x, width))).alias("w"))
             .where("w IS NOT NULL").select("doc_id", "text_hash", "w.*"))
    place = F.struct("doc_id", "text_hash", "line")
    firsts = (found.groupBy("one", "two").agg(F.min(place).alias("first"), F.count("*").alias("times"))
              .where("times > 1").drop("times"))
    later = (found.join(firsts, ["one", "two"]).where(~place.eqNullSafe(F.col("first")))
             .groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("starts")))
    covered = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (width - 1))))
    gone = later.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), covered.alias("covered"))
    joined = base.join(gone, base.doc_id.eqNullSafe(gone.gone_id) & (base.text_hash == gone.gone_hash), "left")
    kept = _with_lines(F.col("text"), lambda x: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("covered")), lambda i: F.get(x, i)))
    return (joined.withColumn("n_lines", F.size(F.split("text", "\n", -1)).cast("long"))
            .withColumn("kept", F.when(F.col("covered").isNotNull(), kept))
            .select("doc_id", F.when(F.col("covered").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("text"),
                    "n_lines", F.coalesce(F.col("n_lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"), *(["row"] if carry else [])))
