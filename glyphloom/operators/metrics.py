"""Measures of sheets: those of split sheets merged, and totals for every so many sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merged(parts: DataFrame, added: Sequence[str], averaged: Sequence[str], key: str = "page_id") -> DataFrame:
    """One row for each sheet from those of its parts: lines and the measures of whole sheets are added, measures of a line are averaged by lines. Measures are whole numbers; without any line an average is 0."""
    lines = F.sum("lines")
    by_lines = [F.coalesce(F.expr(f"sum(`{c}` * lines) div nullif(sum(lines), 0)"), F.lit(0).cast("long")).alias(c) for c in averaged]
    return parts.groupBy(key).agg(lines.alias("lines"), *by_lines, *(F.sum(c).alias(c) for c in added))


def rollup(sheets: DataFrame, counts: Sequence[str], times: Sequence[str], every: int, key: str = "page_id") -> DataFrame:
    """(part, pages, counts, times): sums for each `every` sheets by number; a part that has none gives no row."""
    part = F.floor(F.col(key) / max(1, every)).alias("part")
    return sheets.groupBy(part).agg(F.count("*").alias("pages"), *(F.sum(c).alias(c) for c in (*counts, *times)))


def report(rows: DataFrame, seconds: float) -> list[str]:
    """A line for each part of a rollup with lines, bytes, files, rejected and the times of drawing, damage and coding in microseconds: sums, and milliseconds a sheet. Its rates are those of the whole run, which lasted that many seconds."""
    found = rows.orderBy("part").collect()  # a row for each `every` sheets
    pages, lines = sum(r.pages for r in found), sum(r.lines for r in found)
    out = [f"[bench] pages={r.pages} lines={r.lines} avg_lines_per_page={r.lines / max(1, r.pages):.1f} files={r.files} rejected_width={r.rejected} bytes={r.bytes / (1 << 20):.2f}MiB " + " ".join(f"{name}={r[c] / 1000 / max(1, r.pages):.1f}" for name, c in (("draw_lines_ms", "draw_us"), ("degrade_lines_ms", "degrade_us"), ("encode_jpeg_ms", "code_us"))) for r in found]
    return [*out, f"[bench] page_rate={pages / max(0.001, seconds):.2f}/s line_rate={lines / max(0.001, seconds):.1f}/s"] if found else out
