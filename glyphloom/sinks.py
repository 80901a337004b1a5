"""The output folder: images, manifests, metadata and configuration. The folder has to be one that driver and executors share."""

from __future__ import annotations

import json
import os
import shutil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import metrics, sheets, units

#: Fixed: names that a run owns in its output folder; nothing else there is touched.
IMAGES, TRAIN, VAL, METADATA, CONFIG, TEMPORARY = "images", "train_list.txt", "val_list.txt", "metadata.jsonl", "generator_config.json", "_tmp_html"
STAGING = "_rows"
#: Fixed: options whose change between a run and its resumption is reported.
DRIFT = ("seed", "use_default_sources", "source", "fonts_dir", "extra_font_dir", "include_windows_fonts", "include_web_fonts", "no_dedupe_font_files", "no_group_font_families", "text_cleanup_profile", "strip_arabic_marks", "normalize_arabic_yeh_nonfinal", "normalize_zwnj", "max_lines", "val_count", "val_ratio")


def clear(out: str) -> None:
    for name in (IMAGES, TRAIN, VAL, METADATA, CONFIG, TEMPORARY, STAGING):
        p = Path(out) / name
        if p.is_dir():
            shutil.rmtree(p)
        else:
            p.unlink(missing_ok=True)


def prepare(out: str) -> None:
    (Path(out) / IMAGES).mkdir(parents=True, exist_ok=True)
    for name in (TRAIN, VAL, METADATA):
        (Path(out) / name).touch()


def _lines(spark: SparkSession, out: str, *names: str) -> DataFrame:
    paths = [str(Path(out) / n) for n in names if (Path(out) / n).exists()]
    return spark.read.text(paths) if paths else spark.createDataFrame([], "value string")


def state(spark: SparkSession, out: str):
    """One row: metadata_rows, manifest_rows, max_line_id."""
    return units.output_state(_lines(spark, out, METADATA), _lines(spark, out, TRAIN, VAL)).first()


def written(spark: SparkSession, out: str) -> DataFrame:
    """line_id of the rows of metadata."""
    v = F.try_variant_get(F.try_parse_json("value"), "$.line_id", "long")
    return _lines(spark, out, METADATA).select(v.alias("line_id")).where("line_id IS NOT NULL")


def write_config(out: str, options: dict) -> None:
    (Path(out) / CONFIG).write_text(json.dumps(options, indent=2, ensure_ascii=False, default=str), encoding="utf-8")


def drift(spark: SparkSession, out: str, options: dict) -> list[str]:
    """What differs from the configuration of the run before, among DRIFT."""
    path = Path(out) / CONFIG
    if not path.exists():
        return []
    try:
        old = json.loads(path.read_text(encoding="utf-8"))
    except json.JSONDecodeError:
        return ["the old configuration can't be read"]
    frame = lambda d: spark.createDataFrame([(k, json.dumps(d.get(k))) for k in DRIFT], "name string, value string")
    return [f"{r.name}: {r.old} -> {r.new}" for r in units.drift(frame(old), frame(options)).orderBy("name").collect()]


def _images(folder: str):
    def run(batches):
        for batch in batches:
            for name, data in zip(batch["filename"], batch["image_bytes"], strict=True):
                part = f"{folder}/.{name}.{os.getpid()}"
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, f"{folder}/{name}")
            yield batch[["line_id"]]

    return run


def _append(rows: DataFrame, target: Path, staging: Path) -> None:
    """Lines in order of line_id, written by many tasks, then their files joined to the end of the target."""
    rows.repartitionByRange("line_id").sortWithinPartitions("line_id").select("value").write.mode("overwrite").text(str(staging))
    with target.open("ab") as f:
        for part in sorted(staging.glob("part-*")):
            with part.open("rb") as g:
                shutil.copyfileobj(g, f, 1 << 20)
    shutil.rmtree(staging)


def commit(spark: SparkSession, rows: DataFrame, out: str, every: int = 0) -> tuple[int, DataFrame]:
    """Rendered rows into the folder: first all rows to a staging table, so that nothing is drawn twice, then images, each by a rename, then manifests, last metadata. What resumes a run goes by metadata, so a row that is there has its image. Rows without an image are rejected ones. Returns the number of rows, and the measures of each `every` sheets (operators.metrics)."""
    prepare(out)
    base = Path(out) / STAGING
    rows.withColumn("filename", sheets.file_name(F.col("line_id"))).write.mode("overwrite").parquet(str(base / "rows"))
    every_row = spark.read.parquet(str(base / "rows"))
    rows = every_row.where("image_bytes IS NOT NULL")
    n = rows.select("filename", "line_id", "image_bytes").mapInPandas(_images(str(Path(out) / IMAGES)), "line_id long").count()
    have = _lines(spark, out, TRAIN, VAL).select(F.regexp_extract("value", r"^images/line_(\d+)\.", 1).try_cast("long").alias("line_id")).distinct()
    lines = sheets.manifest(rows).join(have, "line_id", "left_anti")  # a run that broke between manifests and metadata
    for name, split in ((TRAIN, "train"), (VAL, "val")):
        _append(lines.where(F.col("split") == split), Path(out) / name, base / split)
    _append(sheets.metadata(rows), Path(out) / METADATA, base / "metadata")
    kept = F.col("image_bytes").isNotNull().cast("long")
    parts = every_row.select(F.col("sheet_page_id").alias("page_id"), kept.alias("lines"), kept.alias("files"), (1 - kept).alias("rejected"), F.coalesce(F.octet_length("image_bytes"), F.lit(0)).cast("long").alias("bytes"), "draw_us", "degrade_us", "code_us")
    whole = ("files", "rejected", "bytes", "draw_us", "degrade_us", "code_us")
    measures = metrics.rollup(metrics.merged(parts, whole, ()), ("lines", *whole[:3]), whole[3:], every) if every > 0 else parts.limit(0)
    measures = spark.createDataFrame(measures.collect(), measures.schema)  # a row for each `every` sheets, before the staging table goes
    shutil.rmtree(base)
    return n, measures
