"""A whole run: sources or a label list to line tasks, sheets, damage plans, images and the output folder."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config, sinks
from ..functions.draws import uniform
from ..operators import fonts, metrics, render, sheets, units
from ..sources import discover, files

GATE_OPTIONS = {"noise": "extra_noise_prob", "band": "scanner_band_prob", "shadow": "edge_shadow_prob", "stain": "stain_prob", "rule": "nearby_rule_prob", "warp": "perspective_warp_prob", "heavy_blur": "heavy_blur_prob"}
SHUFFLE = 31337


def sources(o: argparse.Namespace) -> list[str]:
    """path:type of all sources, each once; none at all is an error unless there is a label list."""
    out = list(dict.fromkeys([*o.source, *(discover.default_sources(o.default_sources_dir) if o.use_default_sources else [])]))
    if not out and not o.label_source_manifest:
        raise ValueError("no sources; give --source path:type, --use-default-sources or --label-source-manifest")
    here, gone = discover.availability(out)
    if gone:
        print(discover.report(out))
    if out and not here and not o.label_source_manifest:
        raise ValueError("none of the sources exists")
    return here


def line_tasks(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """(line_id, text, source_path, source_type, label_source_index, label_repeat_index): units of interleaved documents, or repeated labels."""
    options = {"profile": o.text_cleanup_profile, "marks": o.strip_arabic_marks, "yeh": o.normalize_arabic_yeh_nonfinal, "zwnj": o.normalize_zwnj}
    if o.label_source_manifest:
        judged = files.judged_labels(files.raw_labels(spark, o.label_source_manifest), o.script_filter, not o.no_label_source_dedupe, **options)
        print("labels:", ", ".join(f"{k} {v}" for k, v in files.label_counts(judged).first().asDict().items()))
        rows = judged.where("fate = 'accepted'").select("label_idx", "label")
        rows = units.with_line_ids(rows, "label_idx", name="place").drop("label_idx")
        if o.label_source_shuffle:
            seed = o.seed + SHUFFLE if o.label_source_shuffle_seed is None else o.label_source_shuffle_seed
            rows = units.with_line_ids(rows.withColumn("u", uniform(F.col("place"), "shuffle", seed)), "u", "place", name="turn")
        else:
            rows = rows.withColumn("turn", F.col("place"))
        rows = rows.withColumn("label_repeat_index", F.explode(F.sequence(F.lit(0), F.lit(o.label_source_repeat - 1))))
        line = (F.col("turn") * o.label_source_repeat + F.col("label_repeat_index")).alias("line_id")
        out = rows.select(line, F.col("label").alias("text"), F.lit(o.label_source_manifest).alias("source_path"), F.lit("labels").alias("source_type"), F.col("turn").cast("int").alias("label_source_index"), "label_repeat_index")
        if out.isEmpty():
            raise ValueError("the label list holds no label")
    else:
        specs = sources(o)
        docs = files.read(spark, specs, **options)
        docs = units.numbered(docs.select("source_idx", "text"), "doc_id")
        if o.pseudo_kurdish:
            docs = docs.withColumn("text", units.shuffled_words(F.col("text"), F.col("doc_id"), o.seed))
        docs = units.interleave(docs, "source_idx", "doc_id", o.seed)
        rows = units.numbered_units(docs, config.unit(o), o.script_filter, o.seed, order="arrival", keep=("source_idx",))
        named = lambda i: F.element_at(F.array(*[F.lit(files.spec(s)[i]) for s in specs]), F.col("source_idx") + 1)
        out = rows.select("line_id", "text", named(0).alias("source_path"), named(1).alias("source_type"), F.lit(None).cast("int").alias("label_source_index"), F.lit(None).cast("int").alias("label_repeat_index"))
    return out.where(F.col("line_id") < o.max_lines) if o.max_lines else out


def planned(tasks: DataFrame, pool: DataFrame, o: argparse.Namespace) -> DataFrame:
    """Tasks with fonts, sheets, styles, crops, damage and splits: all that drawing needs. What asks for the last line, or for the lines with the least draws, comes first, as it runs by itself."""
    df = sheets.split_high(sheets.pages(tasks, o.sheet_lines), o.sheet_lines, o.browser_max_screenshot_height, o.seed)
    df = units.split_ratio(df, o.val_ratio, o.seed) if o.val_count is None else units.split_exact(df, o.val_count, o.seed)
    df = fonts.assign(df, pool, seed=o.seed).drop("family_idx", "variant_idx")
    df = sheets.layout(df, o.browser_max_screenshot_height, o.seed)
    df = sheets.styles(df, o.text_opacity_prob, o.word_spacing_prob, o.letter_spacing_prob, o.seed, (o.word_spacing_min_px, o.word_spacing_max_px), (o.letter_spacing_min_px, o.letter_spacing_max_px))
    df = sheets.crop_pads(sheets.crop_boxes(df), (o.crop_pad_x_min, o.crop_pad_x_max), (o.crop_pad_y_min, o.crop_pad_y_max), o.seed)
    gates = sheets.GATES | {g: getattr(o, name) for g, name in GATE_OPTIONS.items()}
    intensity = {"photocopy_bleed": (o.photocopy_bleed_intensity_min, o.photocopy_bleed_intensity_max), "binary_lowres_bloat": (o.binary_bloat_intensity_min, o.binary_bloat_intensity_max)}
    df = sheets.damage_plan(df, o.degradation_profile, o.seed, gates, o.low_quality_jpeg_prob, (o.jpeg_quality_min, o.jpeg_quality_max), (o.low_quality_jpeg_min, o.low_quality_jpeg_max), intensity, o.max_rotation_degrees)
    named = {"page_id": "sheet_page_id", "row_height": "sheet_row_height", "gap": "sheet_gap", "compacted": "sheet_compacted_for_height"}
    return df.withColumns({new: F.col(old) for old, new in named.items()} | {"degradation_profile": F.lit(o.degradation_profile)})


def font_pool(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    folders = [f for f in [o.fonts_dir, *o.extra_font_dir, *(discover.system_folders() if o.include_windows_fonts else [])] if f]
    if not folders:
        raise ValueError("no fonts; give --fonts-dir")
    suffixes = (*discover.SUFFIXES, *(discover.WEB_SUFFIXES if o.include_web_fonts else ()))
    judged = discover.judged_fonts(spark, folders, not o.no_dedupe_font_files, not o.no_group_font_families, o.font_include_regex, o.font_exclude_regex, suffixes)
    print("fonts:", ", ".join(f"{k} {v}" for k, v in discover.font_counts(judged).first().asDict().items()))
    found = judged.where("fate = 'accepted'").select("family", "path")
    if found.isEmpty():
        raise ValueError("no font is left")
    return found


def run(spark: SparkSession, o: argparse.Namespace) -> int:
    """The number of rows written. A folder that has rows is resumed, unless it is overwritten: lines that its metadata hold are not drawn again."""
    if not o.output_dir:
        raise ValueError("no --output-dir")
    if o.overwrite:
        sinks.clear(o.output_dir)
    had = sinks.state(spark, o.output_dir)
    if had.manifest_rows and not had.metadata_rows:
        raise ValueError("manifests have rows and metadata none; use --overwrite")
    if had.metadata_rows != had.manifest_rows:
        print(f"metadata have {had.metadata_rows} rows, manifests {had.manifest_rows}")
    pool = fonts.pool(font_pool(spark, o))
    counts = pool.agg(F.count_distinct("family").alias("font_families"), F.count("*").alias("font_files")).first().asDict()
    options = vars(o) | counts
    if had.metadata_rows:
        for line in sinks.drift(spark, o.output_dir, options):
            print("changed since the run before:", line)
    if o.dry_run:
        if not o.label_source_manifest:
            sources(o)
        print(counts)
        return 0
    sinks.prepare(o.output_dir)
    sinks.write_config(o.output_dir, options | {"created_at": spark.sql("SELECT date_format(now(), 'yyyy-MM-dd HH:mm:ss')").first()[0]})
    lines = planned(line_tasks(spark, o), pool, o)
    fallback = None if o.fallback_renderer == "none" else pool.orderBy("path").first().path
    high = None if fallback else sheets.too_high(lines, o.browser_max_screenshot_height, o.sheet_lines).orderBy("suggested").first()
    if high:
        raise ValueError(f"sheet {high.page_id} is {high.sheet_height} pixels high, {o.browser_max_screenshot_height} are allowed; use --sheet-lines {high.suggested} or --browser-max-screenshot-height 0")
    if had.metadata_rows:
        lines = units.remaining(lines, sinks.written(spark, o.output_dir))
    began = time.monotonic()
    drawn = render.rendered(lines, fallback, o.reject_crop_width_over, o.seed, o.browser_max_screenshot_height, frac=o.max_perspective_shift_frac, pad=o.geometry_pad_px)
    n, measures = sinks.commit(spark, drawn, o.output_dir, max(1, o.bench_every))
    for line in metrics.report(measures, time.monotonic() - began):
        print(line, flush=True)
    return n
