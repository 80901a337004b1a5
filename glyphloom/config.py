"""Options of a run: names, defaults, choices and checks."""

from __future__ import annotations

import argparse
import math

from .functions.text import MODES, PROFILES
from .operators import sheets, units

#: Fixed: options and their defaults. None and [] are strings, unless TYPES says otherwise; False is a flag.
DEFAULTS = {
    "output_dir": None, "fonts_dir": None, "extra_font_dir": [], "include_windows_fonts": False, "include_web_fonts": False, "no_dedupe_font_files": False,
    "no_group_font_families": False, "font_include_regex": None, "font_exclude_regex": None, "source": [], "use_default_sources": False, "default_sources_dir": "./sources",
    "convert_latin_kurdish_to_arabic": False, "max_lines": 0, "seed": 20260629, "target_unit": "line", "label_source_manifest": None, "label_source_repeat": 1,
    "label_source_shuffle": False, "label_source_shuffle_seed": None, "no_label_source_dedupe": False, "script_filter": "any",
    "line_words_min": 1, "line_words_max": 34, "line_words_mode": 18, "line_chars_min": 6, "line_chars_max": 260,
    "phrase48_words_min": 2, "phrase48_words_max": 10, "phrase48_words_mode": 5, "phrase48_chars_min": 16, "phrase48_chars_max": 48,
    "short_phrase_words_min": 1, "short_phrase_words_max": 6, "short_phrase_words_mode": 3, "short_phrase_chars_min": 8, "short_phrase_chars_max": 32,
    "word_words_min": 1, "word_words_max": 1, "word_words_mode": 1, "word_chars_min": 2, "word_chars_max": 24,
    "pseudo_kurdish": False, "max_seen_docs": 200000, "resume": False, "overwrite": False, "download_wiki_dump": [], "download_dir": "./downloads", "wiki_dump_url": None,
    "text_cleanup_profile": "conservative_sorani", "strip_arabic_marks": False, "normalize_arabic_yeh_nonfinal": False, "normalize_zwnj": False,
    "mode": "sheet", "renderer": "outline", "fallback_renderer": "none", "browser_max_screenshot_height": 16000, "sheet_lines": 64,
    "crop_pad_x": None, "crop_pad_y": None, "crop_pad_x_min": 4, "crop_pad_x_max": 28, "crop_pad_y_min": 2, "crop_pad_y_max": 12, "reject_crop_width_over": 0,
    "bench_every": 100, "val_ratio": 0.002, "val_count": None, "degradation_profile": "mixed", "jpeg_quality_min": 62, "jpeg_quality_max": 92,
    "perspective_warp_prob": 0.06, "max_perspective_shift_frac": 0.025, "geometry_pad_px": 32, "max_rotation_degrees": 0.8, "scanner_band_prob": 0.07, "edge_shadow_prob": 0.07,
    "stain_prob": 0.035, "extra_noise_prob": 0.16, "nearby_rule_prob": 0.06, "text_opacity_prob": 0.08, "word_spacing_prob": 0.22, "word_spacing_min_px": -0.8,
    "word_spacing_max_px": 4.0, "letter_spacing_prob": 0.035, "letter_spacing_min_px": 0.05, "letter_spacing_max_px": 0.35, "heavy_blur_prob": 0.05,
    "low_quality_jpeg_prob": 0.08, "low_quality_jpeg_min": 42, "low_quality_jpeg_max": 68, "photocopy_bleed_intensity_min": 0.2, "photocopy_bleed_intensity_max": 0.82,
    "binary_bloat_intensity_min": 0.1, "binary_bloat_intensity_max": 0.42, "dry_run": False,
}
TYPES = {"label_source_shuffle_seed": int, "crop_pad_x": int, "crop_pad_y": int, "val_count": int}
#: Options of a browser and of threads, taken and not used: lines are drawn by the workers themselves, and Spark schedules.
UNUSED = {"browser_exe": None, "browser_timeout": 60, "browser_retries": 0, "browser_retry_delay": 1.0, "browser_screenshot_settle_seconds": 10.0, "browser_screenshot_settle_poll": 0.1, "browser_verbose_log": False, "sheet_workers": 2, "writer_workers": 4, "tmp_dir": None}
CHOICES = {
    "target_unit": tuple(units.UNITS), "script_filter": MODES, "text_cleanup_profile": PROFILES, "fallback_renderer": ("none", "pil", "plain"),
    "degradation_profile": ("mixed", "browser_clean", "ugly_scan", *dict(sheets.PROFILES)), "renderer": ("outline", "chrome"),
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser("glyphloom", description="Text corpora to labelled line images.")
    out.add_argument("--version", action="version", version="glyphloom 1")
    for name, default in {**DEFAULTS, **UNUSED}.items():
        flag = "--" + name.replace("_", "-")
        if default is False:
            out.add_argument(flag, action="store_true")
        elif default == []:
            out.add_argument(flag, action="append", default=[])
        else:
            out.add_argument(flag, type=TYPES.get(name, str if default is None else type(default)), default=default, choices=CHOICES.get(name))
    return out


def check(o: argparse.Namespace) -> argparse.Namespace:
    """Raises ValueError naming the first option that is out of bounds. A fixed crop pad sets both ends of its range."""

    def need(ok: bool, what: str) -> None:
        if not ok:
            raise ValueError(what)

    for axis in "xy":
        if (fixed := getattr(o, f"crop_pad_{axis}")) is not None:
            setattr(o, f"crop_pad_{axis}_min", fixed)
            setattr(o, f"crop_pad_{axis}_max", fixed)
    bounds = {f"{unit}_{what}": (1, math.inf) for unit in units.UNITS for what in ("words", "chars")}
    bounds |= {"crop_pad_x": (0, math.inf), "crop_pad_y": (0, math.inf), "photocopy_bleed_intensity": (0, 1), "binary_bloat_intensity": (0, 1), "jpeg_quality": (1, 100), "low_quality_jpeg": (1, 100)}
    for name, (least, most) in bounds.items():
        low, high = getattr(o, f"{name}_min"), getattr(o, f"{name}_max")
        flag = "--" + name.replace("_", "-")
        need(least <= low and high <= most, f"{flag}-min/max must lie within {least} and {most}")
        need(low <= high, f"{flag}-min is larger than {flag}-max")
        mode = getattr(o, f"{name}_mode", low)
        need(low <= mode <= high, f"{flag}-mode must lie between min and max")
    need(o.reject_crop_width_over >= 0, "--reject-crop-width-over must not be negative")
    need(o.label_source_repeat >= 1, "--label-source-repeat must be 1 or more")
    need(o.sheet_lines >= 1, "--sheet-lines must be 1 or more")
    need(not (o.resume and o.overwrite), "--resume and --overwrite exclude each other")
    return o


def unit(o: argparse.Namespace) -> tuple[int, ...]:
    """The bounds of the chosen unit, as operators.units.UNITS holds them."""
    return tuple(getattr(o, f"{o.target_unit}_{k}") for k in ("words_min", "words_max", "words_mode", "chars_min", "chars_max"))
