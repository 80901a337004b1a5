"""Planned lines to images: drawing, trimming, damage, the gate of width and coding, by Arrow batches of lines. Each line is drawn by itself on the row that its sheet's layout gives it, so a failure touches no other line."""

from __future__ import annotations

import struct
import time
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from ..functions import jpeg, kernels, outlines
from ..functions.draws import SEED

PLAN = ("effective_profile", "intensity", "noise", "noise_sigma", "band", "band_amplitude", "shadow", "stain", "rule", "warp", "rotate", "degrees", "unsharp", "unsharp_percent", "heavy_blur", "blur_radius", "jpeg_quality")
#: Fixed: what the plain drawing of a line, used where the styled one fails, chooses from.
PLAIN_WIDTHS, PLAIN_HEIGHTS, PLAIN_SIZES = (900, 1100, 1300, 1500, 1700), (64, 72, 80, 96), (22, 42)
#: Rows handed on at a time: images are large.
ROWS = 64
ADDED = "image_width int, image_height int, bbox array<int>, render_fallback string, fallback_reason string, image_bytes binary, draw_us long, degrade_us long, code_us long"
#: Fixed: quality of the images that are kept.
QUALITY = 88
#: Bytes of fonts that a worker keeps.
FONT_BYTES = 128 << 20


def color(text: str) -> tuple[int, ...]:
    return tuple(bytes.fromhex(text.removeprefix("#")))


def styled(font: outlines.Font, row: dict) -> np.ndarray:
    height = row["crop_bottom"] - row["crop_top"]
    return outlines.draw(font, row["text"], height, row["sheet_width"], row["font_size"], color(row["color"]), color(row["paper"]), row["pad_x"], row["css_opacity"], row["css_word_spacing_px"], row["css_letter_spacing_px"])[0]


def plain(font: outlines.Font, row: dict, rng) -> np.ndarray:
    """Shrunk by steps of 2 down to 10; at times with a rule."""
    height, width = int(rng.choice(PLAIN_HEIGHTS)), int(rng.choice(PLAIN_WIDTHS))
    size = int(rng.integers(PLAIN_SIZES[0], PLAIN_SIZES[1] + 1))
    size = outlines.fitted(font, row["text"], size, width - 40, step=2, least=10)
    a, _ = outlines.draw(font, row["text"], height, width, size, color(row["color"]), color(row["paper"]), 20, least=10)
    a = a.copy()
    if rng.random() < 0.10:
        a[-max(2, height // 10)] = 150
    if rng.random() < 0.04:
        a[:, width // 40] = 150
    return a


def rendered(lines: DataFrame, fallback: str | None = None, reject_over: int = 0, seed: int = SEED, max_height: int = 0, **damage) -> DataFrame:
    """Adds image columns (JPEG) and times to lines that have a font_path and what sheets.layout, styles, crop_boxes, crop_pads and damage_plan add.

    Workers read a font file when they first need it, from the folder that driver and executors share, and keep FONT_BYTES of them; no row carries font bytes. Lines wider than reject_over pixels after damage have no image (null), if it isn't 0. If a line can't be drawn in its style, or its sheet is higher than max_height (if that isn't 0), the job fails, unless a fallback font's path is given: then it is drawn plainly in that font and says why. Empty and null texts are drawn as blank rows.
    """
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema.fields]) + ", " + ADDED
    names = lines.columns

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        fonts: dict[str, tuple[int, outlines.Font]] = {}

        def font(path: str) -> outlines.Font:
            if path not in fonts:
                with open(path, "rb") as f:
                    data = f.read()
                while fonts and sum(n for n, _ in fonts.values()) + len(data) > FONT_BYTES:
                    fonts.pop(next(iter(fonts)))
                fonts[path] = len(data), outlines.Font(data)
            return fonts[path][1]

        def drawn(row: dict) -> list:
            row["text"] = row["text"] if isinstance(row["text"], str) else ""
            rng, why = np.random.default_rng([seed, int(row["line_id"])]), None
            times = [time.perf_counter()]
            try:
                if 0 < max_height < row["sheet_height"]:
                    raise ValueError(f"sheet too high: {row['sheet_height']} of {max_height}")
                a = kernels.trim(styled(font(row["font_path"]), row), row["crop_pad_x"], row["crop_pad_y"])
            except (ValueError, KeyError, IndexError, struct.error) as e:
                if fallback is None:
                    raise
                why = f"{type(e).__name__}: {e}"[:500]
                a = plain(font(fallback), row, rng)
            times.append(time.perf_counter())
            a = kernels.damage(a, {k: None if row[k] != row[k] else row[k] for k in PLAN}, int(rng.integers(2**63)), **damage)
            times.append(time.perf_counter())
            h, w = a.shape[:2]
            image = None if reject_over and w > reject_over else jpeg.encode(a, QUALITY)
            times.append(time.perf_counter())
            return [*(row[n] for n in names), w, h, [0, 0, w, h], "plain_line" if why else None, why, image, *(int((b - a) * 1e6) for a, b in zip(times, times[1:]))]

        columns = [*names, *(x.split()[0] for x in ADDED.split(", "))]
        for batch in batches:
            for first in range(0, len(batch), ROWS):
                yield pd.DataFrame(map(drawn, batch.iloc[first : first + ROWS].to_dict("records")), columns=columns)

    # A line takes a hundredth of a second: lines are dealt out, however few partitions they come in.
    tasks = max(3 * lines.sparkSession.sparkContext.defaultParallelism, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return lines.repartition(tasks, "line_id").mapInPandas(run, schema)
