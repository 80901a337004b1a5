"""Sheets of lines: layout, line styles, crop boxes, and the plan of scan damage. All of it is arithmetic on draws by page_id and line_id."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import SEED, batched, drawn_numbers, integer, pick, uniform, weighted
from ..functions.kernels import BAND, NOISE

LINES = 64
#: Fixed: what is drawn for sheets and lines.
WIDTHS, ROW_HEIGHTS = [1240, 1536, 1728], [58, 64, 72]
PAPERS, INKS = ["#ffffff", "#fbfaf6", "#f7f4ea", "#f1eee5", "#eeeeea"], ["#000000", "#111111", "#181818", "#222222"]
WEIGHTS = ["400", "400", "500", "600", "700"]
ROW_LEAST, GAP_LEAST = 42, 4
#: Fixed: profiles of damage with their weights in hundredths.
PROFILES = [("digital_clean", 10), ("raster_pdf", 15), ("book_scan", 27), ("thick_scan", 13), ("thin_scan", 9), ("overcooked_scan", 8), ("photocopy_bleed", 6), ("binary_lowres_bloat", 8), ("faded_scan", 4)]
MIXED = ("mixed", "book_scan", "ugly_scan")
#: Fixed: gates of damage with their probabilities.
GATES = {"noise": 0.16, "band": 0.07, "shadow": 0.07, "stain": 0.035, "rule": 0.06, "warp": 0.06, "rotate": 0.15, "unsharp": 0.18, "heavy_blur": 0.05}
LOW_JPEG, JPEG, LOW_JPEG_RANGE = 0.08, (62, 92), (42, 68)
#: Fixed: intensities by profile, and from where to where the strength of each gate is drawn (whole percents of unsharp).
INTENSITY = {"photocopy_bleed": (0.2, 0.82), "binary_lowres_bloat": (0.1, 0.42)}
UNSHARP, BLUR, DEGREES = (110, 180), (0.45, 1.15), 0.8


def pages(lines: DataFrame, size: int = LINES) -> DataFrame:
    """Adds page_id, sheet_line_index and n_lines, which is short on the last sheet. Lines are numbered from 0 without gaps, so the greatest number tells how many the last one has."""
    last = lines.agg(F.coalesce(F.max("line_id"), F.lit(-1)).alias("n")).first().n
    out = lines.withColumn("page_id", F.floor(F.col("line_id") / size).cast("long")).withColumn("sheet_line_index", (F.col("line_id") % size).cast("int"))
    return out.withColumn("n_lines", F.least(F.lit(size), F.lit(last + 1) - F.col("page_id") * size).cast("int"))


def each(lines: DataFrame, size: int = LINES) -> DataFrame:
    """(page_id, n_lines), a row for each sheet: draws by page_id are made on these and not on all lines."""
    return pages(lines, size).select("page_id", "n_lines").distinct()


def layout(df: DataFrame, max_height: int = 16000, seed: int = SEED) -> DataFrame:
    """Adds the sheet's attributes by page_id and n_lines; a sheet that is too high gets narrower gaps, then lower rows, in closed form."""
    u = lambda tag: batched(F.col("page_id"), tag, seed)
    df = df.withColumns({"sheet_width": pick(u("width"), WIDTHS), "row_height": pick(u("row"), ROW_HEIGHTS), "pad_x": integer(u("pad_x"), 16, 28), "pad_y": integer(u("pad_y"), 8, 14), "gap": integer(u("gap"), 6, 10), "paper": pick(u("paper"), PAPERS), "color": pick(u("color"), INKS)})
    n = F.col("n_lines")
    over = lambda: F.greatest(F.lit(0), n * (F.col("row_height") + F.col("gap")) + F.col("gap") - max_height)
    if max_height > 0:
        df = df.withColumn("__g", F.least(F.col("gap") - GAP_LEAST, F.ceil(over() / (n + 1)).cast("int"))).withColumn("gap", F.col("gap") - F.col("__g"))
        df = df.withColumn("__r", F.least(F.floor((F.col("row_height") - ROW_LEAST) / 2).cast("int"), F.ceil(over() / (n * 2)).cast("int"))).withColumn("row_height", F.col("row_height") - F.col("__r") * 2)
        df = df.withColumn("compacted", (F.col("__g") > 0) | (F.col("__r") > 0)).drop("__g", "__r")
    else:
        df = df.withColumn("compacted", F.lit(False))
    return df.withColumn("sheet_height", F.greatest(F.lit(64), n * (F.col("row_height") + F.col("gap")) + F.col("gap")))


def styles(df: DataFrame, opacity_prob: float = 0.08, word_prob: float = 0.22, letter_prob: float = 0.035, seed: int = SEED, word: tuple[float, float] = (-0.8, 4.0), letter: tuple[float, float] = (0.05, 0.35)) -> DataFrame:
    u = lambda tag: batched(F.col("line_id"), tag, seed)
    gated = lambda tag, p, low, high, other, places: F.when(F.col(f"__{tag}?") < p, F.bround(F.lit(low) + uniform(F.col("line_id"), tag, seed) * F.lit(high - low), places)).otherwise(F.lit(other))
    df = df.withColumns({f"__{tag}": u(tag) for tag in ("size", "weight", "height", "opacity?", "word?", "letter?")})
    df = df.withColumn("font_size", integer(F.col("__size"), 24, F.greatest(F.lit(24), F.least(F.lit(40), F.col("row_height") - 8))))
    df = df.withColumn("css_weight", pick(F.col("__weight"), WEIGHTS))
    df = df.withColumn("css_line_height", integer(F.col("__height"), F.greatest(F.col("font_size") + 6, F.col("row_height") - 8), F.col("row_height")))
    df = df.withColumn("css_opacity", gated("opacity", opacity_prob, 0.72, 0.96, 1.0, 3))
    df = df.withColumn("css_word_spacing_px", gated("word", word_prob, *word, 0.0, 2))
    return df.withColumn("css_letter_spacing_px", gated("letter", letter_prob, *letter, 0.0, 2)).drop("__size", "__weight", "__height", "__opacity?", "__word?", "__letter?")


def crop_boxes(df: DataFrame) -> DataFrame:
    top = F.col("gap") + F.col("sheet_line_index") * (F.col("row_height") + F.col("gap"))
    margin = F.least(F.col("pad_y"), F.greatest(F.lit(0), F.floor(F.col("gap") / 2).cast("int")))
    return df.withColumn("crop_top", F.greatest(F.lit(0), top - margin)).withColumn("crop_right", F.col("sheet_width")).withColumn("crop_bottom", F.least(F.col("sheet_height"), top + F.col("row_height") + margin))


def damage_plan(df: DataFrame, profile: str = "mixed", seed: int = SEED, gates: dict[str, float] = GATES, low_prob: float = LOW_JPEG, quality: tuple[int, int] = JPEG, low: tuple[int, int] = LOW_JPEG_RANGE, intensity: dict[str, tuple[float, float]] = INTENSITY, degrees: float = DEGREES) -> DataFrame:
    """Adds effective_profile and intensity, for each gate a boolean, the strengths that are drawn for them (null: not used) and jpeg_quality (null: the image isn't coded on the way)."""
    u = lambda tag: uniform(F.col("line_id"), tag, seed)
    if profile not in {*MIXED, "browser_clean", *dict(PROFILES)}:
        raise ValueError(f"unknown profile {profile!r}")
    every = {f"__{tag}": batched(F.col("line_id"), tag, seed) for tag in ("profile", *gates, "low_jpeg", "quality")}  # what every line needs; the others are drawn where they are used
    df = df.withColumns(every).withColumn("effective_profile", weighted(F.col("__profile"), PROFILES) if profile in MIXED else F.lit(profile))
    is_ = lambda *names: F.col("effective_profile").isin(*names)
    clean, bloat = is_("browser_clean"), is_("binary_lowres_bloat")
    allowed = dict.fromkeys(("noise", "band", "shadow", "stain", "warp", "heavy_blur"), ~bloat) | {"rule": F.lit(True), "rotate": ~is_("digital_clean", "binary_lowres_bloat"), "unsharp": is_("book_scan", "overcooked_scan", "photocopy_bleed")}
    for gate, p in gates.items():
        df = df.withColumn(gate, ~clean & allowed[gate] & (F.col(f"__{gate}") < p))
    within = lambda tag, a, b: F.bround(F.lit(float(a)) + u(tag) * F.lit(float(b) - float(a)), 4)
    strong = None
    for name, (a, b) in intensity.items():
        strong = (F.when if strong is None else strong.when)(is_(name), within("intensity", a, b))
    df = df.withColumn("intensity", strong if strong is not None else F.lit(None).cast("double"))
    df = df.withColumns({
        "noise_sigma": F.when(F.col("noise"), within("noise_sigma", *NOISE)),
        "band_amplitude": F.when(F.col("band"), within("band_amplitude", *BAND)),
        "degrees": F.when(F.col("rotate"), within("degrees", -degrees, degrees)),
        "unsharp_percent": F.when(F.col("unsharp"), integer(u("unsharp_percent"), *UNSHARP).cast("double")),
        "blur_radius": F.when(F.col("heavy_blur"), within("blur_radius", *BLUR)),
    })
    coded = F.when(F.col("__low_jpeg") < low_prob, integer(F.col("__quality"), *low)).otherwise(integer(F.col("__quality"), *quality))
    return df.withColumn("jpeg_quality", F.when(~clean, coded)).drop(*every)


def crop_pads(df: DataFrame, x: tuple[int, int] = (4, 28), y: tuple[int, int] = (2, 12), seed: int = SEED) -> DataFrame:
    """Adds crop_pad_x and crop_pad_y, what stays around the ink of a line."""
    return df.withColumn("crop_pad_x", integer(batched(F.col("line_id"), "crop_x", seed), *x)).withColumn("crop_pad_y", integer(batched(F.col("line_id"), "crop_y", seed), *y))


def split_high(df: DataFrame, size: int = LINES, max_height: int = 16000, seed: int = SEED) -> DataFrame:
    """Sheets that stay too high at the narrowest layout are halved, again and again: lines move to sheets 2p + 1 (the first floor(n / 2) of them) and 2p + 2, numbered anew. Each line works out its own sheet's layout, whose draws are made once for neighbours of a sheet, so no line is moved; if no sheet of `size` lines can be too high, nothing is done."""
    rounds = 0
    while max_height > 0 and size > 1 and size * (ROW_LEAST + GAP_LEAST) + GAP_LEAST > max_height:
        size, rounds = -(-size // 2), rounds + 1
    if not rounds:
        return df
    others = [c for c in df.columns if c not in ("page_id", "sheet_line_index", "n_lines")]

    @F.arrow_udf("page_id long, sheet_line_index int, n_lines int")
    def own(page: pa.Array, index: pa.Array, n: pa.Array) -> pa.Array:
        found = _halved(*(np.asarray(x).astype(np.int64) for x in (page, index, n)), max_height, seed, rounds)
        return pa.StructArray.from_arrays([pa.array(found[0]), pa.array(found[1], pa.int32()), pa.array(found[2], pa.int32())], ["page_id", "sheet_line_index", "n_lines"])

    return df.select(*others, own("page_id", "sheet_line_index", "n_lines").alias("__own")).select(*others, "__own.*")


def _halved(page: np.ndarray, index: np.ndarray, n: np.ndarray, max_height: int, seed: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What becomes of lines' page_id, sheet_line_index and n_lines: `layout`'s height by the same steps, again for each half."""
    for _ in range(rounds):
        row, gap = drawn_numbers(page, ("row", "gap"), seed)
        row, gap = np.array(ROW_HEIGHTS)[(row * len(ROW_HEIGHTS)).astype(np.int64)], 6 + (gap * 5).astype(np.int64)
        over = np.maximum(0, n * (row + gap) + gap - max_height)
        gap = gap - np.minimum(gap - GAP_LEAST, np.ceil(over / (n + 1)).astype(np.int64))
        over = np.maximum(0, n * (row + gap) + gap - max_height)
        row = row - 2 * np.minimum((row - ROW_LEAST) // 2, np.ceil(over / (n * 2)).astype(np.int64))
        high = (np.maximum(64, n * (row + gap) + gap) > max_height) & (n > 1)
        half = n // 2
        late = high & (index >= half)
        page, index, n = np.where(high, page * 2 + 1 + late, page), np.where(late, index - half, index), np.where(late, n - half, np.where(high, half, n))
    return page, index, n


def too_high(df: DataFrame, max_height: int = 16000, size: int = LINES) -> DataFrame:
    """(page_id, sheet_height, suggested): sheets that are too high, with the number of lines that would fit. None are if max_height is 0."""
    fits = F.greatest(F.lit(1), F.floor(F.lit(size * max_height) / F.col("sheet_height")).cast("int"))
    return df.where(F.lit(max_height > 0) & (F.col("sheet_height") > max_height)).select("page_id", "sheet_height", fits.alias("suggested")).distinct()


def file_name(line_id: Column, suffix: str = "jpg") -> Column:
    number = line_id.cast("string")
    return F.concat(F.lit("line_"), F.lpad(number, F.greatest(F.lit(10), F.length(number)), "0"), F.lit(f".{suffix}"))


def manifest(df: DataFrame, suffix: str = "jpg") -> DataFrame:
    """(line_id, split, value): a line of the manifest of its split."""
    return df.select("line_id", "split", F.concat(F.lit("images/"), file_name(F.col("line_id"), suffix), F.lit("\t"), F.col("text")).alias("value"))


#: Fixed: keys of a row of metadata, in order; split follows.
METADATA = ("filename", "text", "line_id", "font_family", "font_path", "source_path", "source_type", "label_source_index", "label_repeat_index", "degradation_profile", "image_width", "image_height", "bbox", "sheet_page_id", "sheet_line_index", "sheet_height", "sheet_row_height", "sheet_gap", "sheet_compacted_for_height", "font_size", "css_weight", "css_line_height", "css_opacity", "css_word_spacing_px", "css_letter_spacing_px", "crop_pad_x", "crop_pad_y")


def metadata(df: DataFrame) -> DataFrame:
    """(line_id, value): rows of metadata as JSON, nulls included; columns that the rows lack are null."""
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in (*METADATA, "split", "effective_profile", "render_fallback", "fallback_reason")]
    return df.select("line_id", F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))
