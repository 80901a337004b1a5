"""Font files: family keys, dedup by content, pools, and the choice of a font for each line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.draws import SEED, batched, choice, uniform

#: Fixed: tokens of file names that tell a style.
STYLES = ("regular", "normal", "bold", "bd", "italic", "it", "oblique", "light", "lt", "medium", "med", "semibold", "semi", "demibold", "black", "heavy", "thin", "extra", "extrabold", "extralight", "condensed", "narrow")
#: Fixed: tokens that tell a vendor or collection.
VENDORS = ("font", "fonts", "unicode", "kurdish", "kurdfonts", "collection", "sorani", "central", "main", "set", "abd", "xb", "k")


def _tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), "[^0-9a-z]+"), lambda t: (t != "") & ~t.isin(*STYLES, *VENDORS))


def family_key(path: Column) -> Column:
    """Of a path below the font folder: what is left of the file's name, else the last two tokens of the whole path, else the bare name."""
    bare = F.regexp_replace(path, r"\.[^./]*\z", "")
    stem = F.substring_index(bare, "/", -1)
    own, every = _tokens(stem), _tokens(bare)
    key = F.when(F.size(own) > 0, F.array_join(own, "_")).when(F.size(every) > 0, F.array_join(F.slice(every, F.greatest(F.size(every) - 1, F.lit(1)), 2), "_"))
    key = F.coalesce(key, F.regexp_replace(F.lower(stem), "[^0-9a-z_-]+", "_"))
    key = F.regexp_replace(key, "^_+|_+$", "")
    return F.when(key == "", "font").otherwise(key)


def matches(key: Column, path: Column, pattern: str) -> Column:
    """Whether a pattern is found in a font's family and path, whatever the case."""
    return F.concat(key, F.lit(" "), path).rlike(f"(?i){pattern}")


def identity(size: Column, content: Column) -> Column:
    """Of a file: hash of its size and its first MiB."""
    return F.sha1(F.concat(size.cast("string").cast("binary"), F.substring(content, 1, 1 << 20)))


def dedup(files: DataFrame) -> DataFrame:
    """One file of each content, the first by path; files: path, size, content."""
    first = Window.partitionBy("identity").orderBy("path")
    return files.withColumn("identity", identity(F.col("size"), F.col("content"))).withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def pool(paths: DataFrame) -> DataFrame:
    """(family, path, family_idx, variant_idx, n_variants) of paths: families, from the path unless there is such a column, and their files in order of name."""
    family = F.col("family") if "family" in paths.columns else family_key(F.col("path"))
    keyed = paths.select(family.alias("family"), "path").distinct()
    out = keyed.withColumn("family_idx", F.dense_rank().over(Window.orderBy("family")) - 1)  # font files are few
    own = Window.partitionBy("family")
    return out.withColumn("variant_idx", F.row_number().over(own.orderBy("path")) - 1).withColumn("n_variants", F.count("*").over(own))


def assign(lines: DataFrame, fonts: DataFrame, key: str = "line_id", seed: int = SEED) -> DataFrame:
    """A font for each line: first a family, all alike, then a file of it. The pool is as large as a font folder: its files are broadcast if they are at most MOST, and joined by their numbers otherwise."""
    pool = fonts.agg(F.count_distinct("family_idx").alias("families"), F.count("*").alias("files")).first()
    if not pool.families:
        raise ValueError("no fonts")
    draw = batched if isinstance(lines.schema[key].dataType, IntegralType) else uniform
    small = F.broadcast if pool.files <= MOST else lambda df: df
    families = fonts.select("family_idx", F.col("n_variants").alias("__variants")).distinct()
    # numbers that can't be null: else the join asks whether they are, which makes the draws once more
    number = lambda c: F.coalesce(c.cast("int"), F.lit(-1))
    lines = lines.withColumns({"family_idx": number(choice(draw(F.col(key), "family", seed), pool.families)), "__variant": draw(F.col(key), "variant", seed)})
    chosen = lines.join(small(families), "family_idx")
    chosen = chosen.withColumn("variant_idx", number(F.floor(F.col("__variant") * F.col("__variants")))).drop("__variant", "__variants")
    files = fonts.select("family_idx", "variant_idx", F.col("family").alias("font_family"), F.col("path").alias("font_path"))
    return chosen.join(small(files), ["family_idx", "variant_idx"])


#: Files of a pool that are broadcast: a few MB of paths.
MOST = 20_000
