"""Wiki dumps, wikitext, plain text and label lists."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from . import jsonl

TYPES = ("wikipedia", "wikitext", "jsonl", "text")


def wikipedia(spark: SparkSession, path: str, parser: T.Hook | None = None, **options) -> DataFrame:
    """(title, text) of the pages of an XML dump, .bz2 or not: the last revision of each page that is no redirect and has a body of 100 characters."""
    schema = "title string, redirect struct<_title:string>, revision array<struct<text:string>>"
    pages = spark.read.schema(schema).format("xml").option("rowTag", "page").load(path).where("redirect IS NULL")
    rows = pages.select(F.coalesce("title", F.lit("")).alias("title"), T.clean_wikitext(F.coalesce(F.element_at("revision", -1)["text"], F.lit("")), parser, **options).alias("body"))
    return rows.where(T.long_enough(F.col("body"), "wikipedia")).select("title", T.normalize_label(F.concat("title", F.lit("\n\n"), "body"), **options).alias("text"))


def _whole(spark: SparkSession, path: str, kind: str, clean) -> DataFrame:
    rows = spark.read.text(path, wholetext=True).select(F.lit("").alias("title"), clean(F.col("value")).alias("text"))
    return rows.where(T.long_enough(F.col("text"), kind))


def wikitext(spark: SparkSession, path: str, parser: T.Hook | None = None, **options) -> DataFrame:
    return _whole(spark, path, "wikitext", lambda c: T.clean_wikitext(c, parser, **options))


def plain(spark: SparkSession, path: str, **options) -> DataFrame:
    return _whole(spark, path, "text", lambda c: T.normalize_label(c, **options))


def raw_labels(spark: SparkSession, path: str) -> DataFrame:
    """(label_idx, raw) of a list: a line, or what follows its first tab; empty lines are none."""
    raw = F.when(F.col("value").contains("\t"), F.regexp_extract("value", r"(?s)^[^\t]*\t(.*)$", 1)).otherwise(F.col("value"))
    return spark.read.text(path).where("value <> ''").select(F.monotonically_increasing_id().alias("label_idx"), raw.alias("raw"))


def judged_labels(raw: DataFrame, script: str = "any", distinct: bool = True, order: str = "label_idx", **options) -> DataFrame:
    """Adds label and fate: accepted, or why not (empty, script, duplicate: of an earlier one by `order`). A frequent label's rows hold a number each and are ranked by it."""
    rows = raw.withColumn("label", T.normalize_label(F.coalesce("raw", F.lit("")), **options)).drop("raw")
    fate = F.when(F.col("label") == "", "empty").when(~T.passes_script(F.col("label"), script), "script")
    rows = rows.withColumn("fate", fate)
    if not distinct:
        return rows.withColumn("fate", F.coalesce("fate", F.lit("accepted")))
    firsts = rows.where("fate IS NULL").groupBy("label").agg(F.min(order).alias("__first"))  # summed up in each task before the shuffle
    rows = rows.join(firsts.withColumnRenamed("label", "__label"), (F.col("label") == F.col("__label")) & F.col("fate").isNull(), "left")
    return rows.withColumn("fate", F.coalesce("fate", F.when(F.col("__first") == F.col(order), "accepted").otherwise("duplicate"))).drop("__label", "__first")


def label_counts(judged: DataFrame) -> DataFrame:
    """One row: raw, empty, script, duplicates, accepted."""
    n = lambda fate: F.count_if(F.col("fate") == fate)
    return judged.agg(F.count("*").alias("raw"), n("empty").alias("empty"), n("script").alias("script"), n("duplicate").alias("duplicates"), n("accepted").alias("accepted"))


def labels(spark: SparkSession, path: str, script: str = "any", distinct: bool = True, **options) -> DataFrame:
    """(label_idx, label) of a list. Empty labels and those of other scripts are dropped, and repeats after the first."""
    return judged_labels(raw_labels(spark, path), script, distinct, **options).where("fate = 'accepted'").select("label_idx", "label")


def spec(source: str) -> tuple[str, str]:
    """(path, type) of "path:type", cut at the last colon."""
    path, colon, kind = source.rpartition(":")
    if not colon or kind.lower() not in TYPES:
        raise ValueError(f"{source!r} is no path:type; types: {', '.join(TYPES)}")
    return path, kind.lower()


def read(spark: SparkSession, sources: list[str], parser: T.Hook | None = None, skip: int = 0, **options) -> DataFrame:
    """(source_idx, title, text) of all sources, without the first `skip` documents of each. Documents of JSON lines are taken once for each id, whichever source they are in."""
    parsed = [spec(s) for s in sources]
    if not parsed:
        raise ValueError("no sources")
    frames = []
    for i, (path, kind) in enumerate(parsed):
        if kind != "jsonl":
            rows = plain(spark, path, **options) if kind == "text" else (wikipedia if kind == "wikipedia" else wikitext)(spark, path, parser, **options)
            frames.append(rows.select(F.lit(i).alias("source_idx"), "title", "text"))
    json = [jsonl.lines(spark, path, i) for i, (path, kind) in enumerate(parsed) if kind == "jsonl"]
    if json:  # a shuffle: their order is that of ids
        frames.append(jsonl.first_documents(functools.reduce(DataFrame.unionByName, json), **options).select("source_idx", "title", "text"))
    out = functools.reduce(DataFrame.unionByName, frames)
    if not skip:
        return out
    from ..operators.units import numbered

    rows = numbered(out, "__n")  # sources stand one after the other, each in the order of its files
    firsts = rows.groupBy("source_idx").agg(F.min("__n").alias("__first")).withColumnRenamed("source_idx", "__source")
    return rows.join(F.broadcast(firsts), F.col("source_idx") == F.col("__source")).where(F.col("__n") >= F.col("__first") + skip).drop("__n", "__first", "__source")
