"""JSON lines: records of any shape to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

#: Fixed: names of fields, by what they hold, in the order in which they are tried.
TITLE = ("title", "headline", "heading", "name")
SUMMARY = ("summary", "description", "excerpt", "subtitle", "lead", "abstract")
HTML = ("article_html", "content_html", "body_html", "html")
BODY = ("content_text", "content", "body", "text", "article", "raw_content")
LANGUAGE = ("language", "lang", "locale", "language_code")
ID = ("id", "uuid", "url", "uri", "link", "slug")


def pick(v: Column, names: tuple[str, ...]) -> Column:
    """The first field that is neither missing, null, empty, zero nor false, as a string."""
    out = []
    for name in names:
        x = F.try_variant_get(v, f"$.{name}", "string")
        kind = F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))
        number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        falsy = x.isNull() | (x == "") | (number & (F.try_variant_get(v, f"$.{name}", "double") == 0)) | ((kind == "BOOLEAN") & (x == "false")) | x.isin("[]", "{}")
        out.append(F.when(~falsy, x))
    return F.coalesce(*out)


def lines(spark: SparkSession, path: str, source: int = 0) -> DataFrame:
    """(source_idx, file, n, line) of the lines of a file that aren't blank; n grows with the place in the file."""
    rows = spark.read.text(path).select(F.lit(source).alias("source_idx"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"), T.strip(F.col("value")).alias("line"))
    return rows.where("line <> ''")


def first_documents(rows: DataFrame, **options) -> DataFrame:
    """(source_idx, doc_key, title, language, text) of lines that are objects, one for each id among all sources: the first by source, file and place. Without an id each line is its own.

    Documents of up to 50 characters are dropped, after duplicates are. With an outer normaliser (`outer`), texts whose language skips it don't pass through it.
    """
    from ..operators.units import first_of_each

    rows = rows.withColumn("v", F.try_parse_json("line")).where(F.schema_of_variant("v").startswith("OBJECT"))
    rows = rows.withColumn("doc_key", F.coalesce(pick(F.col("v"), ID), F.sha1("line")))
    rows = first_of_each(rows.select("source_idx", "doc_key", "v", "file", "n"), "doc_key", "source_idx", "file", "n")
    found = lambda names: pick(F.col("v"), names)
    raw = rows.select("source_idx", "doc_key", found(TITLE).alias("title"), found(LANGUAGE).alias("language"), found(SUMMARY).alias("summary"), found(HTML).alias("html"), found(BODY).alias("plain"))
    outer = options.pop("outer", None)
    body = F.coalesce(T.clean_html(F.col("html"), **options), F.col("plain"))
    text = T.join_unique_blocks(F.array("title", "summary", "body"), **options)
    if outer:
        text = F.when(T.uses_outer_normaliser(F.coalesce("language", F.lit(""))), T.join_unique_blocks(F.array("title", "summary", "body"), outer=outer, **options)).otherwise(text)
    rows = raw.withColumn("body", body).where("body IS NOT NULL").select("source_idx", "doc_key", "title", "language", text.alias("text"))
    return rows.where(T.long_enough(F.col("text"), "jsonl"))


def documents(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """(source_idx, doc_key, title, language, text) of the files of JSON lines, each id once among all of them."""
    rows = lines(spark, paths[0])
    for i, path in enumerate(paths[1:], 1):
        rows = rows.unionByName(lines(spark, path, i))
    return first_documents(rows, **options)
