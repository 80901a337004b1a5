"""What there is to read: default dumps, font files, downloads, and a report of missing sources."""

from __future__ import annotations

import time
import urllib.request
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import fonts
from .files import spec

#: Fixed: names of default dumps, and addresses of public ones.
PATTERNS = ("*wiki-latest-pages-articles*.xml.bz2", "*wiki-latest-pages-articles*.xml")
DUMPS = {
    "fawiki": "https://dumps.wikimedia.org/fawiki/latest/fawiki-latest-pages-articles1.xml-p1500001p3000000.bz2",
    "ckbwiki": "https://dumps.wikimedia.org/ckbwiki/latest/ckbwiki-latest-pages-articles.xml.bz2",
    "kuwiki": "https://dumps.wikimedia.org/kuwiki/latest/kuwiki-latest-pages-articles.xml.bz2",
    "enwiki": "https://dumps.wikimedia.org/enwiki/latest/enwiki-latest-pages-articles1.xml-p1p1000.bz2",
    "arwiki": "https://dumps.wikimedia.org/arwiki/latest/arwiki-latest-pages-articles1.xml-p1p1000.bz2",
}
SHOWN = 20


def default_sources(folder: str) -> list[str]:
    """path:type of the dumps in a folder, each file once; none if there is no such folder."""
    found = dict.fromkeys(str(p.resolve()) for pattern in PATTERNS for p in sorted(Path(folder).glob(pattern)))
    return [f"{p}:wikipedia" for p in found]


def availability(sources: list[str]) -> tuple[list[str], list[str]]:
    """(present, missing) of path:type."""
    here = [s for s in sources if Path(spec(s)[0]).exists()]
    return here, [s for s in sources if s not in here]


def report(sources: list[str]) -> str:
    here, gone = availability(sources)
    lines = [f"sources present: {len(here)}, missing: {len(gone)}"]
    lines += [f"  {word} {s}" for word, some in (("missing", gone), ("present", here)) for s in some[:SHOWN]]
    return "\n".join(lines)


def download(name: str, folder: str, url: str | None = None, said: float = 2.0) -> str:
    """A dump by its code or address into the folder, by way of a partial file, telling how far it is each `said` seconds; one that is there and not empty is left alone."""
    url = url or DUMPS.get(name, name)
    if urlparse(url).scheme not in ("http", "https", "file"):
        raise ValueError(f"unknown dump {name!r}; known: {', '.join(DUMPS)}")
    target = Path(folder) / Path(urlparse(url).path).name
    if target.exists() and target.stat().st_size:
        print(f"{target} is there, {target.stat().st_size:,} bytes", flush=True)
        return str(target)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    request = urllib.request.Request(url, headers={"User-Agent": "glyphloom/1"})
    began = last = time.monotonic()
    with urllib.request.urlopen(request, timeout=60) as source, part.open("wb") as out:
        whole, done = int(source.headers.get("Content-Length") or 0), 0
        while data := source.read(8 << 20):
            out.write(data)
            done += len(data)
            if (now := time.monotonic()) - last >= said:
                last = now
                share = f" of {whole:,} ({100 * done / whole:.1f} %)" if whole else ""
                print(f"{target.name}: {done:,}{share} bytes, {done / (now - began) / (1 << 20):.2f} MiB/s", flush=True)
    part.replace(target)
    print(f"{target}: {done:,} bytes", flush=True)
    return str(target)


#: Fixed: suffixes of font files, those of fonts for the web, and where the system keeps its own.
SUFFIXES, WEB_SUFFIXES = ("ttf", "otf", "ttc", "otc"), ("woff", "woff2")
SYSTEM = ("C:/Windows/Fonts", "/mnt/c/Windows/Fonts")


def system_folders() -> list[str]:
    return [f for f in SYSTEM if Path(f).exists()]


def judged_fonts(spark: SparkSession, folders: list[str], distinct: bool = True, grouped: bool = True, include: str | None = None, exclude: str | None = None, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(family, path, fate) of the files below folders that exist; fate: accepted, or why not (suffix, duplicate, include, exclude). Files of the same content are one, unless `distinct` is off; families go by name, or each file is its own, numbered where names collide."""
    out = None
    for folder in folders:
        if not Path(folder).is_dir():
            print(f"no font folder {folder}")
            continue
        read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        rows = read.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), F.col("length").alias("size"), "content")
        rows = rows.withColumn("short", F.expr("substring(path, {} + 2)".format(len(str(Path(folder).resolve())))))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no font folders")
    known = F.lower("path").rlike(rf"\.({'|'.join(suffixes)})\z")
    out = out.withColumn("known", known).withColumn("identity", F.when(F.col("known"), fonts.identity(F.col("size"), F.col("content")))).drop("content", "size").distinct()
    own = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace("short", r"\.[^./]*\z", "")), "[^0-9a-z_-]+", "_"), "^_+|_+$", "")
    out = out.withColumn("family", fonts.family_key(F.col("short")) if grouped else F.when(own == "", "font").otherwise(own))
    fate = F.when(~F.col("known"), "suffix")
    if distinct:
        first = Window.partitionBy("identity", "known").orderBy("path")  # files of one content
        out = out.withColumn("n", F.row_number().over(first))
        fate = fate.when(F.col("n") > 1, "duplicate")
    fate = fate.when(~fonts.matches(F.col("family"), F.col("path"), include), "include") if include else fate
    fate = fate.when(fonts.matches(F.col("family"), F.col("path"), exclude), "exclude") if exclude else fate
    out = out.withColumn("fate", fate.otherwise("accepted"))
    if not grouped:
        again = F.row_number().over(Window.partitionBy("family", "fate").orderBy("path")) - 1
        out = out.withColumn("again", again).withColumn("family", F.when((F.col("fate") == "accepted") & (F.col("again") > 0), F.concat("family", F.format_string("_%04d", "again"))).otherwise(F.col("family")))
    return out.select("family", "path", "fate")


def font_counts(judged: DataFrame) -> DataFrame:
    """One row: files, duplicates, include_skipped, exclude_skipped, accepted, families."""
    n = lambda fate: F.count_if(F.col("fate") == fate)
    return judged.agg(F.count("*").alias("files"), n("duplicate").alias("duplicates"), n("include").alias("include_skipped"), n("exclude").alias("exclude_skipped"), n("accepted").alias("accepted"), F.count_distinct(F.when(F.col("fate") == "accepted", F.col("family"))).alias("families"))


def font_files(spark: SparkSession, folders: list[str], distinct: bool = True, grouped: bool = True, include: str | None = None, exclude: str | None = None, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(family, path) of the accepted font files below folders."""
    return judged_fonts(spark, folders, distinct, grouped, include, exclude, suffixes).where("fate = 'accepted'").select("family", "path")
