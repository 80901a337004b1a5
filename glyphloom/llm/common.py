"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space, as bytes.split() cuts them.
WORD = r"[^\x20\x09-\x0D]+"
CACHE = 100_000
#: Rows that Python takes at a time.
BATCH = 1000

U64 = np.uint64
_A, _B = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_M = U64(0x9E3779B97F4A7C15)
_S = U64(33)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column="text"):
    """The text as UTF-8 bytes, empty for null."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def pieces(batches, rows: int = BATCH):
    """Record batches of at most `rows` rows, without copying: Spark bounds a batch by bytes (64 MB) and rows, and Python objects made of short rows take more than those."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)
    batch = None
    pa.default_memory_pool().release_unused()  # the worker lives on


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of df has, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str):
    """A column by its name, which may hold dots or back quotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset: a temporary one under a local master, as in tests; a cluster has to name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="glyphloom-")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with files in the shared folder. While they are written, Python workers get at most BATCH rows at a time, whatever bytes they may have: they are kept by Spark with the memory that they once took. The session's own setting is put back."""
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    before = spark.conf.get(name)
    if not 0 < int(before) <= BATCH:
        spark.conf.set(name, str(BATCH))
    try:
        return df.checkpoint()
    finally:
        spark.conf.set(name, before)


class WordHashes:
    """64-bit hashes of words. None are kept: to look a word up takes longer than to hash it."""

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> _S)
    x = x * _A
    x = x ^ (x >> _S)
    x = x * _B
    return x ^ (x >> _S)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive words, in order."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    acc = np.zeros(n, U64)
    for i in range(k):
        acc = acc * _M + hashes[i : i + n]
    return mix(acc)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def groups(rows, keys: list[str]):
    """Cuts record batches that are sorted by keys into one table for each combination of key values; keeps one group in memory."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in rows:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            now = tuple(c[a] for c in columns)
            if held and now != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield last, pa.Table.from_batches(held)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (a, b: long) as (node, component), component being the smallest node.

    Alternates the large-star and small-star steps; every step only groups with a minimum and joins, so that no node's neighbours are ever collected, and ends when a round changes nothing. Where a node has neighbours beyond count, its rows are two numbers each and are summed up before the shuffle; the join that hands them their minimum is dealt anew by Spark if it is skewed. An edge with a null end or from a node to itself is dropped; a node without other edges isn't returned.
    """
    links = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        links = checkpoint(small)
        row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (row.n, row.h) == before:
            break
        before = (row.n, row.h)
    members = links.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    return members.union(members.select(F.col("component").alias("node"), "component").distinct())
