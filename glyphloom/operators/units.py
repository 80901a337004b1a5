"""Documents to text units, line numbers, interleaving, splits and resuming."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions import text as T
from ..functions.draws import SEED, batched, drawn, numpy_words_drawn, uniform

#: Fixed: of each unit, words least, most and most likely, and characters least and most.
UNITS = {"line": (1, 34, 18, 6, 260), "phrase48": (2, 10, 5, 16, 48), "short_phrase": (1, 6, 3, 8, 32), "word": (1, 1, 1, 2, 24)}
PARAGRAPH_LEAST = 4
#: Bytes of texts that are cut at a time.
PIECE = 1 << 20
_PARAGRAPH = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{int(m[1], 16):04x}", T.PARAGRAPH))


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset: a temporary one under a local master; a cluster has to name one that all share."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
        if not folder and (not master.startswith("local") or master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="glyphloom-"))
    return spark.sparkContext.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with files in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As checkpoint, but in columns: compressed, and a query reads only those that it needs. The table goes when Python ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_drop, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # Spark may be gone
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, para_idx, paragraph): pieces of at least four characters; columns to keep follow the key."""
    cut = docs.select(key, *keep, F.posexplode(F.split(text, T.PARAGRAPH)).alias("para_idx", "paragraph"))
    return cut.withColumn("paragraph", T.strip(F.col("paragraph"))).where(F.length("paragraph") >= PARAGRAPH_LEAST)


def units(docs: DataFrame, unit: str | tuple[int, ...] = "line", script: str = "any", seed: int = SEED, key: str = "doc_id", keep: tuple[str, ...] = (), texts: bool = True) -> DataFrame:
    """(doc_id, para_idx, unit_idx, text, n_words, n_chars): consecutive words of each paragraph, as many as drawn; units out of the bounds of length or script are dropped, and the numbers of the others stay. Python cuts them, a piece of about PIECE characters at a time, so that draws are made together. Without texts (which a script needs), units are found just so, but theirs aren't put together."""
    bounds = UNITS[unit] if isinstance(unit, str) else unit
    rows = named(docs, key, *keep)
    own = [(c, StringType() if c == "text" else IntegerType()) for c in ("para_idx", "unit_idx", "text", "n_words", "n_chars") if texts or c != "text"]
    schema = StructType([*(docs.schema[c] for c in (key, *keep)), *(StructField(c, kind) for c, kind in own)])

    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batches):
            doc, *found = _cut(part.column("__name").to_pylist(), part.column("__text").to_pylist(), bounds, seed, texts)
            yield pa.RecordBatch.from_arrays([*(part.column(i).take(pa.array(doc)) for i in range(1 + len(keep))), *found], names=names)

    cut = rows.mapInArrow(run, schema)
    return cut if script == "any" else cut.where(T.passes_script(F.col("text"), script))


def _cut(names: list[bytes | None], texts: list[bytes | None], bounds: tuple[int, ...], seed: int, wanted: bool = True) -> tuple:
    """(row, para_idx, unit_idx, text, n_words, n_chars) of the units of texts, in order; without text unless it is wanted."""
    low, high, mode, least, most = bounds
    words, sizes, docs, paras = [], [], [], []
    for i, text in enumerate(texts):
        for k, p in enumerate(_PARAGRAPH.split(text.decode("utf-8", "surrogateescape")) if text is not None else ()):
            p = p.strip()
            if len(p) >= PARAGRAPH_LEAST:
                w = p.split()
                words += w
                sizes.append(len(w))
                docs.append(i)
                paras.append(k)
    size, doc, para = np.array(sizes, np.int64), np.array(docs, np.int64), np.array(paras, np.int64)
    if high == 1:
        k, of = _within(size)
        pos, n = k, np.ones(len(words), np.int64)
    else:
        heads = [b"%d|" % seed + (b"%s/%d/" % (names[i], p) if names[i] is not None else b"%d/" % p) for i, p in zip(docs, paras)]
        longest = max([64, *map(len, heads)])
        lengths = np.fromiter(map(len, heads), np.int64, len(heads))
        prefixes = np.frombuffer(b"".join(h.ljust(longest, b"\0") for h in heads), np.uint8).reshape(-1, longest)
        done = []
        # most paragraphs end within a few draws more than they take on average; the others are drawn anew as far as they can go
        some = np.minimum(-(-size // low), size * 3 // (low + high + mode) * 5 // 4 + 4)
        todo = np.arange(len(size))
        for draws in (some, -(-size // low)):
            k, of = _within(draws[todo])
            of = todo[of]
            n = numpy_words_drawn(drawn(prefixes, lengths, k, ("unit",), of)[0], low, high, mode)
            before = np.cumsum(n) - n
            pos = before - before[k == 0][np.cumsum(k == 0) - 1] if len(k) else before
            last = np.zeros(len(size), np.int64)
            np.maximum.at(last, of, pos + n)
            short = last < size
            short[np.setdiff1d(np.arange(len(size)), todo)] = False
            good = (pos < size[of]) & ~short[of]
            done.append((of[good], k[good], pos[good], n[good]))
            todo = np.flatnonzero(short)
            if not len(todo):
                break
        of, k, pos, n = (np.concatenate(x) for x in zip(*done))
        if len(done) > 1:
            order = np.lexsort((k, of))
            of, k, pos, n = of[order], k[order], pos[order], n[order]
        n = np.minimum(n, size[of] - pos)
    start = (np.cumsum(size) - size)[of] + pos
    before = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
    chars = before[start + n] - before[start] + n - 1
    fits = np.flatnonzero((chars >= least) & (chars <= most))
    of, start, n = of[fits], start[fits], n[fits]
    found = [pa.array(para[of], pa.int32()), pa.array(k[fits], pa.int32()), pa.array(n, pa.int32()), pa.array(chars[fits], pa.int32())]
    if wanted:
        joined = [" ".join(words[a:b]) for a, b in zip(start.tolist(), (start + n).tolist())]
        try:
            column = pa.array(joined, pa.string())
        except UnicodeEncodeError:  # bytes that are no UTF-8 stay as they are
            column = pa.array([x.encode("utf-8", "surrogateescape") for x in joined], pa.binary()).view(pa.string())
        found.insert(2, column)
    return doc[of], *found


def _within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from 0 within each of so many, and of which they are."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - (np.cumsum(sizes) - sizes)[of], of


def with_line_ids(rows: DataFrame, *order: str, name: str = "line_id") -> DataFrame:
    """Numbers rows from 0 in that order, without bringing them to one task: sorted in ranges, with the number of rows in the ranges before added."""
    return numbered(rows.repartitionByRange(*order).sortWithinPartitions(*order), name)


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """Numbers rows as they stand: partition after partition. What the partitions before hold is a table with a row for each, which is broadcast."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(ordered.withColumn("__place", place).withColumn("__part", F.spark_partition_id()))
    counts = placed.groupBy(F.col("__part").alias("p")).agg(F.count("*").alias("n")).collect()  # a row for each partition
    before, total = [], 0
    for p, n in sorted((r.p, r.n) for r in counts):
        before.append((p, total))
        total += n
    offsets = F.broadcast(ordered.sparkSession.createDataFrame(before, "__part int, __before long"))
    return placed.join(offsets, "__part").withColumn(name, F.col("__place") + F.col("__before")).drop("__part", "__place", "__before")


def numbered_units(docs: DataFrame, unit: str | tuple[int, ...] = "line", script: str = "any", seed: int = SEED, key: str = "doc_id", order: str | None = None, keep: tuple[str, ...] = (), columns: tuple[str, ...] | None = None) -> DataFrame:
    """units with line_id, by document (or its `order`), paragraph and unit. Documents and not units go into ranges, so units are cut once; those of a document, or of rows that share a key, stay in one range. Documents are sorted first, so that units come in order but for keys that repeat. Of the units only `columns` are stored and returned (None: all), as a table of all their texts takes longer to write than to number."""
    if columns is not None and not keep and order in (None, key) and script == "any" and {*columns} <= {key, "para_idx", "unit_idx"}:
        listed = stored(_listed(docs, UNITS[unit] if isinstance(unit, str) else unit, seed, key))
        each = listed.repartitionByRange(key).sortWithinPartitions(key).select(key, F.explode(F.arrays_zip("para_idx", "unit_idx")).alias("__unit")).select(key, "__unit.*")
        return numbered(each.sortWithinPartitions(key, "para_idx", "unit_idx").select(*columns), "line_id")
    order = order or key
    more = tuple(c for c in dict.fromkeys((order, *keep)) if c != key)
    cut = units(docs.select(key, *more, "text").repartitionByRange(order, key).sortWithinPartitions(order, key), unit, script, seed, key, more, columns is None or "text" in columns or script != "any")
    ordered = cut.sortWithinPartitions(*dict.fromkeys([order, key, "para_idx", "unit_idx"]))
    return numbered(ordered if columns is None else ordered.select(*columns), "line_id")


def spread(docs: DataFrame, *by: str) -> DataFrame:
    """Rows as they are stored, if their partitions are much alike; else they are dealt anew by these columns, so that the work on a table of one row group is shared. To count the rows takes no columns."""
    sizes = [r.n for r in docs.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()]  # a row for each partition
    return docs.repartition(*by) if sizes and max(sizes) * docs.sparkSession.sparkContext.defaultParallelism > 2 * sum(sizes) else docs


def line_numbers(docs: DataFrame, unit: str | tuple[int, ...] = "line", script: str = "any", seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """(line_id) of numbered_units, for what needs no more of them: lines are numbered from 0 without gaps, so these are the numbers below the number of units. All texts are cut to tell it; no row is moved, sorted or stored."""
    spark = docs.sparkSession
    rows = spread(docs.select(key, "text"), key, "text")
    if script != "any":
        n = units(rows, unit, script, seed, key).count()
    else:
        bounds = UNITS[unit] if isinstance(unit, str) else unit
        n = named(rows, key).mapInArrow(counting(bounds, seed), "n long").agg(F.sum("n").alias("n")).first().n or 0
    return spark.range(0, n, 1, max(spark.sparkContext.defaultParallelism, n >> 21)).withColumnRenamed("id", "line_id")


def named(docs: DataFrame, key: str, *keep: str) -> DataFrame:
    """Key, columns to keep, and in bytes the name by which a document's draws are made and its text."""
    return docs.select(key, *keep, F.col(key).cast("string").cast("binary").alias("__name"), F.col("text").cast("binary").alias("__text"))


def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """About PIECE bytes of texts at a time."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column("__text")), 0)).astype(np.int64)
        piece = (np.cumsum(sizes) - sizes) // PIECE
        ends = np.flatnonzero(np.diff(piece)) + 1 if len(piece) else []
        for low, high in zip([0, *ends], [*ends, batch.num_rows]):
            yield batch.slice(low, high - low)
    pa.default_memory_pool().release_unused()  # the worker lives on


def _listed(docs: DataFrame, bounds: tuple[int, ...], seed: int, key: str) -> DataFrame:
    """A row for each document with the numbers of its units' paragraphs and of the units in them: what has to be moved if texts aren't needed."""
    schema = StructType([docs.schema[key], *(StructField(c, ArrayType(IntegerType(), False)) for c in ("para_idx", "unit_idx"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batches):
            doc, *found = _cut(part.column("__name").to_pylist(), part.column("__text").to_pylist(), bounds, seed, False)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=part.num_rows))]), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.ListArray.from_arrays(ends, x) for x in found[:2])], names=schema.names)

    return named(spread(docs.select(key, "text"), key, "text"), key).mapInArrow(run, schema)


def counting(bounds: tuple[int, ...], seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_pieces(batches):
            n = len(_cut(part.column("__name").to_pylist(), part.column("__text").to_pylist(), bounds, seed, False)[0])
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return run


def interleave(docs: DataFrame, source: str = "source", key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Adds arrival: documents of each source keep their order, and the next one comes from any source that has some left, all alike.

    Each source is a Poisson process of the same rate: a document's time is the sum of exponential gaps of its source up to it. A source that holds many rows is summed up in ranges of them, each in its own task, and what the ranges before add up to is joined.
    """
    gap = -F.log(F.lit(1.0) - uniform(F.col(key), "gap", seed))
    ranged = checkpoint(docs.withColumn("__gap", gap).repartitionByRange(source, key).withColumn("__p", F.spark_partition_id()))
    sums = ranged.groupBy(source, "__p").agg(F.sum("__gap").alias("s"))  # at most a row for each source and range
    before = Window.partitionBy(source).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(source).alias("__source"), F.col("__p").alias("__range"), F.coalesce(F.sum("s").over(before), F.lit(0.0)).alias("__before"))
    own = Window.partitionBy(source, "__p").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumn("__own", F.sum("__gap").over(own)).join(sums, F.col(source).eqNullSafe(F.col("__source")) & (F.col("__p") == F.col("__range")))
    return out.withColumn("arrival", F.col("__before") + F.col("__own")).drop("__gap", "__p", "__source", "__range", "__before", "__own")


def split_exact(lines: DataFrame, count: int, seed: int = SEED) -> DataFrame:
    """Adds split: val for the `count` lines with the smallest draws."""
    chosen = lines.select(F.col("line_id").alias("__id"), batched(F.col("line_id"), "val", seed).alias("u")).orderBy("u", "__id").limit(count).select("__id", F.lit("val").alias("__val"))
    out = lines.join(chosen, lines.line_id == F.col("__id"), "left")
    return out.withColumn("split", F.coalesce("__val", F.lit("train"))).drop("__id", "__val")


def split_ratio(lines: DataFrame, ratio: float, seed: int = SEED) -> DataFrame:
    return lines.withColumn("split", F.when(batched(F.col("line_id"), "split", seed) < ratio, "val").otherwise("train"))


def shuffled_words(c: Column, key: Column, seed: int = SEED) -> Column:
    """Words in a drawn order within each line; empty lines go, the others are joined by empty ones."""
    lines = F.transform(F.split(c, "\n"), lambda p, i: F.array_join(F.transform(F.array_sort(F.transform(T.words(p), lambda w, j: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), i.cast("string"), j.cast("string"))).alias("h"), w.alias("w")))), lambda x: x["w"]), " "))
    return F.array_join(F.filter(lines, lambda p: p != ""), "\n\n")


def first_of_each(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key: exact dedup."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")


def remaining(lines: DataFrame, written: DataFrame) -> DataFrame:
    """Lines that are not in the output yet, gaps included."""
    return lines.join(written.select("line_id"), "line_id", "left_anti")


def output_state(metadata: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row (metadata_rows, manifest_rows, max_line_id): metadata are JSON lines, of which broken ones don't count; manifest lines that are blank don't either."""
    parsed = metadata.select(F.try_parse_json("value").alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    ids = parsed.select(F.try_variant_get("v", "$.line_id", "long").alias("line_id"))
    rows = manifest.where(T.strip(F.col("value")) != "").agg(F.count("*").alias("manifest_rows"))
    state = ids.agg(F.count("*").alias("metadata_rows"), F.coalesce(F.max("line_id"), F.lit(-1).cast("long")).alias("max_line_id"))
    return state.withColumn("manifest_rows", F.lit(rows.first().manifest_rows))


def drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """(name, old, new) of options (name, value) that differ or that one side lacks."""
    o, n = old.select("name", F.col("value").alias("old")), new.select("name", F.col("value").alias("new"))
    return o.join(n, "name", "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
