"""Mixing sources to target weights: DataFrame functions only.

Sizes are word counts. Sources are ranked by code point with null last and weighted in a repeating cycle; the mix has a share of all words. No source gets more than `most` times its own words: what it can't take goes to the others by weight. The level at which this settles is found in closed form: sources ordered by (cap / weight) saturate in that order, so the level is the first (total - saturated caps) / (weight of the rest) that its source's own ratio reaches; later ones that fit are lower, so it is their maximum. Only one row for each source goes through that window.

A document is emitted floor(rate) times, rate being target / words of its source, plus one more time if a hash of (seed, doc_id, text) falls below the fraction: reruns agree whatever the partitioning.

Null text: no words, emitted by the same rule. Null source: a source of its own, ranked last. Null doc_id: hashed as an empty string. Repeated rows: each is an own document with the same draw. Empty table: no rows. Columns of the documents keep their values whatever their names: working ones get names that no column has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, col, fresh, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 20240


def n_words(column="text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int) -> Column:
    """Uniform in [0, 1), from 52 bits of a hash."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """(source, size) of documents to one row (source, source_size, target, rate) for each source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(cycle, (rank % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.withColumn("level", level)
    per = per.withColumn("level", F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(everything))
    target = F.least(F.coalesce(F.col("weight") * F.col("level"), F.col("cap")), F.col("cap"))
    per = per.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(min(float(share), float(most))))
    return per.select("source", "source_size", "target", rate.alias("rate"))


def with_copies(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, seed=SEED, names: tuple[str, str, str, str] = ("size", "source_size", "target", "copies")) -> DataFrame:
    """Adds columns of these names to each document: its words, those of its source, the target of that, and how often the document is taken."""
    source, rate = fresh(docs, "mix_source", "mix_rate")
    size, source_size, target, copies = names
    targets = source_targets(docs.select("source", n_words().alias("size")), weights, share, most)
    targets = _small(targets.select(F.col("source").alias(source), F.col("source_size").alias(source_size), F.col("target").alias(target), F.col("rate").alias(rate)))
    taken = F.floor(rate) + F.when(draw(seed) < F.col(rate) - F.floor(rate), 1).otherwise(0)
    out = docs.join(targets, F.col("source").eqNullSafe(F.col(source)), "left").withColumn(copies, taken.cast("long"))
    return out.select(*map(col, docs.columns), n_words().alias(size), source_size, target, copies)


#: Sources up to which their targets are broadcast; beyond it Spark chooses the join.
BROADCAST_SOURCES = 100_000


def _small(targets: DataFrame) -> DataFrame:
    """Broadcasts the targets if there are few sources, which is counted with a limit first."""
    rows = targets.limit(BROADCAST_SOURCES + 1).collect()
    if len(rows) > BROADCAST_SOURCES:
        return targets
    return F.broadcast(targets.sparkSession.createDataFrame(rows, targets.schema))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as the mix takes them, with their own columns only."""
    names = fresh(docs, "mix_size", "mix_source_size", "mix_target", "mix_copies")
    taken = with_copies(docs, names=tuple(names), **options).where(F.col(names[3]) > 0)
    return taken.withColumn(names[0], F.explode(F.sequence(F.lit(1), F.col(names[3]).cast("int")))).select(*map(col, docs.columns))


def query(spark, sf_dir):
    out = with_copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


SQL = rf"""
WITH d AS (
  SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         source_size * {MOST}::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * {SHARE}::DOUBLE AS total
  FROM s
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER o, 0.0::DOUBLE)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0.0::DOUBLE)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight ASC, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), m AS (
  SELECT *, max(CASE WHEN level <= cap / weight THEN level END) OVER () AS settled FROM l
), t AS (
  SELECT source, source_size, least(coalesce(weight * settled, cap), cap) AS target FROM m
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, {MOST}::DOUBLE) ELSE {min(SHARE, MOST)}::DOUBLE END AS rate FROM t
), u AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.rate,
         ('0x' || substr(md5('{SEED}|' || coalesce(d.doc_id::VARCHAR, '') || '|' || coalesce(d.text, '')), 1, 13))::BIGINT / {2**52}.0::DOUBLE AS draw
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
), c AS (
  SELECT *, (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM u
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""
