"""Approximate nearest neighbours by an inverted multi-index.

Vectors are split in two halves, each half is quantised by its own k-means, and a pair of centroids is a cell. A query visits cells in the order of summed distance (the negative inner product of each half with its centroid), found with a heap over the two sorted lists, until the cells visited hold a share of the index; their entries are reranked with exact inner products in double precision.

Fit, on bounded samples with the smallest hashes: codebooks on up to PER_CENTROID vectors a centroid, whose number grows with the fourth root of the entries up to MOST_CENTROIDS; and the share, such that CHECKED queries, each compared with all entries, find RECALL of their true neighbours. Every vector is indexed. Vectors that are equal are one entry that lists its smallest ids: TOP + 1 of them, which is all that TOP results of any query can need. Queries that are equal are searched once.

Cells are packed into blocks of at most BLOCK entries (a larger cell is dealt out by hash), so that no key holds an unbounded group. A query is sent to the blocks that hold cells it visits, with the sum that its last cell has and not with a list of cells. A task holds one block and streams the queries of one group past it; beyond QUERIES queries there are several groups, and each block is read by each of them. Searches go in two turns: the nearest cells, which hold FIRST of the share, give each query the score that an entry of any other cell has to reach, and so the second turn returns next to nothing that isn't a result.

Vectors that are null, zero, of the wrong length (the most frequent one counts), or that hold null or non-finite components take no part, as queries or candidates. Ties go to the smaller vec_id. Every row is a candidate and, if its vec_id is divisible, a query; rows that share a vec_id are candidates of each other. Fewer candidates than TOP: all are returned. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import checkpoint, table

LEAST_CENTROIDS, MOST_CENTROIDS, PER_CENTROID, ROUNDS = 16, 512, 128, 12
TOP, EVERY, BLOCK, QUERIES = 20, 20, 65_536, 262_144
CHECKED, RECALL, FIRST = 64, 0.96, 1 / 16


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part, as arrays of float if that is their type, else of double."""
    kind = vectors.schema[column].dataType
    v = F.col(column).cast("array<float>" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.coalesce(fine, F.lit(False)) & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == sizes[0].n) if sizes else rows.limit(0)


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids from evenly spaced starting rows; a centroid without rows stays where it is."""
    k = max(1, min(k, len(x)))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        sums, n = np.zeros_like(c), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def centroids(entries: int) -> int:
    """A power of two near sqrt(entries) / 4: some 16 entries a cell, until MOST_CENTROIDS."""
    return min(MOST_CENTROIDS, max(LEAST_CENTROIDS, 1 << round(math.log2(max(1.0, math.sqrt(entries) / 4)))))


class Index:
    """Codebooks of both halves, the number of entries of each cell, and the blocks that cells lie in."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = max(1, sample.shape[1] // 2)
        self.left, self.right = kmeans(sample[:, : self.half], k), kmeans(sample[:, self.half :], k) if sample.shape[1] > 1 else np.zeros((1, 0))
        self.sizes = np.zeros((len(self.left), len(self.right)), np.int64)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = lambda y, c: np.argmin((c * c).sum(1) - 2 * y @ c.T, axis=1)
        return near(x[:, : self.half], self.left), near(x[:, self.half :], self.right)

    def sums(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the distances of both halves to all centroids; a cell's is their sum. In single precision, so that they don't depend on how many queries are multiplied at a time."""
        return tuple(-(x @ c.T).astype(np.float32).astype(np.float64) for x, c in ((q[:, : self.half], self.left), (q[:, self.half :], self.right)))

    def visit(self, a: np.ndarray, b: np.ndarray, least: tuple[int, ...]) -> list[float]:
        """The sums of the last cells that one query has to visit to meet each number of entries, ascending: the multi-sequence algorithm."""
        i, j = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        x, y, sizes = a[i].tolist(), b[j].tolist(), self.sizes[i][:, j].tolist()
        heap, up, n, out = [(x[0] + y[0], 0, 0)], [0] * len(x), 0, []
        while heap and len(out) < len(least):
            at, r, c = heapq.heappop(heap)
            n += sizes[r][c]
            while len(out) < len(least) and n >= least[len(out)]:
                out.append(at)
            up[r] = c + 1  # cells of a row are visited from left to right: a cell comes up when those above and left of it were visited
            if r + 1 < len(x) and up[r + 1] == c:
                heapq.heappush(heap, (x[r + 1] + y[c], r + 1, c))
            if c + 1 < len(y) and (r == 0 or up[r - 1] > c + 1):
                heapq.heappush(heap, (x[r] + y[c + 1], r, c + 1))
        return out + [math.inf] * (len(least) - len(out))

    def pack(self, most: int) -> None:
        """Deals cells to blocks in order: first (block of a cell) and parts (how many blocks it is dealt to)."""
        flat = self.sizes.ravel()
        self.parts = np.maximum(1, -(-flat // most))
        first, at, held = [], 0, 0
        for n, parts in zip(flat.tolist(), self.parts.tolist()):
            if held and held + n > most:
                at, held = at + 1, 0
            first.append(at)
            at, held = (at + parts, 0) if parts > 1 else (at, held + n)
        self.first = np.array(first)


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow column of equally long arrays, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _sample(rows: DataFrame, n: int) -> np.ndarray:
    """The n vectors with the smallest hashes."""
    got = rows.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(n).select("v").toArrow()
    return _matrix(got["v"])


def _needed(placed: DataFrame, asked: DataFrame, index: Index, top: int, checked: int, recall: float) -> float:
    """The share of the index to visit, so that `checked` queries find `recall` of their true neighbours: those are compared with all entries, of which each task keeps the `top` best for each."""
    q = _sample(asked, checked)
    if not len(q):
        return 1.0
    shared = placed.sparkSession.sparkContext.broadcast((q, index))

    def run(batches):
        q, index = shared.value
        a, b = index.sums(q)
        best = [np.full((len(q), 1), -np.inf), np.zeros((len(q), 1))]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, cells = _matrix(batch.column(0)), batch.column(1).to_numpy()
            scores = q @ x.T
            own, spots = np.nonzero(x[:, 0][None] == q[:, 0][:, None])
            same = (x[spots] == q[own]).all(1)
            scores[own[same], spots[same]] = -np.inf  # the query itself
            at = a[:, cells // len(index.right)] + b[:, cells % len(index.right)]
            scores, at = np.hstack([best[0], scores]), np.hstack([best[1], at])
            keep = np.argpartition(-scores, min(top, scores.shape[1]) - 1, axis=1)[:, :top]
            best = [np.take_along_axis(scores, keep, 1), np.take_along_axis(at, keep, 1)]
        rows, spots = np.nonzero(best[0] > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(best[0][rows, spots]), pa.array(best[1][rows, spots])], ["q", "score", "at"])

    found = placed.select("v", "cell").mapInArrow(run, "q long, score double, at double")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "at")
    found = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= top).select("q", "at").toPandas()  # checked * top rows
    a, b = index.sums(q)
    need, total = [], int(index.sizes.sum())
    for row, at in found.groupby("q")["at"]:
        sums = (a[row][:, None] + b[row][None]).ravel()
        order = np.argsort(sums)
        before = np.concatenate([[0], np.cumsum(index.sizes.ravel()[order])])
        need += (before[np.searchsorted(sums[order], at.to_numpy(), "right")] / total).tolist()
    return min(1.0, float(np.quantile(need, recall, method="higher"))) if need else 1.0


def search(vectors: DataFrame, every: int = EVERY, top: int = TOP, k: int | None = None, share: float | None = None, block: int = BLOCK, queries: int = QUERIES, checked: int = CHECKED, recall: float = RECALL) -> DataFrame:
    """For each row whose vec_id is divisible by `every`, its `top` best others: (query_id, rank, vec_id, score). share: None to fit it."""
    spark, rows = vectors.sparkSession, usable(vectors)
    vector = rows.schema["v"].dataType.simpleString()
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("n", first).where(F.col("n") <= top + 1)  # cut to top + 1 of each vector in every task before the shuffle
    entries = checkpoint(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    total = entries.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    k = k or centroids(total)
    index = Index(_sample(entries, PER_CENTROID * k), k)
    shared = spark.sparkContext.broadcast(index)

    def place(batches):
        for b in batches:
            if b.num_rows:
                i, j = shared.value.cells(_matrix(b.column(0)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((i * len(shared.value.right) + j).astype(np.int32))], ["v", "ids", "cell"])

    placed = entries.mapInArrow(place, f"v {vector}, ids array<long>, cell int")
    counts = placed.groupBy("cell").count().toPandas()  # at most k * k rows
    index.sizes.ravel()[counts["cell"].to_numpy()] = counts["count"].to_numpy()
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(F.count("*").alias("copies"))
    distinct = checkpoint(asked.select("v").distinct().select(F.monotonically_increasing_id().alias("query"), "v"))
    n_queries = distinct.count()
    if share is None:
        share = _needed(placed, distinct, index, top, checked, recall)
    least = max(top + 1, math.ceil(share * total))
    near = max(top + 1, math.ceil(share * FIRST * total))
    index.pack(min(block, max(1024, total // 32)))
    full = spark.sparkContext.broadcast(index)
    groups = max(1, -(-n_queries // queries))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)  # small rows but long work: not to be put together by size

    def home(batches):
        for b in batches:
            cells, h = b.column(2).to_numpy(), b.column(3).to_numpy()
            at = full.value.first[cells] + h % full.value.parts[cells]
            for g in range(groups):
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.full(len(at), g, np.int32)), pa.nulls(len(at), pa.int64()), b.column(0), b.column(1), b.column(2), *(pa.nulls(len(at), pa.float64()) for _ in range(3))], names)

    names = ["block", "g", "query", "v", "ids", "cell", "low", "high", "bound"]
    schema = f"block int, g int, query long, v {vector}, ids array<long>, cell int, low double, high double, bound double"
    homes = placed.select("v", "ids", "cell", F.pmod(F.xxhash64("v"), F.lit(1 << 30))).mapInArrow(home, schema)

    def limits(batches):
        for b in batches:
            if b.num_rows:
                x, y = full.value.sums(_matrix(b.column(1)))
                found = np.array([full.value.visit(p, q, (near, least)) for p, q in zip(x, y)])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(found[:, i]) for i in (0, 1))], ["query", "v", "near", "far"])

    limited = checkpoint(distinct.repartition(tasks, "query").mapInArrow(limits, f"query long, v {vector}, near double, far double"))

    def routes(batches):
        """Rows (query, v, low, high, bound): to the blocks with cells whose sum s is low < s <= high."""
        flat, first, parts = full.value.sizes.ravel() > 0, full.value.first, full.value.parts
        for b in batches:
            if not b.num_rows:
                continue
            x, y = full.value.sums(_matrix(b.column(1)))
            low, high = b.column(2).to_numpy(), b.column(3).to_numpy()
            rows, to = [], []
            for row in range(len(x)):
                s = (x[row][:, None] + y[row][None]).ravel()
                cells = np.flatnonzero(flat & (s > low[row]) & (s <= high[row]))
                blocks = np.unique(first[cells])
                big = cells[parts[cells] > 1]
                if len(big):
                    blocks = np.unique(np.concatenate([blocks, *(np.arange(first[c], first[c] + parts[c]) for c in big)]))
                rows.append(np.full(len(blocks), row))
                to.append(blocks)
            at, to = pa.array(np.concatenate(rows)), np.concatenate(to)
            query = b.column(0).take(at)
            g = query.to_numpy() % groups
            for p in range(0, len(to), 10_000):
                few = slice(p, p + 10_000)
                n = len(to[few])
                yield pa.RecordBatch.from_arrays([pa.array(to[few].astype(np.int32)), pa.array(g[few].astype(np.int32)), query[few], b.column(1).take(at[few]), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int32()), *(b.column(i).take(at[few]) for i in (2, 3, 4))], names)

    def rerank(batches):
        """Streams rows sorted by block and group, entries before queries: (query, score, own, ids)."""
        now, held, x = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            key = b.column(0).to_numpy().astype(np.int64) * groups + b.column(1).to_numpy()
            asks = b.column(2).is_valid().to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (asks[1:] != asks[:-1])]))
            for p, e in zip(cut.tolist(), [*cut[1:].tolist(), len(key)]):
                if key[p] != now:
                    now, held, x = key[p], [], None
                if not asks[p]:
                    held.append(pa.table([b.column(i)[p:e] for i in (3, 4, 5)], ["v", "ids", "cell"]))
                elif held:
                    if x is None:
                        together = pa.concat_tables(held)
                        x, ids, cells = _matrix(together["v"]), together["ids"].to_pylist(), together["cell"].to_numpy()
                        norm = np.linalg.norm(x, axis=1).max()
                        known, spot = np.unique(cells, return_inverse=True)
                    for s in range(p, e, 256):
                        yield from compare(x, ids, norm, known, spot, b.slice(s, min(256, e - s)))

    def compare(x, ids, norm, known, spot, asks):
        query, q = asks.column(2).to_pylist(), _matrix(asks.column(3))
        low, high, bound = (asks.column(i).to_numpy()[:, None] for i in (6, 7, 8))
        a, b = full.value.sums(q)
        right = len(full.value.right)
        at = a[:, known // right] + b[:, known % right]
        scores = np.where(((at > low) & (at <= high))[:, spot], q @ x.T, -np.inf)
        rounding = 4 * x.shape[1] * np.finfo(float).eps * np.linalg.norm(q, axis=1, keepdims=True) * norm  # twice the bound of a sum of products, and more
        n = min(top + 1, len(x))
        cut = np.maximum(-np.partition(-scores, n - 1, axis=1)[:, n - 1 : n], bound) - rounding
        found = []
        for row in np.flatnonzero((scores >= cut).any(1)):
            spots = np.flatnonzero((scores[row] >= cut[row]) & (scores[row] > -np.inf))  # with all that tie at the cut
            exact = sorted(((math.fsum(q[row] * x[s]), s) for s in spots), key=lambda e: (-e[0], ids[e[1]]))
            found += [(query[row], score, bool((x[s] == q[row]).all()), ids[s]) for score, s in exact[: top + 1]]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.float64(), pa.bool_(), pa.list_(pa.int64())))], ["query", "score", "own", "ids"])

    def turn(asks: DataFrame) -> DataFrame:
        sent = asks.mapInArrow(routes, schema)
        both = homes.union(sent).repartition(tasks, "block", "g").sortWithinPartitions("block", "g", F.col("query").isNotNull())
        best = both.mapInArrow(rerank, "query long, score double, own boolean, ids array<long>")
        most = Window.partitionBy("query").orderBy(F.desc("score"), F.element_at("ids", 1))
        return best.withColumn("n", F.row_number().over(most)).where(F.col("n") <= top + 1).drop("n")

    open_ = F.lit(-math.inf)
    one = checkpoint(turn(limited.select("query", "v", open_.alias("low"), F.col("near").alias("high"), open_.alias("bound"))))
    bounds = one.groupBy("query").agg(F.when(F.sum(F.size("ids")) > top, F.min("score")).otherwise(open_).alias("bound"))
    later = limited.where("near < far").join(bounds, "query", "left").select("query", "v", F.col("near").alias("low"), F.col("far").alias("high"), F.coalesce("bound", open_).alias("bound"))
    found = one.union(turn(later)).groupBy("query").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "own", "ids")).alias("found"))  # at most twice top + 1 entries
    flat = F.array_sort(F.flatten(F.transform("found", lambda e: F.transform(e["ids"], lambda i: F.struct(e["s"].alias("s"), i.alias("vec_id"), e["own"].alias("own"))))))
    mine = asked.join(distinct, "v").select("vec_id", "query", "copies").join(found.select("query", F.slice(flat, 1, 2 * top + 2).alias("found")), "query")
    itself = F.array_position(F.transform("found", lambda e: e["own"] & (e["vec_id"] == F.col("vec_id"))), True)
    mine = mine.withColumn("itself", itself).select(F.col("vec_id").alias("query_id"), "copies", F.slice(F.filter("found", lambda e, i: i != F.col("itself") - 1), 1, top).alias("found"))
    mine = mine.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return mine.select("query_id", F.posexplode("found").alias("at", "e")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), (-F.col("e.s")).alias("score"))


def query(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
