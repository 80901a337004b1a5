"""N-gram Jaccard join with signature trees.

Sets of hashed word n-grams link when den * overlap >= num * union. The join is exact and never emits all pairs of a group:

1. Documents with equal sets are one class; links are sought between classes only.
2. Blocking loses no link. Sets are put in size classes, whose bounds grow by half; a set also enters the next class if a partner could be there. Two linked sets of a class differ in at most D elements. Elements are dealt by hash to D + T parts: then at least T parts hold the same in both, so that a set with fewer than T empty parts shares a part that is not empty (sets with T or more also emit their empty parts). Each part is a key. Keys are shuffled and sorted; a task reads each key's classes as a stream and ties them to the first one.
3. A signature tree is built over the classes tied to one first class, one size class at a time: its nodes hold the OR of their members' bitmaps and the range of their sizes. A dual traversal of node pairs drops those whose sizes don't match or whose largest possible overlap is too small, and those that are already known to be connected. Only bitmaps are shuffled here; what is left keeps passages that many documents share from tying these together.
4. Connected components of what is left are candidate groups. Their sets are brought together, a signature tree is built over each group in the same way, and pairs that its traversal leaves are compared element by element. In either step, groups of more than GROUP (BUNDLE) classes, ELEMENTS elements or MAP_BYTES of bitmaps are dealt to blocks, and each pair of blocks is a group of its own.
5. Components of the links found are the answer.

Null or empty text, or text without words: an empty set, linked with nothing, a component of its own. Fewer words than n: the whole sequence is the one element. Repeated rows: equal sets, linked. Null doc_id: takes part; a component's id is its smallest doc_id that isn't null. Empty table: no rows. Other columns are not read by the join; one_of_each returns them as they are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, WordHashes, checkpoint, col, components, fresh, grams, groups, mix, pieces, signed, table, utf8

N, NUM, DEN = 3, 90, 100
GROUP, BUNDLE = 4096, 32_768
#: Elements of the sets of a block, and bytes of the bitmaps of one: what a task holds is at most two blocks, however large the sets are.
ELEMENTS, MAP_BYTES = 4_000_000, 48 << 20
FAN = 16
#: Bits of a bitmap for each element, at least: of those that are shuffled, and of those that are not.
THIN, WIDE = 2, 8
_SALT = U64(0xD6E8FEB86659FD93)


def shingles(raw: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of the n-grams of the text's words, ASCII letters lower-cased."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, U64)
    found = hashes.of(words)
    if len(words) < n:
        return mix(grams(found, len(words)) + U64(len(words)))
    return np.unique(grams(found, n))


def set_hash(elements: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)


class Blocking:
    """Keys of sets, so that any two linked sets that differ share one."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        bounds = [1]
        while bounds[-1] < 1 << 40:
            bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
        self.bounds = np.array(bounds)

    def parts(self, size_class: int) -> tuple[int, int]:
        """D + T and T of a class: linked sets have overlap >= num / (num + den) * (a + b), so differ in at most (den - num) / (den + num) * (a + b)."""
        most = int(self.bounds[size_class + 1]) - 1
        d = (self.den - self.num) * 2 * most // (self.den + self.num)
        t = max(1, -(-d // 8))
        return (d + t, t) if d else (0, 0)

    def keys(self, elements: np.ndarray) -> np.ndarray:
        n = len(elements)
        if not n:
            return np.empty(0, U64)
        own = int(np.searchsorted(self.bounds, n, "right")) - 1
        classes = [own]
        while n * self.den // self.num >= self.bounds[classes[-1] + 1]:
            classes.append(classes[-1] + 1)
        out = []
        mixed = mix(elements ^ _SALT)
        high = mixed >> U64(32)
        for c in classes:
            parts, t = self.parts(c)
            if not parts:
                continue
            part = ((high * U64(parts)) >> U64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            at = part[order]
            starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            sums = np.add.reduceat(mix(mixed[order]), starts)
            which = at[starts].astype(U64)
            if parts - len(starts) >= t:
                empty = np.setdiff1d(np.arange(parts), at[starts]).astype(U64)
                sums, which = np.concatenate([sums, np.zeros(len(empty), U64)]), np.concatenate([which, empty])
            out.append(mix(sums ^ mix(which + U64(c << 40))))
        return np.concatenate(out) if out else np.empty(0, U64)


    def alike(self, sizes: np.ndarray):
        """Indices of sets by size class, with those of lower classes that could have a partner in it: linked sets are together in one of these."""
        own = np.searchsorted(self.bounds, sizes, "right") - 1
        for c in np.unique(own):
            found = np.flatnonzero((own == c) | (own < c) & (sizes * self.den // self.num >= self.bounds[c]))
            if len(found) > 1:
                yield found


class Union(dict):
    """Disjoint sets of numbers."""

    def find(self, x: int) -> int:
        root = x
        while self.get(root, root) != root:
            root = self[root]
        while self.get(x, x) != root:
            self[x], x = root, self[x]
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def width(n: int, per: int) -> int:
    """Bits of the bitmap of n elements, a power of two."""
    return max(1024, 1 << (n * per - 1).bit_length())


def bitmap(elements: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(bits, np.uint8)
    out[(elements & U64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(U64)


def folded(map_: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap at a smaller width."""
    return np.bitwise_or.reduce(map_.reshape(-1, bits // 64), axis=0)


class SignatureTree:
    """Nodes over sets in order of size: bitmaps (OR), smallest and largest size, level by level; FAN children each.

    With sets, pairs are linked if these are; without, if bitmaps and sizes allow it.
    """

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, num: int, den: int, sets: list[np.ndarray] | None = None):
        self.num, self.den = num, den
        self.ids = np.lexsort((maps[:, 0], sizes)).tolist()
        maps, sizes = maps[self.ids], sizes[self.ids].astype(np.int64)
        self.n = len(sizes)
        self.sets = sets and [sets[i] for i in self.ids]
        self.spare = sizes - np.bitwise_count(maps).sum(1)  # elements that share a bit
        self.levels, self.spares = [(maps, sizes, sizes)], [self.spare]
        while len(self.levels[-1][0]) > 1:
            maps, low, high = self.levels[-1]
            starts = np.arange(0, len(maps), FAN)
            self.spares.append(np.maximum.reduceat(self.spares[-1], starts))
            self.levels.append((np.bitwise_or.reduceat(maps, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))
        self.links = Union()
        self.compared = self.pruned = 0

    def _apart(self, level: int, a: int, b: int) -> bool:
        """Sizes that can't match."""
        _, low, high = self.levels[level]
        return high[a] * self.den < low[b] * self.num or high[b] * self.den < low[a] * self.num

    def _meet(self, level: int, a: int, right: np.ndarray) -> np.ndarray:
        """Whether a member of node a and one of each node of right can overlap enough, as far as OR bitmaps and sizes tell."""
        maps, low, high = self.levels[level]
        spare = self.spares[level]
        most = np.minimum(np.bitwise_count(maps[right] & maps[a]).sum(1).astype(np.int64) + np.minimum(spare[right], spare[a]), np.minimum(high[right], high[a]))
        return most * (self.num + self.den) >= self.num * (low[right] + low[a])

    def _one(self, level: int, a: int, b: int) -> bool:
        """All members of both nodes are known to be connected."""
        span = FAN**level
        roots = {self.links.find(i) for x in ((a, b) if a != b else (a,)) for i in range(x * span, min((x + 1) * span, self.n))}
        return len(roots) == 1

    def join(self) -> Union:
        if self.n > 1:
            self._pair(len(self.levels) - 1, 0, 0)
        return self.links

    def _pair(self, level: int, a: int, b: int) -> None:
        todo = [(level, a, b)]
        while todo:
            level, a, b = todo.pop()
            if self._apart(level, a, b) or level <= 2 and self._one(level, a, b):
                self.pruned += 1
                continue
            if level == 1:
                self._leaves(a, b)
                continue
            n = len(self.levels[level - 1][0])
            left, right = range(a * FAN, min((a + 1) * FAN, n)), np.arange(b * FAN, min((b + 1) * FAN, n))
            pairs = []
            for x in left:
                later = right[right >= x]
                meet = self._meet(level - 1, x, later)
                self.pruned += int(np.count_nonzero(~meet))
                pairs += [(level - 1, x, y) for y in later[meet].tolist()]
            todo += sorted(pairs, key=lambda p: p[1] - p[2])  # nearest last, so first

    def _leaves(self, a: int, b: int) -> None:
        """Members of two nodes above the leaves: first each member of a against the OR of b."""
        maps, sizes, _ = self.levels[0]
        over = self.levels[1][0][b]
        left = np.arange(a * FAN, min((a + 1) * FAN, len(maps)))
        right = np.arange(b * FAN, min((b + 1) * FAN, len(maps)))
        most = np.minimum(np.bitwise_count(maps[left] & over).sum(1) + self.spare[left], sizes[left])
        left = left[most * (self.num + self.den) >= self.num * (sizes[left] + sizes[right].min())]
        if not len(left):
            self.pruned += 1
            return
        shared = np.bitwise_count(maps[left][:, None] & maps[right][None]).sum(2).astype(np.int64)
        most = np.minimum(shared + np.minimum(self.spare[left][:, None], self.spare[right][None]), np.minimum(sizes[left][:, None], sizes[right][None]))
        fits = most * (self.num + self.den) >= self.num * (sizes[left][:, None] + sizes[right][None])
        for x, y in zip(*np.nonzero(fits)):
            i, j = int(left[x]), int(right[y])
            if i < j and self.links.find(i) != self.links.find(j) and self.linked(i, j):
                self.links.join(i, j)

    def linked(self, i: int, j: int) -> bool:
        self.compared += 1
        if self.sets is None:
            return True
        a, b = self.sets[i], self.sets[j]
        overlap = len(np.intersect1d(a, b, assume_unique=True))
        return overlap * self.den >= self.num * (len(a) + len(b) - overlap)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, h, bits): h is the hash of the set, null for an empty one."""

    def run(parts):
        hashes = WordHashes()
        for batch in pieces(parts):
            found = [shingles(x.as_py(), n, hashes) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array([set_hash(s) if len(s) else None for s in found], pa.int64()), pa.array([bitmap(s, width(len(s), THIN)).tobytes() for s in found], pa.binary())], ["doc_id", "n_shingles", "h", "bits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("raw")).mapInArrow(run, "doc_id long, n_shingles long, h long, bits binary")


def _ties(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(a, b): set hashes that share a key, each tied to the first of the key."""

    def emit(parts):
        hashes, blocking, seen = WordHashes(), Blocking(num, den), set()
        for batch in parts:
            keys, marks, size = [], [], 0
            for raw in batch.column(0):
                elements = shingles(raw.as_py(), n, hashes)
                h = set_hash(elements)
                if h in seen:
                    continue
                seen.add(h)
                k = blocking.keys(elements)
                keys.append(k)
                marks.append(np.full(len(k), h, np.int64))
                size += len(k)
                if size > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), pa.array(np.concatenate(marks))], ["key", "h"])
                    keys, marks, size = [], [], 0
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), pa.array(np.concatenate(marks))], ["key", "h"])

    def tie(parts):
        last, first, before = None, None, None
        for batch in parts:
            key, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            new = np.concatenate([[last is None or key[0] != last], key[1:] != key[:-1]])
            starts = np.flatnonzero(new)
            at = np.cumsum(new) - 1
            heads = np.where(at >= 0, h[starts[np.maximum(at, 0)]] if len(starts) else 0, first if first is not None else 0)
            other = h != heads
            last, first = key[-1], heads[-1]
            pairs = np.unique(np.stack([h[other], heads[other]], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], ["a", "b"])

    keys = docs.select(utf8().alias("raw")).where(F.length("raw") > 0).mapInArrow(emit, "key long, h long")
    return keys.repartition("key").sortWithinPartitions("key", "h").mapInArrow(tie, "a long, b long").distinct()


def _spanning(tree: SignatureTree, names: list[int]):
    """Links from each set to the first one of its component."""
    links = tree.join()
    out = [(names[tree.ids[i]], names[tree.ids[links.find(i)]]) for i in range(len(names))]
    out = [x for x in out if x[0] != x[1]]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])


def _refined(ties: DataFrame, classes: DataFrame, num: int, den: int, bundle: int) -> DataFrame:
    """Ties (a, b) that bitmaps and sizes allow."""
    members = ties.select(F.col("b").alias("first"), F.col("a").alias("h")).union(ties.select(F.col("b").alias("first"), F.col("b").alias("h")).distinct())
    most = F.greatest(F.lit(128), F.col("n") * (THIN / 4))  # bytes of the bitmap, at most
    sized = members.join(classes.select("h", "n"), "h")
    blocks = sized.groupBy("first").agg(F.ceil(F.greatest(F.count("*") / bundle, F.sum(most) / MAP_BYTES)).cast("int").alias("blocks"))
    dealt = members.join(blocks, "first").join(classes.select("h", "n", "bits"), "h")
    own, i = F.pmod("h", "blocks").cast("int"), F.col("i")
    dealt = dealt.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("first", (F.least(own, i) * F.col("blocks") + F.greatest(own, i)).alias("block"), "h", "n", "bits")

    blocking = Blocking(num, den)

    def refine(parts):
        for _, rows in groups(parts, ["first", "block"]):
            names, sizes, maps = rows["h"].to_pylist(), rows["n"].to_numpy(), [np.frombuffer(x, U64) for x in rows["bits"].to_pylist()]
            for some in blocking.alike(sizes):
                bits = 64 * min(len(maps[i]) for i in some)
                yield from _spanning(SignatureTree(np.stack([folded(maps[i], bits) for i in some]), sizes[some], num, den), [names[i] for i in some])

    return dealt.repartition("first", "block").sortWithinPartitions("first", "block", "h").mapInArrow(refine, "a long, b long")


def join(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN, group: int = GROUP, bundle: int = BUNDLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of documents that link when den * overlap >= num * union."""
    return _linked(docs, n, num, den, group, bundle).select("doc_id", "n_shingles", "component_id")


def _linked(docs: DataFrame, n: int, num: int, den: int, group: int = GROUP, bundle: int = BUNDLE) -> DataFrame:
    """The join with h, the hash of the set, and component, the smallest h of the component; both are null for an empty set."""
    sets = checkpoint(_sets(docs.select("doc_id", "text"), n))
    classes = sets.where("h is not null").groupBy("h").agg(F.min("doc_id").alias("first"), F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("any"), F.min("n_shingles").alias("n"), F.min("bits").alias("bits"))
    ties = checkpoint(_ties(docs, n, num, den))
    candidates = components(_refined(ties, classes, num, den, bundle))
    sized = candidates.join(classes.select(F.col("h").alias("node"), "n"), "node")
    classes = classes.select("h", "first", "any")
    sizes = sized.groupBy("component").agg(F.ceil(F.greatest(F.count("*") / group, F.sum("n") / ELEMENTS)).cast("int").alias("blocks"))
    wanted = candidates.join(sizes, "component").select(F.col("node").alias("h"), "component", "blocks")
    wanted = wanted.join(classes, "h").select(F.coalesce("first", "any").alias("doc_id"), F.col("h").alias("want"), "component", "blocks")

    blocking = Blocking(num, den)

    def elements(parts):
        hashes = WordHashes()
        for batch in pieces(parts):
            out = []
            for raw, want, component, blocks in zip(batch.column(0), *(batch.column(i).to_pylist() for i in (1, 2, 3))):
                found = shingles(raw.as_py(), n, hashes)
                if len(found) and set_hash(found) == want:
                    own = want % blocks
                    out += [(component, min(own, i) * blocks + max(own, i), want, found.tobytes()) for i in range(blocks)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["component", "block", "h", "elements"])

    def link(parts):
        for _, rows in groups(parts, ["component", "block"]):
            found = dict(zip(rows["h"].to_pylist(), rows["elements"].to_pylist()))
            names, own = list(found), [np.frombuffer(x, U64) for x in found.values()]
            sizes = np.array([len(x) for x in own])
            for some in blocking.alike(sizes):
                bits = width(int(sizes[some].max()), WIDE)
                yield from _spanning(SignatureTree(np.stack([bitmap(own[i], bits) for i in some]), sizes[some], num, den, [own[i] for i in some]), [names[i] for i in some])

    raws = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), utf8().alias("raw"))
    texts = raws.join(wanted, "doc_id").select("raw", "want", "component", "blocks")
    found = texts.mapInArrow(elements, "component long, block long, h long, elements binary")
    links = found.repartition("component", "block").sortWithinPartitions("component", "block", "h").mapInArrow(link, "a long, b long")
    linked = components(links)
    named = linked.join(classes.select(F.col("h").alias("node"), "first"), "node")
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    named = named.join(least, "component").select(F.col("node").alias("h"), "component", "least")
    classes = classes.join(named, "h", "left").select("h", F.coalesce("component", "h").alias("component"), F.coalesce("least", "first").alias("component_id"))
    out = sets.join(classes, "h", "left")
    return out.select("doc_id", "n_shingles", "h", "component", F.when(F.col("h").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each component, with all its columns: of those with its smallest doc_id the one with the smallest set hash; of equal sets with that id, one.

    Rows that share a doc_id but aren't linked are components of their own, and all stay. A document with a null doc_id stays: it can't be told from others. Columns of docs may have any names.
    """
    keep, best, many, own, text, place = fresh(docs, "keep", "best", "many", "own", "text_hash", "place")
    found = _linked(docs.select("doc_id", "text"), n, num, den).where("doc_id = component_id").groupBy("component", "doc_id").agg(F.min("h").alias(best)).select(F.col("doc_id").alias(keep), best)
    kept = docs.join(found, F.col("doc_id") == F.col(keep), "left_semi")
    repeated = kept.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(many))
    if repeated.limit(1).count():
        same = F.col("doc_id") == F.col(many)
        again = kept.join(repeated, same, "left_semi").withColumn(own, _set_hashes(n)(utf8()))
        again = again.join(found, (F.col("doc_id") == F.col(keep)) & F.col(own).eqNullSafe(F.col(best)), "left_semi")
        again = again.withColumn(text, F.md5(F.coalesce("text", F.lit(""))))
        first = Window.partitionBy("doc_id", own, F.when(F.col(own).isNull(), F.col(text))).orderBy(text)
        again = again.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(*map(col, docs.columns))
        kept = kept.join(repeated, same, "left_anti").unionByName(again)
    return kept.unionByName(docs.where("doc_id is null"))


def _set_hashes(n: int):
    """A function of UTF-8 texts: the hashes of their sets, null for empty ones."""

    @F.pandas_udf("long")
    def hashed(raws):
        import pandas as pd

        hashes = WordHashes()
        found = [shingles(bytes(x), n, hashes) for x in raws]
        return pd.Series([set_hash(s) if len(s) else None for s in found], dtype="Int64")

    return hashed


def query(spark, sf_dir):
    return join(table(spark, sf_dir, "documents"))
