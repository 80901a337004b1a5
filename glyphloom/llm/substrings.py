"""Substring dedup with an FM-index per shard.

A window is SIZE consecutive words of a document. A word is removed if a window covers it whose words also start earlier: in a document with a smaller doc_id, or before in the same one. The result is exact:

1. A document whose whole word sequence is that of an earlier one loses all words if it has a window; it takes no further part.
2. Each window has a minimiser, the K-gram in it with the smallest hash (the first of them). Equal windows have equal minimisers. Neighbouring windows with one minimiser are a segment. Minimisers are shuffled by hash and sorted; a task reads them as a stream and reports the places of those that are found in more than one place.
3. Segments around these places (a task gives out each content once and reports the rest as repeats) are dealt to shards by the hash of their minimiser, sorted by it and by content. In the stream of a shard, segments with the same words as the one before are repeats, and all their windows start earlier too. The others are indexed, a bounded number of words at a time but never cutting what one minimiser holds: a suffix array sorted to DEPTH words, its Burrows-Wheeler transform in a wavelet matrix, and for each suffix the order of its place in the corpus. If one minimiser holds more than that number, its segments are cut further, by the smallest K-gram of each window but the minimiser, and go to PARTS files of the task, which are solved one by one.
4. Every window of the indexed segments is searched backwards, word by word, and given up as soon as a single suffix is left: the steps until then are its matching statistic, the length of the longest match that ends there, as far as the threshold of SIZE. Windows that reach it are the matches; a window is removed unless it is the earliest of its interval.
5. The windows to be removed are joined to their documents by doc_id, and the words outside of them are kept.

Nulls: null text has no words; rows with a null doc_id are left whole and remove nothing. Several rows with one doc_id: the order is that of a hash of their words; equal rows are copies, one stays. Empty texts and tables: no words, no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CACHE, U64, WordHashes, checkpoint, grams, pieces, signed, table, utf8

SIZE, K, DEPTH = 20, 6, 32
FLUSH, PARTS = 400_000, 64


def minimisers(hashes: np.ndarray, size: int = SIZE, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """For each window, the place of the k-gram with the smallest hash in it (the first of equal ones), and the hashes of all k-grams."""
    h = grams(hashes, k)
    return smallest(h, len(hashes) - size + 1, size - k + 1), h


def smallest(h: np.ndarray, n: int, wide: int) -> np.ndarray:
    """The place of the smallest of `wide` values from each of the first n on."""
    if n <= 0:
        return np.empty(0, np.int64)
    least, place, done = h[: n + wide - 1], np.arange(n + wide - 1), 1
    while done < wide:  # what holds for `done` values and for as many from a step later holds for both; the first of equal ones wins
        step = min(done, wide - done)
        less = least[step:] < least[:-step]
        least, place = np.minimum(least[step:], least[:-step]), np.where(less, place[step:], place[:-step])
        done += step
    return place


class Wavelet:
    """A wavelet matrix: for each bit of the symbols, from the highest, a bit vector with counts of ones before each word of it."""

    def __init__(self, symbols: np.ndarray):
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        self.n = len(symbols)
        self.words, self.ones, self.zeros = [], [], []
        s = symbols
        for b in range(self.bits - 1, -1, -1):
            bit = (s >> b & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            self.words.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate([s[~bit], s[bit]])

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.ones[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def ranks(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol stands before low, and before high."""
        a, b, start = low, high, np.zeros(len(symbols), np.int64)
        for level in range(self.bits):
            bit = (symbols >> (self.bits - 1 - level) & 1).astype(bool)
            x, y, z = self._rank(level, a), self._rank(level, b), self._rank(level, start)
            zeros = self.zeros[level]
            a, b, start = np.where(bit, zeros + x, a - x), np.where(bit, zeros + y, b - y), np.where(bit, zeros + z, start - z)
        return a - start, b - start


class FMIndex:
    """An FM-index over sequences of words; suffixes are sorted by their first DEPTH words, which is enough for patterns up to that length."""

    def __init__(self, sequences: list[list[bytes]], depth: int = DEPTH):
        ids: dict[bytes, int] = {}
        lengths = np.array([len(s) + 1 for s in sequences])
        self.starts = np.cumsum(lengths) - lengths
        flat = [ids.setdefault(w, len(ids) + 1) for s in sequences for w in (*s, b" ")]  # no word is a blank, which ends a sequence
        self.text = t = np.array(flat, np.int64)
        end = ids.get(b" ", 0)
        t[t == end] = 0
        rank, step = t.copy(), 1
        while step < depth and len(t):
            after = np.zeros(len(t), np.int64)
            after[:-step] = rank[step:] + 1
            _, rank = np.unique(rank * (len(t) + len(ids) + 3) + after, return_inverse=True)
            step *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        self.before = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=len(ids) + 2))])
        self.wavelet = Wavelet(t[self.suffixes - 1] if len(t) else t)

    def windows(self, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of the windows of text that start at these places: (number of the window, low, high) of those that occur more than once, and for every window its matching statistic: how many of its last words occur elsewhere too."""
        live, lengths = np.arange(len(places)), np.full(len(places), size)
        low, high = np.zeros(len(places), np.int64), np.full(len(places), len(self.text), np.int64)
        for i in range(size - 1, -1, -1):
            symbols = self.text[places[live] + i]
            a, b = self.wavelet.ranks(symbols, low, high)
            low, high = self.before[symbols] + a, self.before[symbols] + b
            more = high - low > 1
            lengths[live[~more]] = size - 1 - i
            live, low, high = live[more], low[more], high[more]
        return live, low, high, lengths

    def repeats(self, places: np.ndarray, size: int, order: np.ndarray) -> np.ndarray:
        """Which of the windows at these places are not the first of their kind; order: of each place of the text."""
        out = np.zeros(len(places), bool)
        live, low, high, _ = self.windows(places, size)
        if len(live):
            spans, inverse = np.unique(low * (len(self.text) + 1) + high, return_inverse=True)
            lows, highs = spans // (len(self.text) + 1), spans % (len(self.text) + 1)
            by_suffix = order[self.suffixes]
            edges = np.stack([lows, np.minimum(highs, len(by_suffix) - 1)], 1).ravel()
            least = np.minimum.reduceat(by_suffix, edges)[::2]
            at_end = highs == len(by_suffix)
            least[at_end] = np.minimum(least[at_end], by_suffix[-1])
            out[live] = order[places[live]] > least[inverse]
        return out


def _documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, sha): sha of the words joined by one blank."""

    def run(parts):
        for batch in pieces(parts):
            words = [x.as_py().split() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).digest() for w in words], pa.binary())], ["doc_id", "n_words", "sha"])

    return docs.mapInArrow(run, "doc_id long, n_words long, sha binary")


def _identity(words: list[bytes]) -> int:
    """The first 8 bytes of the hash of a document's words: stands for its content."""
    return int.from_bytes(hashlib.sha256(b" ".join(words)).digest()[:8], "big", signed=True)


def _places(docs: DataFrame, size: int, k: int) -> DataFrame:
    """(content, places): where the minimisers stand that are found in more than one place.

    A minimiser that a document has more than once is known to be repeated there: it is shuffled once as a key, and its places under a key of the document.
    """

    def emit(parts):
        hashes, seen = WordHashes(), set()
        for batch in parts:
            held, n = [], 0
            for raw in batch.column(1):
                words = raw.as_py().split()
                if len(words) < size:
                    continue
                content = _identity(words)
                if content in seen:
                    continue
                seen.add(content)
                place, h = minimisers(hashes.of(words), size, k)
                place = np.unique(place)
                keys, first, inverse, times = np.unique(h[place], return_index=True, return_inverse=True, return_counts=True)
                twice = place[times[inverse] > 1]
                held.append((signed(keys), np.full(len(keys), content, np.int64), place[first], np.zeros(len(keys), bool)))
                held.append((np.full(len(twice), content, np.int64), np.full(len(twice), content, np.int64), twice, np.ones(len(twice), bool)))
                n += len(place)
                if n > 200_000:
                    yield rows(held)
                    held, n = [], 0
            if held:
                yield rows(held)

    def rows(held):
        key, content, place, known = (np.concatenate([p[i] for p in held]) for i in range(4))
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(content), pa.array(place.astype(np.int32)), pa.array(known)], ["key", "content", "place", "known"])

    def repeated(parts):
        """Streams rows sorted by key, content, place; equal rows count once."""
        last = None  # (key, content, place, whether it was given out)
        for batch in parts:
            key, content, place, known = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if known.any():
                yield pa.RecordBatch.from_arrays([pa.array(content[known]), pa.array(place[known])], ["content", "place"])
                key, content, place = key[~known], content[~known], place[~known]
            if not len(key):
                continue
            if last is not None:
                key, content, place = np.concatenate([[last[0]], key]), np.concatenate([[last[1]], content]), np.concatenate([[last[2]], place])
            same_key = key[1:] == key[:-1]
            fresh = np.concatenate([[True], ~(same_key & (content[1:] == content[:-1]) & (place[1:] == place[:-1]))])
            key, content, place = key[fresh], content[fresh], place[fresh]
            same_key = key[1:] == key[:-1]
            many = np.concatenate([[False], same_key]) | np.concatenate([same_key, [False]])
            given = last is not None and last[3]
            many[0] |= given
            out = many.copy()
            if given:
                out[0] = False
            last = (key[-1], content[-1], place[-1], bool(many[-1]))
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(content[out]), pa.array(place[out].astype(np.int32))], ["content", "place"])

    keys = docs.where("doc_id is not null").mapInArrow(emit, "key long, content long, place int, known boolean")
    found = keys.repartition("key").sortWithinPartitions("key", "content", "place").mapInArrow(repeated, "content long, place int")
    return found.groupBy("content").agg(F.sort_array(F.collect_list("place")).alias("places"))  # places of one document


def _segments(texts: DataFrame, size: int, k: int) -> DataFrame:
    """(key, digest, doc_id, content, start, last, words) of documents with content and places; last: of the segment's words, exclusive.

    A segment that the task has met at an earlier place is only reported as a repeat, without words, under a key of its document: so a hot passage leaves each task once.
    """

    def run(parts):
        hashes, seen = WordHashes(), {}
        for batch in parts:
            out, n = [], 0
            for key, raw, content, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3)):
                words = raw.as_py().split()
                if len(words) < size or _identity(words) != content:
                    continue
                place, h = minimisers(hashes.of(words), size, k)
                wanted = np.isin(place, np.asarray(places.values.to_numpy()), assume_unique=False)
                change = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                ends = np.concatenate([change[1:], [len(place)]])
                marks = signed(h)
                for a, b in zip(change.tolist(), ends.tolist()):
                    if wanted[a]:
                        text = b" ".join(words[a : b + size - 1])
                        digest = hashlib.md5(text).digest()
                        if seen.setdefault(digest, (key, content, a)) < (key, content, a):
                            out.append((content, None, key, content, a, b + size - 1, None))
                            continue
                        out.append((int(marks[place[a]]), digest[:8], key, content, a, b + size - 1, text))
                        n += len(text)
                if len(seen) > CACHE:
                    seen = {}
                if n > 4_000_000:
                    yield rows(out)
                    out, n = [], 0
            if out:
                yield rows(out)

    def rows(out):
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["key", "digest", "doc_id", "content", "start", "last", "words"])

    return texts.mapInArrow(run, "key long, digest binary, doc_id long, content long, start int, last int, words binary")


class Parts:
    """The segments of one minimiser that are too many for one index, in files that go with the object."""

    def __init__(self, key: int, size: int, k: int):
        self.key, self.size, self.k, self.hashes = U64(key & (1 << 64) - 1), size, k, WordHashes()
        self.files = [tempfile.TemporaryFile() for _ in range(PARTS)]

    def add(self, doc, content: int, start: int, words: list[bytes]) -> None:
        """Cuts the segment where the smallest k-gram but the minimiser itself changes: equal windows have equal ones."""
        h = grams(self.hashes.of(words), self.k)
        h[h == self.key] = ~U64(0)
        place = smallest(h, len(words) - self.size + 1, self.size - self.k + 1)
        change = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        for a, b in zip(change.tolist(), [*change[1:].tolist(), len(place)]):
            sub = int(h[place[a]])
            pickle.dump((sub, doc, content, start + a, b" ".join(words[a : b + self.size - 1])), self.files[sub % PARTS])

    def read(self):
        """For each file, its rows (sub-key, words, doc, content, start) in order."""
        for file in self.files:
            file.seek(0)
            rows = []
            while True:
                try:
                    sub, doc, content, start, text = pickle.load(file)
                except EOFError:
                    break
                rows.append((sub, text, doc, content, start))
            file.close()
            yield sorted(rows)


def _removed(segments: DataFrame, size: int, flush: int, k: int = K) -> DataFrame:
    """(doc_id, content, first, last): words to be removed, last exclusive."""
    names = ["doc_id", "content", "first", "last"]

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names)

    def solve(held):
        """held: (doc_id, content, start, words)"""
        if len(held) < 2:
            return
        index = FMIndex([w for *_, w in held], depth=max(DEPTH, size))
        order_of = np.lexsort((np.array([h[2] for h in held]), np.array([h[1] for h in held]), np.array([h[0] for h in held])))
        # the order of places in the corpus: documents by (doc_id, content), then words
        documents, document = {}, []
        for i in order_of:
            documents.setdefault(held[i][:2], len(documents))
        document = np.array([documents[h[:2]] for h in held], np.int64)
        lengths = np.array([len(h[3]) + 1 for h in held])
        starts = np.array([h[2] for h in held], np.int64)
        within = np.arange(len(index.text)) - np.repeat(index.starts, lengths)
        order = np.repeat(document, lengths) * (1 << 36) + np.repeat(starts, lengths) + within
        places = np.flatnonzero(np.repeat(lengths, lengths) - 1 - within >= size)
        hit = places[index.repeats(places, size, order)]
        if not len(hit):
            return
        owner = np.searchsorted(index.starts, hit, "right") - 1
        new = np.flatnonzero(np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[1:] != owner[:-1])]))
        ends = np.concatenate([new[1:], [len(hit)]])
        out = []
        for a, b in zip(new.tolist(), ends.tolist()):
            key, content, start, _ = held[owner[a]]
            first = start + int(hit[a] - index.starts[owner[a]])
            out.append((key, content, first, first + b - a - 1 + size))
        yield rows(out)

    def solve_parts(large):
        for found in large.read():
            held, words, last = [], 0, None
            repeats = []
            for sub, text, doc, content, start in found:
                if (sub, text) == last:
                    repeats.append((doc, content, start, start + text.count(b" ") + 1))
                    continue
                if words >= flush and sub != last[0]:
                    yield from solve(held)
                    held, words = [], 0
                last = sub, text
                held.append((doc, content, start, text.split(b" ")))
                words += len(held[-1][3])
            if repeats:
                yield rows(repeats)
            yield from solve(held)

    def run(parts):
        held, words, last, current, large = [], 0, None, None, None
        for batch in parts:
            repeats = []
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for key, digest, doc, content, start, end, text in zip(*columns):
                if text is None or (key, digest, text) == last:
                    repeats.append((doc, content, start, end))
                    continue
                last = key, digest, text
                if key != current:
                    if large:
                        yield from solve_parts(large)
                        large = None
                    if words >= flush:
                        yield from solve(held)
                        held, words = [], 0
                    current, first, own = key, len(held), 0
                row = doc, content, start, text.split(b" ")
                if large:
                    large.add(*row)
                    continue
                held.append(row)
                words += len(row[3])
                own += len(row[3])
                if own > flush:
                    large = Parts(key, size, k)
                    for x in held[first:]:
                        large.add(*x)
                        words -= len(x[3])
                    del held[first:]
            if repeats:
                yield rows(repeats)
        if large:
            yield from solve_parts(large)
        yield from solve(held)

    placed = segments.repartition("key").sortWithinPartitions("key", "digest", "doc_id", "content", "start")
    return placed.mapInArrow(run, "doc_id long, content long, first int, last int")


def _kept(texts: DataFrame) -> DataFrame:
    """(doc_id, content, n_removed, kept) of documents with content and spans."""

    def run(parts):
        for batch in parts:
            out = []
            for key, raw, content, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = raw.as_py().split()
                if _identity(words) != content:
                    continue
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    gone[s["first"]] += 1
                    gone[s["last"]] -= 1
                stay = np.cumsum(gone[:-1]) == 0
                kept = [words[i] for i in np.flatnonzero(stay)]
                out.append((key, content, len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["doc_id", "content", "n_removed", "kept"])

    return texts.mapInArrow(run, "doc_id long, content long, n_removed long, kept string").dropDuplicates(["doc_id", "content"])


def dedup(docs: DataFrame, size: int = SIZE, k: int = K, flush: int = FLUSH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row for each row of docs."""
    raws = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("raw"))
    found = checkpoint(_documents(raws).groupBy("doc_id", "sha", "n_words").agg(F.count("*").alias("copies")))
    content = F.conv(F.substring(F.hex("sha"), 1, 16), 16, -10).cast("long")
    owners = found.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("owner"))
    firsts = owners.select(F.col("owner").alias("doc_id"), content.alias("content"))
    places = _places(raws, size, k).join(firsts, "content").select("doc_id", "content", "places")
    segments = _segments(raws.join(places, "doc_id").select("doc_id", "raw", "content", "places"), size, k)
    spans = _removed(segments, size, flush, k).groupBy("doc_id", "content").agg(F.collect_list(F.struct("first", "last")).alias("spans"))  # of one document
    kept = _kept(raws.join(spans, "doc_id").select("doc_id", "raw", "content", "spans"))
    rows = found.join(owners, "sha", "left").withColumn("content", content).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    rows = rows.withColumn("whole", F.col("doc_id").isNotNull() & (F.col("n_words") >= size) & ((F.col("doc_id") > F.col("owner")) | (F.col("copy") > 1)))
    rows = rows.join(kept, ["doc_id", "content"], "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return rows.select("doc_id", "n_words", F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"), F.when(F.col("whole"), nothing).otherwise(F.coalesce("kept", F.lower(F.hex("sha")))).alias("kept_sha256"))


def query(spark, sf_dir):
    return dedup(table(spark, sf_dir, "documents"))
