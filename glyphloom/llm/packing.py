"""Order-preserving packing of token sequences by dynamic programming.

Documents are taken in the order of doc_id within each partition of their table, their ids are laid end to end, and this stream is cut into windows of at most SIZE ids. Candidates for cuts are document ends (no penalty), sentence ends (SENTENCE) and, where these lie more than STEP apart, places in STEPs between them, which truncate a sentence (FORCED). The cost of a window is its padding up to SIZE plus the penalty of the cut that ends it. With f the least cost up to a candidate j,

    f[j] = penalty(j) + SIZE - j + min over i in [j - SIZE, j) of (f[i] + i).

The inner minimum slides over the candidates in a monotone queue, so that each candidate enters and leaves once. Blocks of BLOCK ids are solved one by one; the last, open window of a block starts the next one. Windows whose size is a power of two need no padding, but a short window takes the place of a full one, so they are for the end of a partition only: what the last full window leaves there is cut at powers of two, each such cut being charged like a forced one, if that is cheaper than padding.

sequence_id is unique: partition number times 2^40 plus the number of the window; so is document. Nothing is shuffled, so a partition that is computed again gives the same rows as long as the table is stored.

Null text: no ids but the end. Repeated doc_ids are separate documents, in the order of their texts; `document` numbers the documents, so that pieces of rows that share a doc_id can be told apart. Long texts are encoded whole, their pieces are as many as it takes. Empty table: no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, table

SIZE, END = 2048, 1
SENTENCE, FORCED, STEP = 3.0, 16.0, 64
BLOCK = 1 << 19
NAME, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Anything but ASCII, Latin, Greek, Cyrillic and Arabic letters that Unicode has long had, and usual punctuation.
#: Runs of white space from which on the library of ranks may run out of stack.
RUN = re.compile("\\s{10000}")
UNUSUAL = re.compile("[^\\x00-\\x7f\u00a1-\u024f\u0391-\u03a1\u03a3-\u03ff\u0400-\u04ff\u0620-\u065f\u2010-\u2027\u20ac]")


class Encoder:
    """Ids of texts as arrays of 32-bit numbers, as the tokenizers library gives them for byte_bpe_50k.json.

    The same vocabulary as ranks gives the same ids in a fraction of the time, as long as both libraries class the characters of a text alike. Texts with characters outside of long-assigned blocks, with the string of a special token, or with RUN blanks in a row, and any text under a tokenizer of one's own (path), are encoded by the tokenizers library itself.
    """

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(NAME))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = None
        if path is None:
            with open(public_tokenizers.path(RANKS), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        vocab = self.tokenizer.get_vocab()
        self.stops = np.zeros(max(vocab.values(), default=0) + 1, bool)
        for token, i in vocab.items():
            self.stops[i] = bool(re.search("[.!?Ċ][\"')\\]]*$", token))

    def encode(self, text: str) -> np.ndarray:
        if self.ranks is None or not text.isascii() and UNUSUAL.search(text) or "<|" in text and any(s in text for s in self.special) or len(text) >= 10_000 and RUN.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


def cuts(places: np.ndarray, penalties: np.ndarray, size: int = SIZE, free_from: int | None = None) -> list[int]:
    """The cheapest cuts of [0, places[-1]): places are the candidates in ascending order, the last one being the end. Returns the chosen places.

    Windows that begin at free_from or later have no padding if their size is a power of two. No two neighbouring candidates, 0 included, may lie more than size apart.
    """
    at = [0, *places.tolist()]
    pay = [0.0, *penalties.tolist()]
    n = len(at)
    best, back = [0.0] * n, [0] * n
    free = bisect_left(at, free_from) if free_from is not None else n
    index = {p: i for i, p in enumerate(at[free:], free)}
    powers = [1 << k for k in range(size.bit_length()) if 1 << k <= size]
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    find = index.get
    for j in range(1, n):
        p = at[j]
        low = p - size
        while at[queue[0][1]] < low:
            queue.popleft()
        value, i = queue[0]
        least = value + size - p
        if j > free:
            for w in powers:
                k = find(p - w)
                if k is not None and best[k] < least:
                    least, i = best[k], k
        best[j] = least = least + pay[j]
        back[j] = i
        value = least + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    out, j = [], n - 1
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


def candidates(lengths: list[int], sentence_ends: list[np.ndarray], size: int = SIZE, sentence: float = SENTENCE, forced: float = FORCED, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Places and penalties for documents of these lengths; sentence_ends: within each, the places after sentences."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    inner = np.concatenate([e + s for e, s in zip(sentence_ends, starts)]) if len(lengths) else np.empty(0, np.int64)
    places = np.concatenate([ends, inner]).astype(np.int64)
    penalties = np.concatenate([np.zeros(len(ends)), np.full(len(inner), sentence)])
    order = np.lexsort((penalties, places))
    places, penalties = places[order], penalties[order]
    keep = np.concatenate([[True], places[1:] != places[:-1]]) & (places > 0) if len(places) else np.zeros(0, bool)
    places, penalties = places[keep], penalties[keep]
    gaps = np.diff(places, prepend=0)
    step = min(step, size)
    more = [np.arange(places[i] - gaps[i] + step, places[i], step) for i in np.flatnonzero(gaps > step)]
    if more:
        extra = np.concatenate(more)
        places, penalties = np.concatenate([places, extra]), np.concatenate([penalties, np.full(len(extra), forced)])
        order = np.argsort(places)
        places, penalties = places[order], penalties[order]
    return places, penalties


class Packer:
    """Turns a stream of encoded documents into pieces (key, start, length, crc, total, window, offset, document)."""

    def __init__(self, stops: np.ndarray, size: int = SIZE, block: int = BLOCK, sentence: float = SENTENCE, forced: float = FORCED):
        self.stops, self.size, self.block, self.sentence, self.forced = stops, size, block, sentence, forced
        self.held: list[tuple] = []  # ((key, document), ids, start, total)
        self.n = self.window = self.documents = 0

    def add(self, key, ids: np.ndarray):
        self.held.append(((key, self.documents), ids, 0, len(ids)))
        self.documents += 1
        self.n += len(ids)
        if self.n >= self.block:
            yield from self.solve(False)

    def tail(self, places: np.ndarray, penalties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """With the places where full windows, and then powers of two, up to the end would be cut: these are charged, document ends or not."""
        at, spots = 0, []
        while at < places[-1]:
            left = int(places[-1]) - at
            at += self.size if left >= self.size else 1 << left.bit_length() - 1
            spots.append(at)
        spots = np.setdiff1d(spots, places)
        places, penalties = np.concatenate([places, spots]).astype(np.int64), np.concatenate([penalties, np.full(len(spots), self.forced)])
        order = np.argsort(places)
        return places[order], penalties[order]

    def solve(self, end: bool):
        if not self.n:
            return
        lengths = [len(ids) for _, ids, _, _ in self.held]
        inner = [np.flatnonzero(self.stops[ids[:-1]]) + 1 for _, ids, _, _ in self.held]
        places, penalties = candidates(lengths, inner, self.size, self.sentence, self.forced)
        chosen = cuts(places, penalties, self.size)
        if end:  # of the last two windows, one more time, with powers of two
            tail = chosen[-3] if len(chosen) > 2 else 0
            places, penalties = self.tail(places[places > tail] - tail, penalties[places > tail])
            chosen = [x for x in chosen if x <= tail] + [x + tail for x in cuts(places, penalties, self.size, 0)]
        if not end and len(chosen) > 1:
            chosen.pop()
        doc, within, begin = 0, 0, 0
        for stop in chosen:
            at = begin
            while at < stop:
                key, ids, start, total = self.held[doc]
                n = min(stop - at, len(ids) - within)
                yield key[0], start + within, n, zlib.crc32(ids[within : within + n].tobytes()), total, self.window, at - begin, key[1]
                at, within = at + n, within + n
                if within == len(ids):
                    doc, within = doc + 1, 0
            begin = stop
            self.window += 1
        rest = self.held[doc:]
        if rest and within:
            key, ids, start, total = rest[0]
            rest[0] = (key, ids[within:], start + within, total)
        self.held, self.n = rest, self.n - begin


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, document long"


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, sentence: float = SENTENCE, forced: float = FORCED) -> DataFrame:
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(parts):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        encoder = Encoder(path)
        packer = Packer(encoder.stops, size, sentence=sentence, forced=forced)

        def rows(found):
            return pa.RecordBatch.from_arrays([pa.array([x + first for x in c] if name in ("sequence_id", "document") else c, pa.int64()) for name, c in zip(names, zip(*found))], names)

        tail = np.array([END], "<u4")
        for batch in pieces(parts):
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            out = []
            for key, text in zip(keys, texts):
                out += packer.add(key, np.concatenate([encoder.encode(text.as_py() or ""), tail]))
            if out:
                yield rows(out)
        out = list(packer.solve(True))
        if out:
            yield rows(out)

    ordered = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, SCHEMA)


def query(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
