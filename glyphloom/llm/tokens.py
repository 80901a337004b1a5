"""Token counts with overlap resynchronisation.

A huge text is encoded in overlapping chunks. Two neighbouring chunks are spliced where both have a token boundary right after a blank or newline that lies inside the overlap, and the same tokens from there to the end of the overlap: no token of the vocabulary reaches over such a place, since its pre-tokenizer cuts at white space, so what follows it is encoded alike by both. Where the overlap holds no such place the right chunk starts further left and the left one ends further right, twice as far each time, until one is found or the chunk has become the whole text.

A text up to the size of a chunk (CHUNK characters) is a single chunk. A chunk is cut at blanks and newlines only, for the same reason, and its words are encoded one by one; what they gave is remembered. Words of printable ASCII and Latin letters are cut into the pre-tokenizer's pieces here, and the library's model, which is most of what is asked of it, gets each distinct piece once; the whole library encodes all other words. Texts with the strings of special tokens, which may hold or join any characters, are given to the library whole.

Null text: empty, no tokens. Empty table: no rows. Repeated rows are counted each; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces, table, utf8

CHUNK, OVERLAP, LIMIT = 8192, 256, 2048
#: Words and pieces that are remembered, and the characters of the longest of them.
CACHE, LONGEST = 300_000, 64
NAME = "word_bpe_49k.json"
#: How the tokenizer of that name turns words into pieces, and the same for words of these characters.
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
CUTS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
USUAL = re.compile(f"[!-~{LATIN}]*")
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^a-z0-9{LATIN}]+")


def load(name: str = NAME, path: str | None = None):
    """The tokenizer of that file; path: of the file, if it isn't that of the installed package."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or public_tokenizers.path(name))


class Known(dict):
    """What a function gives for a string, remembered for short strings; all are forgotten when there are CACHE of them."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key: str):
        found = self.function(key)
        if len(key) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
            self[key] = found
        return found


class Encoded:
    """The words of text[begin:stop], cut at blanks and newlines: where each starts in the text, the lengths of its tokens, and how many tokens are before it."""

    def __init__(self, known: Known, text: str, begin: int, stop: int):
        words = _words(text[begin:stop])
        self.starts = list(accumulate((len(w) + 1 for w in words), initial=begin))[:-1]
        self.tokens = list(map(known.__getitem__, words))
        self.before = list(accumulate(map(len, self.tokens), initial=0))

    def upto(self, place: int) -> int:
        """The number of tokens before the word that starts at place."""
        return self.before[bisect_left(self.starts, place)]


def _words(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


class Counter:
    """Counts tokens of texts under one tokenizer that cuts at white space and drops it."""

    def __init__(self, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.tokenizer, self.model, self.chunk, self.overlap = tokenizer, tokenizer.model, chunk, overlap
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.known, self.pieces = Known(self._word), Known(self._piece)
        settings = json.loads(tokenizer.to_str())
        self.cuts = all(settings[k] == v for k, v in CUTS.items()) and settings["model"]["type"] == "BPE" and not settings["model"]["dropout"]
        self.bytes = {}
        if self.cuts:
            from tokenizers.pre_tokenizers import ByteLevel

            level = ByteLevel(add_prefix_space=False, use_regex=False)
            self.bytes = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(0xC0, 0x100)}

    def plain(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """The lengths of a word's tokens, up to 255."""
        if self.cuts and USUAL.fullmatch(word):
            return b"".join(map(self.pieces.__getitem__, PIECE.findall(word.lower())))
        return bytes(min(b - a, 255) for a, b in self.tokenizer.encode(word, add_special_tokens=False).offsets)

    def _piece(self, piece: str) -> bytes:
        """The same of a piece of the pre-tokenizer, as the model writes them."""
        found = self.model.tokenize(piece if piece.isascii() else piece.translate(self.bytes))
        return bytes([min(len(t.value), 255) for t in found])

    def small(self, text: str) -> int:
        return sum(map(len, map(self.known.__getitem__, _words(text))))

    def huge(self, text: str) -> tuple[int, int]:
        """(tokens, widenings) of a text in overlapping chunks. A chunk is [begin, stop)."""
        total, begin, widened = 0, 0, 0
        size = len(text)
        stop = min(self.chunk, size)
        found, done = Encoded(self.known, text, 0, stop), 0  # the first `done` tokens were counted with the chunk before
        while stop < size:
            overlap = self.overlap
            while True:
                left = max(begin, stop - overlap)
                right = min(size, max(stop, left + self.chunk))
                after = Encoded(self.known, text, left, right)
                place = self._common(found, after)
                if place is not None:
                    break
                widened += 1
                overlap *= 2
                stop = min(size, stop + overlap)
                found = Encoded(self.known, text, begin, stop)
                done = found.upto(done_at) if begin else 0
                if stop == size:
                    return total + found.before[-1] - done, widened
            total += found.upto(place) - done
            done = after.upto(place)
            begin, stop, found, done_at = left, right, after, place
        return total + found.before[-1] - done, widened

    @staticmethod
    def _common(found: Encoded, after: Encoded) -> int | None:
        """Where both encodings start a word after white space and agree from there to the last full word of the left one; none: not proven stable."""
        if len(after.starts) < 2:
            return None
        place = after.starts[1]
        at = bisect_left(found.starts, place)
        n = len(found.starts) - 1 - at  # the last word may go on behind the chunk
        if n < 1 or found.before[-2] == found.before[at]:
            return None
        same = found.starts[at:-1] == after.starts[1 : 1 + n] and found.tokens[at:-1] == after.tokens[1 : 1 + n]
        return place if same else None

    def counts(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        for t in texts:
            if "<|" in t and any(s in t for s in self.special):
                out.append(self.plain(t))
            else:
                out.append(self.huge(t)[0] if len(t) > self.chunk else self.small(t))
        return out


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count(docs: DataFrame, path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    def run(parts):
        counter = Counter(load(path=path), chunk, overlap)
        for batch in pieces(parts):
            raws = batch.column(1).to_pylist()
            n = counter.counts([x.decode("utf-8", "replace") for x in raws])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, raws), pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), utf8().alias("raw")).mapInArrow(run, SCHEMA)


def query(spark, sf_dir):
    return count(table(spark, sf_dir, "documents").select("doc_id", "text"))
