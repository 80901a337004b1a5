"""Secret scans: fixed patterns, and probabilistic automata inferred from labelled credentials.

Three base kinds are found by pattern, leftmost and without overlaps within a kind: assign, access, hex. Labelled credentials are the strings that these hold in a bounded sample of documents, by kind, and EXAMPLES strings made by a fixed draw for each of the public formats in SHAPES. Ordinary strings are the other tokens of 12 characters and more of that sample, as they are and in capitals, those joined to names and paths, and made numbers, dates, addresses and versions (PLAIN). For each label a prefix tree of character classes with counts is built, and its states are merged where their outgoing frequencies, and those of all states below, are statistically compatible (Hoeffding bounds): a probabilistic automaton for the format. A candidate is a token of 12 characters or more of the alphabet of credentials (letters, digits, + / _ . = -), or what base spans leave of it. Every candidate of every whole text is scored by the log-likelihood of its best format over that of the best ordinary automaton, whatever classes of characters it has; those above a threshold are spans of kind `format`. Where a candidate as a whole is not above it, each of its parts between dots is a candidate. Base spans always stay.

Bounds of the fit: DOCS sampled documents (those with the smallest hashes of doc_id and text), LABELLED distinct strings of each label and BACKGROUND of the background, of at most LONGEST characters. Everything else covers all text.

Null text: empty, no spans. Empty table: no rows. Repeated rows are scanned each and give the same spans. Columns other than doc_id and text are not read by the scan; redact changes text and n_chars alone.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CACHE, pieces, table

#: Fixed patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "format")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_ASSIGN, MIN_ACCESS = 12, 18

LEAST = MIN_ASSIGN
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LEAST},}}")
PART = re.compile(rf"[^.]{{{LEAST},}}")
DOCS, LABELLED, BACKGROUND, LONGEST = 4000, 400, 4000, 128
ALPHA, THRESHOLD = 0.05, 12.0
EXAMPLES = 300
LOWER, DIGITS = string.ascii_lowercase, string.digits
BASE62, HEX16 = string.ascii_letters + string.digits, "0123456789ABCDEF"
#: Formats of credentials: parts are fixed strings or (characters, least and most of them).
SHAPES = {
    "base62": ((BASE62, 16, 48),),
    "base64": ((BASE62 + "+/", 24, 86), ("=", 0, 2)),
    "urlsafe": ((BASE62 + "-_", 24, 64),),
    "capitals": ((HEX16, 16, 64),),
    "prefix": ((LOWER, 2, 5), "_", (BASE62, 20, 40)),
    "prefixes": ((LOWER, 2, 4), "_", (LOWER, 4, 4), "_", (BASE62, 20, 32)),
    "dashes": ((LOWER, 3, 5), "-", (DIGITS, 8, 13), "-", (DIGITS, 8, 13), "-", (BASE62, 20, 32)),
    "signed": ("eyJ", (BASE62 + "-_", 20, 40), ".", "eyJ", (BASE62 + "-_", 20, 40), ".", (BASE62 + "-_", 43, 43)),
}
_H4, _D2 = ("0123456789abcdef", 4, 4), (DIGITS, 2, 2)
#: Ordinary strings that no credential is.
PLAIN = (
    ((DIGITS, 1, 15),), ("+", (DIGITS, 1, 3), "-", (DIGITS, 2, 4), "-", (DIGITS, 5, 9)), ((DIGITS, 3, 3), "-", (DIGITS, 3, 3), "-", (DIGITS, 4, 4)), ((DIGITS, 1, 9), ".", (DIGITS, 1, 12)),
    ((DIGITS, 4, 4), "-", _D2, "-", _D2), ((DIGITS, 4, 4), "-", _D2, "-", _D2, "T", _D2), ((DIGITS, 4, 4), "/", _D2, "/", _D2), (_D2, ".", _D2, ".", (DIGITS, 4, 4)), ((DIGITS, 4, 4), _D2, _D2, "T", (DIGITS, 6, 6)),
    ((DIGITS, 1, 3), ".", (DIGITS, 1, 3), ".", (DIGITS, 1, 3), ".", (DIGITS, 1, 3)), ((DIGITS, 1, 2), ".", (DIGITS, 1, 2), ".", (DIGITS, 1, 4), "-", (LOWER, 2, 5), (DIGITS, 1, 2)),
    (_H4, _H4, "-", _H4, "-", _H4, "-", _H4, "-", _H4, _H4, _H4), ((DIGITS, 4, 4), "-", (DIGITS, 4, 4), "-", (DIGITS, 4, 4), "-", (DIGITS, 4, 4)), ("=", ("=-_.", 12, 40)), (("-_=.+/", 12, 40),), ((LOWER, 12, 60),), ((LOWER.upper(), 12, 60),),
)
#: Classes of characters, by position: digits, hex letters and other letters in either case, each sign for itself.
CLASSES = {**dict.fromkeys("0123456789", "0"), **dict.fromkeys("abcdef", "a"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "g"), **dict.fromkeys("ABCDEF", "A"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "G")}
SIGNS = "0agAG+/_=-."
TO_CLASS = str.maketrans(CLASSES)


def base(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, secret) of the base spans by start, then kind; ends are exclusive, in code points."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    out.sort()
    return out


def candidates(text: str, found: list[tuple[int, int]]):
    """(start, end) of the candidate tokens, without what the base spans (start, end), sorted by start, cover."""
    starts, ends = [], []
    for a, b in found:  # base spans of all kinds, joined where they overlap
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for m in CANDIDATE.finditer(text):
        at, end = m.span()
        i = bisect_left(ends, at + 1)
        while i < len(ends) and starts[i] < end:
            if starts[i] - at >= LEAST:
                yield at, starts[i]
            at = ends[i]
            i += 1
        if end - at >= LEAST:
            yield at, end


class Automaton:
    """A deterministic probabilistic automaton: for each state, counts of passes, ends and (successor, count) by class."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.ends, self.total, self.next = [0], [0], [{}]
        for s in strings:
            self._add(s.translate(TO_CLASS))
        self._merge(math.sqrt(0.5 * math.log(2 / alpha)))
        self._finish()

    def _add(self, s: str) -> None:
        at = 0
        self.total[0] += 1
        for c in s:
            if c not in self.next[at]:
                self.next[at][c] = [len(self.ends), 0]
                self.ends.append(0)
                self.total.append(0)
                self.next.append({})
            edge = self.next[at][c]
            edge[1] += 1
            at = edge[0]
            self.total[at] += 1
        self.ends[at] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int, z: float) -> bool:
        return abs(f1 / n1 - f2 / n2) > z * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, p: int, q: int, z: float) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            n1, n2 = self.total[p], self.total[q]
            if not n1 or not n2:
                continue
            if self._differ(self.ends[p], n1, self.ends[q], n2, z):
                return False
            a, b = self.next[p], self.next[q]
            for c in a.keys() | b.keys():
                x, y = a.get(c), b.get(c)
                if self._differ(x[1] if x else 0, n1, y[1] if y else 0, n2, z):
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Adds the tree below q to state p."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.ends[p] += self.ends[q]
            self.total[p] += self.total[q]
            for c, (to, n) in self.next[q].items():
                if c in self.next[p]:
                    self.next[p][c][1] += n
                    todo.append((self.next[p][c][0], to))
                else:
                    self.next[p][c] = [to, n]

    def _merge(self, z: float) -> None:
        red = [0]
        while True:
            inside = set(red)
            blue = [(-self.total[to], p, c, to) for p in red for c, (to, _) in self.next[p].items() if to not in inside]
            if not blue:
                break
            _, p, c, q = min(blue)
            for r in red:
                if self._compatible(r, q, z):
                    self.next[p][c][0] = r
                    self._fold(r, q)
                    break
            else:
                red.append(q)
        place = {r: i for i, r in enumerate(red)}
        self.ends, self.total, self.next = [self.ends[r] for r in red], [self.total[r] for r in red], [{c: [place[to], n] for c, (to, n) in self.next[r].items()} for r in red]

    def _finish(self) -> None:
        """Smoothed logarithms."""
        size = len(SIGNS) + 1
        self.steps, self.stop, self.other = [], [], []
        for ends, total, edges in zip(self.ends, self.total, self.next):
            n = max(total, ends + sum(n for _, n in edges.values())) + 0.5 * size
            self.steps.append({c: (to, math.log((k + 0.5) / n)) for c, (to, k) in edges.items()})
            self.stop.append(math.log((ends + 0.5) / n))
            self.other.append(math.log(0.5 / n))

    def score(self, classes: str) -> float:
        at, total = 0, 0.0
        for c in classes:
            step = self.steps[at].get(c)
            if step is None:
                total += self.other[at]
                at = 0
            else:
                at = step[0]
                total += step[1]
        return total + self.stop[at]


def made(shape: tuple, n: int, seed: str) -> list[str]:
    """n strings of a shape, by a fixed draw."""
    rng = random.Random(f"{seed}|{shape}")
    return ["".join(x if isinstance(x, str) else "".join(rng.choices(x[0], k=rng.randint(*x[1:]))) for x in shape) for _ in range(n)]


def joined(tokens: list[str], n: int, sign: str) -> list[str]:
    """n names of two to five pieces of the letters of tokens, joined by a sign; none: each piece starts with a capital, but at times the first."""
    pieces = [p for t in tokens for p in re.findall("[a-z]{2,9}", t.lower())] or ["name", "of", "word"]
    rng = random.Random(f"joined|{sign}")
    out = []
    for _ in range(n):
        some = rng.choices(pieces, k=rng.randint(2, 5))
        if not sign:
            some = [p.capitalize() if i or rng.random() < 0.5 else p for i, p in enumerate(some)]
        elif rng.random() < 0.3:
            some.append(str(rng.randint(0, 9999)))
        out.append(sign.join(some))
    return out


class Background:
    """Automata of ordinary strings: of those of the corpus as they are, and in capitals, since prose may be set in them and the few that are would be lost in merged states; of names and paths made of their letters; and of numbers and dates."""

    def __init__(self, strings: list[str]):
        self.cases = [Automaton(strings), Automaton([s.upper() for s in strings])]
        self.cases += [Automaton(joined(strings, EXAMPLES, sign)) for sign in ("", "_", "-", "/", ".")]
        self.cases += [Automaton(made(shape, EXAMPLES // 3, "plain")) for shape in PLAIN]

    def score(self, classes: str) -> float:
        return max(a.score(classes) for a in self.cases)


class Scanner:
    """Finds all spans of a text; with no automata, the base spans."""

    def __init__(self, formats: dict[str, Automaton], background: Automaton | Background | None, threshold: float = THRESHOLD):
        self.formats, self.background, self.threshold = list(formats.values()), background, threshold
        self.known: dict[str, bool] = {}

    def likelihood(self, token: str) -> float:
        """Log-likelihood of the best format over that of the background, or of equally likely classes if that is more."""
        classes = token.translate(TO_CLASS)
        even = -(len(classes) + 1) * math.log(len(SIGNS) + 1)
        return max(a.score(classes) for a in self.formats) - max(even, self.background.score(classes))

    def secret(self, token: str) -> bool:
        """Whether the likelihood passes the threshold; remembers tokens of the same classes unless they are long."""
        if len(token) > LONGEST:
            return self.likelihood(token) > self.threshold
        classes = token.translate(TO_CLASS)
        if classes not in self.known:
            if len(self.known) > CACHE:
                self.known.clear()
            self.known[classes] = self.likelihood(token) > self.threshold
        return self.known[classes]

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """(start, kind, end) of the base spans, and of all."""
        found = [x[:3] for x in base(text)]
        if not self.formats or self.background is None:
            return found, found
        more = []
        for a, b in candidates(text, [(a, b) for a, _, b in found]):
            if self.secret(text[a:b]):
                more.append((a, 3, b))
            elif "." in text[a:b]:
                more += [(m.start(), 3, m.end()) for m in PART.finditer(text, a, b) if self.secret(m[0])]
        return found, sorted(found + more)


def examples(docs: DataFrame, n: int = DOCS) -> list[tuple[str, str]]:
    """(label, string) from the n documents with the smallest hashes, labelled by the base kinds, or background."""
    keyed = docs.select("text", F.xxhash64("doc_id", "text").alias("h")).where("text is not null")
    least = keyed.select("h").orderBy("h").limit(n).agg(F.max("h")).first()[0]
    if least is None:
        return []

    def run(parts):
        for batch in pieces(parts):
            seen = set()
            for text in batch.column(0).to_pylist():
                spots = base(text)
                seen.update((KINDS[k], s) for _, k, _, s in spots if len(s) <= LONGEST)
                seen.update(("", text[a:b]) for a, b in candidates(text, [(a, b) for a, _, b, _ in spots]) if b - a <= LONGEST)
            rows = sorted(seen, key=lambda x: hashlib.md5(x[1].encode()).digest())
            kept = [x for label in (*KINDS, "") for x in [r for r in rows if r[0] == label][: LABELLED if label else BACKGROUND]]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in kept], pa.string()) for i in (0, 1)], ["label", "string"])

    found = keyed.where(F.col("h") <= F.lit(least)).select("text").mapInArrow(run, "label string, string string")
    return [(r.label, r.string) for r in found.distinct().orderBy(F.md5("string"), "label").collect()]


def fit(docs: DataFrame, n: int = DOCS, labelled: int = LABELLED, threshold: float = THRESHOLD) -> Scanner:
    by: dict[str, list[str]] = {}
    for label, s in examples(docs, n):
        if len(by.setdefault(label, [])) < (labelled if label else BACKGROUND):
            by[label].append(s)
    for label, shape in SHAPES.items():
        by.setdefault(label, []).extend(made(shape, EXAMPLES, label))
    return Scanner({k: Automaton(v) for k, v in sorted(by.items()) if k}, Background(by.get("", [])), threshold)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long"


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(scanner)

    def run(parts):
        scanner = shared.value
        for batch in pieces(parts):
            out = [[] for _ in range(6)]
            for text in batch.column(1):
                found, spans = scanner.spans(text.as_py() or "")
                for k in range(3):
                    out[k].append(sum(1 for x in found if x[1] == k))
                out[3].append(hashlib.sha256(_joined(found).encode()).hexdigest())
                out[4].append(_joined(spans))
                out[5].append(len(spans) - len(found))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(out, kinds)]], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, SCHEMA)


MASK = "[secret]"


def redact(docs: DataFrame, scanner: Scanner, mask: str = MASK) -> DataFrame:
    """The documents with each secret (overlapping spans count as one) replaced; documents without any are unchanged. Columns stay; n_chars follows the text."""
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    columns = docs.columns

    @F.pandas_udf("string")
    def masked(texts):
        import pandas as pd

        out = []
        for text in texts:
            spans = shared.value.spans(text)[1] if text is not None else []
            parts, at = [], 0
            for a, _, b in spans:
                if a >= at:
                    parts += [text[at:a], mask]
                at = max(at, b)
            out.append("".join([*parts, text[at:]]) if spans else text)
        return pd.Series(out, dtype="object")

    out = docs.withColumn("text", masked(docs["text"]))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*columns) if "n_chars" in columns else out.select(*columns)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, fit(docs))
