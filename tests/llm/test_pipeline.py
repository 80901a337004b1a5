"""The classifier and the pipeline against plain Python that shares no code with them but the automata of the secret scan and the tokenizer."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from glyphloom.llm import packing, quality, secrets

DIR = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def trigram_buckets(raw: bytes, buckets=4096):
    """Counts of hashed byte trigrams, one by one in whole numbers."""
    out, low = Counter(), 0xFFFFFFFF
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        h = a * 2654435761 + b * 2246822519 + c * 3266489917 & low
        h = (h ^ h >> 15) * 2654435769 & low
        out[h >> 32 - buckets.bit_length() + 1] += 1
    return out


def marks(raw: bytes):
    words = WORD.findall(raw)
    if len(words) < 8:
        return []
    again = sum(a == b for a, b in zip(words, words[1:])) / len(words)
    new = sum(len(set(words[i : i + 256])) for i in range(0, len(words), 256)) / len(words)
    return [sum(again >= x for x in (0.01, 0.02, 0.04, 0.08, 0.16, 0.32)), 7 + sum(new >= x for x in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6))]


class Votes:
    """Rebuilds the vote: weights from the rows that may be learned from, an exact decomposition for the latent space, cosines one by one."""

    def __init__(self, texts: dict[int, bytes], labels: dict[int, int], dim=48, nearest=25, power=8):
        self.nearest, self.power = nearest, power
        self.ids = [i for i in sorted(texts) if i in labels and zlib.crc32(str(i).encode()) % 3 != 1]
        counts = [trigram_buckets(texts[i]) for i in self.ids]
        seen = Counter(b for c in counts for b in c)
        self.idf = {b: math.log((1 + len(counts)) / (1 + seen.get(b, 0))) + 1 for b in range(4096)}
        x = np.stack([self.vector(texts[i]) for i in self.ids])
        _, _, vt = np.linalg.svd(x, full_matrices=False)
        self.base = vt[: min(dim, *x.shape)].T
        self.points = [self.unit(row @ self.base) for row in x]
        self.labels = [labels[i] for i in self.ids]

    @staticmethod
    def unit(v):
        n = math.sqrt(float(v @ v))
        return v / n if n else v

    def vector(self, raw: bytes):
        v = np.zeros(4096 + 14)
        for b, n in trigram_buckets(raw).items():
            v[b] = math.log1p(n) * self.idf[b]
        v = self.unit(v)
        for m in marks(raw):
            v[4096 + m] = 0.6
        return v

    def score(self, raw: bytes) -> float:
        p = self.unit(self.vector(raw) @ self.base)
        near = sorted(((float(p @ q), y) for q, y in zip(self.points, self.labels)), reverse=True)[: self.nearest]
        weights = [(max(s, 0.0) ** self.power, y) for s, y in near]
        total = sum(w for w, _ in weights)
        return sum(w * y for w, y in weights) / total if total else sum(self.labels) / len(self.labels)


@pytest.fixture(scope="module")
def tables(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    labels = {}
    for r in spark.read.parquet(f"{DIR}/labels.parquet").collect():
        if r.quality is not None:
            labels[r.doc_id] = min(r.quality, labels.get(r.doc_id, r.quality))
    return docs, labels


def test_quality_by_plain_votes(spark, tables):
    docs, labels = tables
    votes = Votes({d["doc_id"]: (d["text"] or "").encode() for d in docs}, labels)
    found = {r.doc_id: r for r in quality.query(spark, DIR).collect()}
    assert len(found) == len(docs)
    for d in docs:
        r = found[d["doc_id"]]
        assert r.score == pytest.approx(votes.score((d["text"] or "").encode()), abs=0.02), d["doc_id"]  # the latent space is iterated in single precision
        assert r.held_out == (zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5)


def test_quality_needs_no_marks(spark):
    """What the trigrams alone tell of held-out rows."""
    docs, labels = spark.read.parquet(f"{DIR}/../sf0.01/documents.parquet"), spark.read.parquet(f"{DIR}/../sf0.01/labels.parquet")
    model = quality.fit(docs, labels)
    held = docs.where(quality.held_out()).join(labels, "doc_id").where("quality is not null").select("text", "quality").toPandas()
    counts = np.stack([quality.features((t or "").encode()) for t in held.text])
    assert ((model.scores(counts) >= 0.5) == held.quality).mean() > 0.95
    counts[:, quality.BUCKETS :] = 0
    assert ((model.scores(counts) >= 0.5) == held.quality).mean() > 0.9


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain_near_duplicates(docs):
    """One of each component of pairs at 0.8 and more, all pairs compared."""
    sets = [shingles(d["text"]) for d in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
                    root[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i]["doc_id"])
    return {min(ids) for ids in groups.values()}


def plain_mixture(docs, seed=20240):
    """(doc_id, text) as often as taken."""
    sizes = [len(WORD.findall((d["text"] or "").encode())) for d in docs]
    per = Counter()
    for d, n in zip(docs, sizes):
        per[d["source"]] += n
    names = sorted((s for s in per if s is not None), key=str.encode) + [None] * (None in per)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, total, free = {}, 1.5 * sum(sizes), set(names)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * per[s]}
        target |= {s: 2.0 * per[s] for s in over} if over else {s: weight[s] * level for s in free}
        free = free - over if over else set()
    out = []
    for d in docs:
        rate = min(2.0, target[d["source"]] / per[d["source"]]) if per[d["source"]] else 1.5
        key = f"{seed}|{'' if d['doc_id'] is None else d['doc_id']}|{d['text'] or ''}"
        draw = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52
        out += [(d["doc_id"], d["text"] or "")] * (math.floor(rate) + (draw < rate - math.floor(rate)))
    return out


def redacted(text, scanner):
    spans, out, at = scanner.spans(text)[1], [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], "[secret]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def check_pieces(rows, mixture):
    """Every id of every copy lies in one piece, in order; sequences are gapless and not too long."""
    tokenizer = packing.Encoder().tokenizer
    ids = {t: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4") for t in {t for _, t in mixture}}
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[r.document].append(r)
        sequences[r.sequence_id].append(r)
    crc = lambda x: zlib.crc32(x.tobytes())
    whole = Counter()
    for parts in documents.values():
        parts.sort(key=lambda r: r.start)
        assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts[:-1]]).tolist() and sum(p.length for p in parts) == parts[0].doc_tokens
        whole[parts[0].doc_id, tuple((p.length, p.ids_crc32) for p in parts)] += 1
    cut = defaultdict(list)  # the ways in which the copies of a document were cut
    for (key, pieces), n in whole.items():
        cut[key] += [pieces] * n
    for (key, text), n in Counter(mixture).items():
        mine = [p for p in cut[key] if sum(x for x, _ in p) == len(ids[text]) and all(crc(ids[text][a : a + x]) == c for a, (x, c) in zip(np.cumsum([0] + [x for x, _ in p[:-1]]), p))]
        assert len(mine) == n, key
    assert len(documents) == len(mixture)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [p.offset for p in parts] == np.cumsum([0] + [p.length for p in parts[:-1]]).tolist() and sum(p.length for p in parts) <= 2048


def test_pipeline_by_plain_python(spark, tables):
    docs, labels = tables
    votes = Votes({d["doc_id"]: (d["text"] or "").encode() for d in docs}, labels)
    scores = {d["doc_id"]: votes.score((d["text"] or "").encode()) for d in docs}
    first = [r.asDict() for r in corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{DIR}/documents.parquet"), DIR).collect()]
    kept = {d["doc_id"] for d in first}
    for i, s in scores.items():
        assert abs(s - 0.5) < 0.02 or (i in kept) == (s >= 0.5), i
    stay = plain_near_duplicates(first)
    second = [d for d in first if d["doc_id"] in stay]
    scanner = secrets.fit(spark.createDataFrame([(d["doc_id"], d["text"]) for d in second], "doc_id long, text string"))
    third = [{**d, "text": redacted(d["text"], scanner)} for d in second]
    check_pieces(corpus_pipeline.run(spark, DIR).collect(), plain_mixture(third))


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, copies, repeated ids, and columns with names that stages work with."""
    near = " ".join(f"w{i}" for i in range(400))
    rows = [(1, "hello world, this is fine. " * 30, "en", "a", 1), (1, "hello world, this is fine. " * 30, "en", "a", 1), (2, near, "en", "b", 2), (3, near + " more", None, "b", None), (4, None, "en", "a", 0), (5, "", "en", None, 0), (None, None, None, None, None)]
    rows += [(None, "a text without an id that holds password=1234567890abcdef", "en", "c", 3), (6, " " * 300_000 + "x", "en", "d", 4), (7, "abc " * 100_000, "en", "d", 5), (8, "\n\t", "en", "d", 6)]
    docs = spark.createDataFrame([(*r, "s", "h", "k", 1, 2, "m") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, size string, h string, keep string, copies long, mix_copies long, known_host string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, 1, 0), (4, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == docs.columns
        assert step.where("keep <> 'k' or size <> 's' or mix_copies <> 2").count() == 0
    assert step.where("text like '%1234567890abcdef%'").count() == 0
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_pieces(out, [(r.doc_id, r.text or "") for r in step.select("doc_id", "text").collect()])
    empty = tmp_path / "empty"
    docs.limit(0).write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(empty / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_pipeline_filters_take_effect(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    counts = [docs.count()]
    step = docs
    for _, stage in corpus_pipeline.STAGES[:2]:
        step = stage(spark, step, DIR)
        counts.append(step.count())
    assert counts[0] > counts[1] > counts[2] > 0
    assert step.agg(F.count_distinct("doc_id")).first()[0] == counts[2]
