"""Nulls, very long texts, repeated rows and clashing columns, for the operators that read documents."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from glyphloom.llm import jaccard, media, quality, secrets, substrings, tokens

DIR = "/root/testdata/sf0.001"
CLASHES = ("raw", "h", "key", "content", "label", "held_out", "score", "size", "copies", "sha", "places", "component", "spans", "n", "bits", "first", "want", "blocks")
KEY = "password=1234567890abcdef"
LONG = " ".join(f"w{i % 997}x{i // 997}" for i in range(150_000)) + " " + KEY
ROWS = [(1, LONG, "en", "s"), (1, LONG, "en", "s"), (2, "a few words only", None, None), (3, None, "en", "s"), (4, "", "en", "s"), (None, "a few words only", "en", "s"), (None, None, None, None), (5, "  x", "en", "s"), (6, "z" * 200_000, "en", "s")]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return docs.select("*", *(F.lit(f"mine {c}").alias(c) for c in CLASHES)).repartition(2).cache()


def test_scan(odd):
    got = sorted(secrets.scan(odd, secrets.fit(odd)).select("doc_id", "n_assign", "spans").collect(), key=repr)
    assert len(got) == len(ROWS)
    mine = [r.spans for r in got if r.doc_id == 1]
    assert len(mine) == 2 and mine[0] == mine[1] and mine[0].split(",") == [f"assign:{len(LONG) - len(KEY)}:{len(LONG)}", f"hex:{len(LONG) - 16}:{len(LONG)}"]
    assert all(r.spans == "" for r in got if r.doc_id in (2, 3, 4, 5, 6, None))
    clean = secrets.redact(odd, secrets.fit(odd))
    assert clean.columns == odd.columns and clean.where("key <> 'mine key' or spans <> 'mine spans'").count() == 0


def test_scores(odd, spark):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    model = quality.fit(spark.read.parquet(f"{DIR}/documents.parquet"), labels)
    got = defaultdict_of(quality.score(odd, model).collect(), "doc_id")
    assert sum(map(len, got.values())) == len(ROWS) and len({r.score for r in got[1]}) == 1
    assert {r.score for i in (3, 4) for r in got[i]} == {round(model.prior, 5)} and not any(r.held_out for r in got[None])
    i = next(i for i in (1, 2, 4, 5, 6) if zlib.crc32(str(i).encode()) % 3 != 1)
    ties = spark.createDataFrame([(i, 0), (i, 1), (i, None), (None, 1)], "doc_id long, quality int")
    own = quality.fit(odd, ties)
    assert set(own.labels.tolist()) == {0.0} and {r.score for r in quality.score(odd.where(f"doc_id = {i}"), own).collect()} == {0.0}
    assert quality.keep(odd, None).count() == len(ROWS)


def defaultdict_of(rows, key):
    out = {}
    for r in rows:
        out.setdefault(r[key], []).append(r)
    return out


def test_repeats(odd):
    got = defaultdict_of(substrings.dedup(odd).collect(), "doc_id")
    assert sum(map(len, got.values())) == len(ROWS)
    assert sorted((r.n_words, r.n_removed) for r in got[1]) == [(150_001, 0), (150_001, 150_001)]
    assert {r.kept_sha256 for r in got[1]} == {hashlib.sha256(LONG.encode()).hexdigest(), hashlib.sha256(b"").hexdigest()}
    assert all(r.n_removed == 0 for i, rs in got.items() if i != 1 for r in rs)
    assert [r.n_words for r in got[5]] == [1] and [r.n_words for r in got[6]] == [1]


def test_components(odd):
    got = defaultdict_of(jaccard.join(odd).collect(), "doc_id")
    assert sum(map(len, got.values())) == len(ROWS)
    assert {(r.n_shingles, r.component_id) for r in got[1]} == {(149_999, 1)}
    assert sorted((r.n_shingles, r.component_id) for r in got[None] if r.n_shingles) == [(2, 2)]  # null is tied to 2
    assert {(r.n_shingles, r.component_id) for i in (3, 4) for r in got[i]} == {(0, 3), (0, 4)} and [r.n_shingles for r in got[5]] == [1]
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 6] and kept.where("doc_id is null").count() == 2


def test_many_rows_without_an_id(spark):
    rows = [(None, f"text {i // 2} of many rows without an id") for i in range(300)] + [(9, "text 7 of many rows without an id")]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 301 and sum(r.component_id == 9 for r in got) == 3


def test_counts_and_files(odd):
    tokenizer = tokens.load()
    counted = defaultdict_of(tokens.count(odd).collect(), "doc_id")
    stored = defaultdict_of(media.digests(odd).collect(), "doc_id")
    for i, t, *_ in ROWS:
        raw = (t or "").encode()
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        assert (len(raw), n, n > 2048) in {(r.n_bytes, r.n_tokens, r.over_limit) for r in counted[i]}
        payload = media.pad(raw)
        assert (len(raw), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])) in {(r.n_bytes, r.payload_sha256, r.tail_crc32) for r in stored[i]}
    assert sum(map(len, counted.values())) == sum(map(len, stored.values())) == len(ROWS)
    assert len({r.media_sha256 for r in stored[1]}) == 1
