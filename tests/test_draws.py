"""Draws of whole batches and units against plain Python."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from glyphloom.functions import draws
from glyphloom.operators import fonts, sheets, units


def plain(key, tag):
    return int(hashlib.md5(f"{draws.SEED}|{key}|{tag}".encode()).hexdigest()[:13], 16) / 2**52


def test_batched(spark):
    keys = [0, 9, 10, 10, 99, 100, -1, -10, 2**63 - 1, -(2**63), 2**53 + 1, None, *range(20_000)]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", *[draws.batched(F.col("k"), t).alias(t) for t in ("a", "x" * 60)]).collect()
    assert len(rows) == len(keys)
    for r in rows:
        assert (r[1], r[2]) == ((None, None) if r.k is None else (plain(r.k, "a"), plain(r.k, "x" * 60)))


def test_draws_of_lines_are_made_in_batches(spark):
    """One by one in the JVM they took most of the time of damage plans, styles and metadata."""
    lines = spark.range(3).select(F.col("id").alias("line_id"), F.col("id").alias("page_id"), F.lit(1).alias("n_lines"), F.lit(0).alias("sheet_line_index"))
    plan = sheets.damage_plan(lines).select("effective_profile", "noise")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "draw(" in plan
    plan = sheets.layout(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan


def test_fonts_are_drawn_once(spark):
    pool = fonts.pool(spark.createDataFrame([("a/x.ttf",), ("a/y.ttf",), ("b/x.ttf",)], "path string"))
    lines = spark.createDataFrame([(None,), *((i,) for i in range(50))], "line_id long")
    got = fonts.assign(lines, pool)
    assert got._jdf.queryExecution().executedPlan().toString().count("draw(") == got._jdf.queryExecution().optimizedPlan().toString().count("draw(") == 2
    assert sorted(r.line_id for r in got.collect()) == list(range(50))


def test_numbering_keeps_columns(spark):
    """What is numbered is stored in columns, of which a query reads only its own."""
    rows = units.with_line_ids(spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("text")), "k")
    assert [r.line_id for r in rows.orderBy("k").collect()] == list(range(100))
    plan = rows.agg(F.max("line_id"))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "text" not in plan


def test_odd_documents(spark):
    long = "ab " * 5000
    docs = [(1, b"aaa bbb\xff ccc ddd eee fff ggg hhh"), (1, b"same key, other text of some words"), (None, b"no key has this text at all"), (-7, "a\u061fbcde fg\u00a0hi\u2003jk lm\u3002nop qrs tuv".encode()), (5, None), (6, b""), (7, b"!!abc\n \n?"), (8, long.encode()), (2**62, b"x" * 40 + b" words after one that is too long")]
    given = spark.createDataFrame(docs, "doc_id long, raw binary").select("doc_id", F.col("raw").cast("string").alias("text"))
    for unit, (low, high, mode, least, most) in units.UNITS.items():
        expected = []
        for key, raw in docs:
            for para, p in enumerate(units._PARAGRAPH.split(raw.decode(errors="surrogateescape")) if raw is not None else ()):
                w, at, k = p.split() if len(p.strip()) >= 4 else [], 0, 0
                while at < len(w):
                    u, c = plain(f"{para}/{k}" if key is None else f"{key}/{para}/{k}", "unit"), (mode - low) / (high - low) if high > low else 0
                    n = low if high == low else max(low, min(high, round(low + (high - low) * math.sqrt(u * c) if u <= c else high - (high - low) * math.sqrt((1 - u) * (1 - c)))))
                    piece = w[at : at + n]
                    if least <= len(" ".join(piece)) <= most:
                        expected.append((key, para, k, " ".join(piece).encode(errors="surrogateescape"), len(piece), len(" ".join(piece))))
                    at, k = at + n, k + 1
        got = units.units(given, unit).withColumn("text", F.col("text").cast("binary")).collect()
        assert sorted(map(repr, ((*r[:3], bytes(r[3]), *r[4:]) for r in got))) == sorted(map(repr, expected)), unit


def test_draws_that_run_out():
    """Paragraphs whose first draws don't reach their end are drawn anew."""
    text = b"\n".join(b"a" * 9 + b" b" * n for n in range(3, 400))
    some = units._cut([b"3"], [text], (1, 6, 3, 1, 99), 1)
    assert sum(some[4].to_pylist()) == sum(range(4, 401))
    for para in range(397):
        assert some[2].filter(np.asarray(some[1]) == para).to_pylist()[0] == 0


def test_lines_without_texts(spark):
    """Queries that need no texts of lines neither put them together nor store them."""
    docs = spark.createDataFrame([(i % 40, f"some words of paragraph {i}\nand of the next one {i * i}" * 3) for i in range(90)], "doc_id long, text string").repartition(3)
    every = units.numbered_units(docs, "short_phrase")
    few = units.numbered_units(docs, "short_phrase", columns=("doc_id", "para_idx"))
    assert few.columns == ["doc_id", "para_idx", "line_id"]
    assert sorted(few.collect()) == sorted(every.select(few.columns).collect())
    assert sorted(r.line_id for r in units.numbered_units(docs, "short_phrase", columns=()).collect()) == list(range(every.count()))
    texts = units.numbered_units(docs, "short_phrase", columns=("text",))
    assert sorted(r.text for r in texts.collect()) == sorted(r.text for r in every.collect())
    assert "text" not in units.units(docs, "short_phrase", texts=False).columns


def test_draws_of_sheets_are_made_once_for_each(spark):
    from glyphloom.plans.queries import QUERIES

    for name in ("sheet_layout", "sheet_compaction"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("draw(") < plan.index("Aggregate"), "lines become sheets below the draws"


def test_numbers_of_lines(spark):
    """Where only their numbers are asked for, lines are counted, not moved, sorted or stored."""
    docs = spark.createDataFrame([(i % 40 if i % 7 else None, None if i % 9 == 4 else f"some words of paragraph {i}\nand of the next one {i * i}" * 3) for i in range(90)], "doc_id long, text string").repartition(3)
    for script in ("any", "arabic_no_latin"):
        n = units.numbered_units(docs, "short_phrase", script).count()
        got = units.line_numbers(docs, "short_phrase", script)
        assert got.dtypes == units.numbered_units(docs, "short_phrase", columns=()).dtypes and [r.line_id for r in got.collect()] == list(range(n)), script
    assert n == 0 and units.line_numbers(docs.limit(0)).count() == 0
    plan = units.line_numbers(docs, "word")._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" in plan and "Join" not in plan and "Relation" not in plan
    one = docs.repartition(1)
    assert units.spread(docs, "doc_id") is docs and units.spread(one, "doc_id") is not one


def test_high_sheets(spark):
    """Each line finds its own sheet: no line is moved to a table of sheets."""

    def height(page, n, most):
        row, gap = sheets.ROW_HEIGHTS[math.floor(plain(page, "row") * 3)], 6 + math.floor(plain(page, "gap") * 5)
        over = lambda: max(0, n * (row + gap) + gap - most)
        gap -= min(gap - 4, math.ceil(over() / (n + 1)))
        row -= 2 * min((row - 42) // 2, math.ceil(over() / (2 * n)))
        return max(64, n * (row + gap) + gap)

    def halved(page, n, most):
        if n == 1 or height(page, n, most) <= most:
            return [(page, i, n) for i in range(n)]
        return halved(2 * page + 1, n // 2, most) + halved(2 * page + 2, n - n // 2, most)

    lines = spark.range(1000).select(F.col("id").alias("line_id"), F.lit("t").alias("text"))
    for size, most in ((300, 8000), (64, 100), (64, 700), (7, 200), (64, 16000), (300, 0)):
        got = sheets.split_high(sheets.pages(lines, size), size, most)
        expected = [p for page in range(-(-1000 // size)) for p in (halved(page, min(size, 1000 - page * size), most) if most else [(page, i, min(size, 1000 - page * size)) for i in range(min(size, 1000 - page * size))])]
        assert [(r.page_id, r.sheet_line_index, r.n_lines) for r in got.orderBy("line_id").collect()] == expected, (size, most)
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_texts_stay_where_they_are(spark, monkeypatch):
    """To number lines without texts, a row of numbers for each document is moved."""
    seen, stored = [], units.stored
    monkeypatch.setattr(units, "stored", lambda df: seen.append(df.columns) or stored(df))
    rows = [(None if i % 11 == 3 else i % 40, None if i % 13 == 5 else f"some words of paragraph {i}\nand of the next one {i * i}" * 3) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    names = ["doc_id", "para_idx", "unit_idx"]
    got = units.numbered_units(docs, "short_phrase", columns=tuple(names))
    assert seen[0] == names and len(seen) == 2
    every = units.numbered_units(docs, "short_phrase").select(got.columns)
    assert got.dtypes == every.dtypes and got.orderBy("line_id").collect() == every.orderBy("line_id").collect()
