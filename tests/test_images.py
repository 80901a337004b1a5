"""Kernels, outlines, the output folder and the command line."""

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphloom import config, sinks
from glyphloom.__main__ import main
from glyphloom.functions import jpeg, outlines
from glyphloom.functions import kernels as K
from glyphloom.operators import fonts, metrics, sheets, units
from glyphloom.sources import discover
from glyphloom.streaming import documents

FONTS = Path("/usr/share/fonts/truetype/dejavu")
needs_fonts = pytest.mark.skipif(not FONTS.is_dir(), reason="no fonts")


def image(seed=0):
    a = np.full((48, 200, 3), 250, np.uint8)
    a[18:30, 40:160:7] = 15
    a[20:22, 40:160] = 15
    return a


def plan(name, **on):
    strengths = {"intensity": 0.4, "noise_sigma": 3.0, "band_amplitude": 6.0, "degrees": 0.5, "unsharp_percent": 150, "blur_radius": 0.8}
    return {"effective_profile": name, "jpeg_quality": 80, **dict.fromkeys(sheets.GATES, False), **strengths, **on}


def ink(a, below=128):
    return int((K.gray(a) < below).sum())


@pytest.mark.parametrize("name", [p for p, _ in sheets.PROFILES])
def test_profiles(name):
    a, b = (K.damage(image(), plan(name), 7) for _ in range(2))
    assert a.dtype == np.uint8 and a.shape == image().shape and (a == b).all()
    assert a.mean() > 100 and a.min() < 140
    others = [(K.damage(image(), plan(name), s) != a).any() for s in range(8, 28)]
    assert any(others)


def test_profiles_do_what_they_say():
    rng = lambda: np.random.default_rng(4)
    drawn = lambda name, n=300, **x: [K.profile(image(), name, np.random.default_rng(s), **x) for s in range(n)]
    same = sum((a == image()).all() for a in drawn("digital_clean"))
    assert 0.78 * 300 < same < 0.92 * 300  # paper in 15 of 100
    assert np.mean([ink(a) for a in drawn("thick_scan", 30)]) > ink(image()) > np.mean([ink(a) for a in drawn("thin_scan", 30)])
    spread = lambda a: np.ptp(a.astype(int))
    assert all(spread(a) < 0.85 * spread(image()) for a in drawn("faded_scan", 30))
    assert all(ink(a, 200) > 0 and (K.gray(a) > 200).mean() > 0.5 for a in drawn("overcooked_scan", 30))
    assert ink(K.bloat(image(), rng(), 0.6)) > ink(K.bloat(image(), rng(), 0.1)) and ink(K.photocopy(image(), rng(), 0.8)) > ink(K.photocopy(image(), rng(), 0.1))
    for x in (0.1, 0.3, 0.42, 0.9):
        assert set(np.unique(K.bloat(image(), rng(), x))) <= {0, 255}


@pytest.mark.parametrize("gate", list(sheets.GATES))
def test_gates(gate):
    a = K.damage(image(), plan("book_scan", **{gate: True}), 3)
    grown = gate in ("warp", "rotate")
    assert (a.shape[0] > 48) if grown else (a.shape == image().shape)


def test_clean_and_unknown():
    assert (K.damage(image(), plan("browser_clean", noise=True), 1) == image()).all()
    with pytest.raises(ValueError):
        K.damage(image(), plan("x"), 1)


def test_kernels():
    a, rng = image(), np.random.default_rng(1)
    assert ink(K.morph(a, rng, "thick")) > ink(a) > ink(K.morph(a, rng, "thin"))
    errors = [abs(K.jpeg(a, q).astype(int) - a).mean() for q in (95, 60, 20)]
    assert errors == sorted(errors) and errors[0] < 2
    assert K.rotate(a, 0.04, 8) is a and K.rotate(a, 0.5, 8).shape[0] > 48
    assert (K.resize(np.full((9, 7, 3), 90, np.uint8), 5, 11, "cubic") == 90).all()
    assert (K.resize(a, 48, 200, "area") == a).all()
    assert K.trim(np.full((40, 40, 3), 200, np.uint8), 2, 2).shape == (40, 40, 3)
    assert K.trim(a, 5, 3).shape == (18, 130, 3)
    gap = np.full((5, 20), 255)
    gap[2, [4, 7]] = 0
    assert np.flatnonzero(K.closed(gap, 1, 4)[2] == 0).tolist() == [4, 5, 6, 7] and np.flatnonzero(K.closed(gap, 1, 2)[2] == 0).tolist() == [4, 7]
    for f in (K.shadow, K.stain, K.rule):
        for s in range(40):
            b = f(a, np.random.default_rng(s))
            assert b.shape == a.shape and b.dtype == np.uint8 and (b != a).any()
        tiny = np.full((2, 3, 3), 250, np.uint8)
        assert f(tiny, rng).shape == tiny.shape
    warped = K.warp(a, rng, 0.025, 32)
    assert warped.shape == (48 + 64, 200 + 64, 3) and (warped[:4] == 255).all() and (warped[:, :4] == 255).all()


def pixels_by_the_jvm(spark, data):
    jvm = spark._jvm
    got = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(data))
    h, w = got.getHeight(), got.getWidth()
    x = np.array(list(got.getRGB(0, 0, w, h, None, 0, w))).reshape(h, w)
    return np.stack([x >> 16 & 255, x >> 8 & 255, x & 255], 2)


@pytest.mark.parametrize("shape", [(48, 200), (1, 1), (17, 33), (16, 16), (64, 1240)])
def test_jpeg_by_another_reader(spark, shape):
    rng = np.random.default_rng(3)
    a = np.full((*shape, 3), (250, 240, 225), np.uint8)
    a[shape[0] // 3 : shape[0] // 2, ::7] = 15
    a = K.noise(a, rng, 8.0) if shape[0] > 1 else a
    for quality in (20, 88, 100):
        data = jpeg.encode(a, quality)
        own = jpeg.pixels(jpeg.coefficients(a, quality), quality, *shape).astype(int)
        other = pixels_by_the_jvm(spark, data)
        assert data[:3] == b"\xff\xd8\xff" and other.shape == a.shape
        assert abs(other - own).mean() < 2 and abs(K.gray(other) - K.gray(own)).max() < 4  # readers differ in how they spread chroma
    noise = rng.integers(0, 256, (*shape, 3)).astype(np.uint8)
    assert abs(K.gray(pixels_by_the_jvm(spark, jpeg.encode(noise, 100))) - K.gray(noise)).mean() < 8


def test_shaping():
    assert outlines.shaped("abc") == [97, 98, 99]
    assert outlines.shaped("بب") == [0xFE90, 0xFE91]  # final stands left of initial
    assert outlines.shaped("ا") == [0xFE8D]
    assert outlines.shaped("ب a b 12")[:6] == [ord(c) for c in "a b 12"]
    assert outlines.shaped("") == []


@needs_fonts
def test_outlines():
    font = outlines.Font((FONTS / "DejaVuSans.ttf").read_bytes())
    a, size = outlines.draw(font, "Hello é", 64, 400, 30, (0, 0, 0), (255, 255, 255), 10)
    assert a.shape == (64, 400, 3) and size == 30 and 0.01 < (a < 128).mean() < 0.2
    assert outlines.draw(font, "x" * 60, 64, 400, 30, (0, 0, 0), (255, 255, 255), 10)[1] == 14
    assert outlines.measure(font, "ab", 20, letter=1) == pytest.approx(outlines.measure(font, "ab", 20) + 2)
    assert (outlines.draw(font, "", 64, 400, 30, (0, 0, 0), (255, 255, 255), 10)[0] == 255).all()
    right = outlines.draw(font, "سلام", 64, 400, 30, (0, 0, 0), (255, 255, 255), 10)[0]
    assert (right[:, 200:] < 128).any() and not (right[:, :200] < 128).any()


@needs_fonts
def test_run_and_resume(spark, tmp_path):
    src, out = tmp_path / "a.txt", tmp_path / "out"
    src.write_text("one two three four five six seven eight nine ten eleven twelve thirteen fourteen", encoding="utf-8")
    args = ["--output-dir", str(out), "--fonts-dir", str(FONTS), "--font-include-regex", "sansmono", "--source", f"{src}:text", "--target-unit", "short_phrase", "--val-count", "1"]
    assert main([*args, "--max-lines", "2"]) == 0
    first = {p.name: p.read_bytes() for p in (out / "images").iterdir()}
    assert len(first) == 2
    assert main(args) == 0
    rows = [json.loads(x) for x in (out / "metadata.jsonl").read_text().splitlines()]
    assert [r["line_id"] for r in rows] == list(range(len(rows))) and len(rows) > 2
    assert set(sheets.METADATA) <= set(rows[0]) and all((out / "images" / r["filename"]).exists() for r in rows)
    assert all((out / "images" / n).read_bytes() == data for n, data in first.items())
    lines = (out / "train_list.txt").read_text().splitlines() + (out / "val_list.txt").read_text().splitlines()
    assert sorted(lines) == sorted(f"images/{r['filename']}\t{r['text']}" for r in rows)
    assert sinks.state(spark, str(out)).max_line_id == len(rows) - 1
    for r in rows:
        assert r["filename"] == f"line_{r['line_id']:010d}.jpg"
        assert pixels_by_the_jvm(spark, (out / "images" / r["filename"]).read_bytes()).shape == (r["image_height"], r["image_width"], 3)
    (out / "metadata.jsonl").write_text("")
    assert main(args) == 1
    (out / "mine").write_text("x")
    sinks.clear(str(out))
    assert [p.name for p in out.iterdir()] == ["mine"]


@needs_fonts
def test_labels_and_fallback(spark, tmp_path):
    (tmp_path / "l.txt").write_text("a.png\tfirst label\nb.png\tsecond label\n")
    bad = tmp_path / "fonts"
    bad.mkdir()
    (bad / "zzz.ttf").write_bytes(b"no font")
    (bad / "Good.ttf").write_bytes((FONTS / "DejaVuSans.ttf").read_bytes())
    args = ["--output-dir", str(tmp_path / "o"), "--fonts-dir", str(bad), "--label-source-manifest", str(tmp_path / "l.txt"), "--label-source-repeat", "6", "--label-source-shuffle", "--fallback-renderer", "plain"]
    assert main([*args, "--dry-run"]) == 0 and not (tmp_path / "o").exists()
    assert main(args) == 0
    rows = [json.loads(x) for x in (tmp_path / "o" / "metadata.jsonl").read_text().splitlines()]
    assert len(rows) == 12 and {r["label_repeat_index"] for r in rows} == set(range(6))
    assert all((r["render_fallback"] == "plain_line") == r["font_path"].endswith("zzz.ttf") for r in rows)


@needs_fonts
def test_reject_guard_and_measures(spark, tmp_path, capsys):
    (tmp_path / "l.txt").write_text("".join(f"label number {i}{' very long' * (i % 2 * 9)}\n" for i in range(12)))
    args = ["--fonts-dir", str(FONTS), "--label-source-manifest", str(tmp_path / "l.txt"), "--sheet-lines", "4", "--bench-every", "2"]
    assert main([*args, "--output-dir", str(tmp_path / "a"), "--browser-max-screenshot-height", "50"]) == 1
    assert "--sheet-lines" in capsys.readouterr().err
    assert main([*args, "--output-dir", str(tmp_path / "a"), "--browser-max-screenshot-height", "50", "--fallback-renderer", "pil"]) == 0
    assert all("sheet too high" in json.loads(x)["fallback_reason"] for x in (tmp_path / "a" / "metadata.jsonl").read_text().splitlines())
    assert main([*args, "--output-dir", str(tmp_path / "b"), "--browser-max-screenshot-height", "150"]) == 0
    halves = [json.loads(x) for x in (tmp_path / "b" / "metadata.jsonl").read_text().splitlines()]
    assert [(r["sheet_page_id"], r["sheet_line_index"]) for r in halves] == [(2 * p + 1 + i // 2, i % 2) for p in range(3) for i in range(4)] and all(r["sheet_height"] <= 150 for r in halves)
    capsys.readouterr()
    assert main([*args, "--output-dir", str(tmp_path / "o"), "--reject-crop-width-over", "700"]) == 0
    said = capsys.readouterr().out
    rows = [json.loads(x) for x in (tmp_path / "o" / "metadata.jsonl").read_text().splitlines()]
    assert 0 < len(rows) < 12 and all(r["image_width"] <= 700 for r in rows) and len(list((tmp_path / "o" / "images").iterdir())) == len(rows)
    bench = [x for x in said.splitlines() if x.startswith("[bench] pages=")]
    assert [x.split()[1] for x in bench] == ["pages=2", "pages=1"] and sum(int(x.split("rejected_width=")[1].split()[0]) for x in bench) == 12 - len(rows)
    assert "labels: raw 12, empty 0, script 0, duplicates 0, accepted 12" in said and "fonts: files" in said


def test_font_folders(spark, tmp_path):
    for name, data in {"a/X-Bold.ttf": "1", "a/copy.otf": "1", "b/x bold.otc": "2", "b/x_bold.ttf": "3", "b/x-bold.woff2": "4", "b/readme.txt": "5", "b/Math.ttf": "6"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(data)
    folders = [str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "none")]
    one = discover.font_counts(discover.judged_fonts(spark, folders, exclude="math")).first().asDict()
    assert one == {"files": 7, "duplicates": 1, "include_skipped": 0, "exclude_skipped": 1, "accepted": 3, "families": 1}
    alone = discover.font_files(spark, folders, grouped=False, exclude="math", suffixes=(*discover.SUFFIXES, *discover.WEB_SUFFIXES)).collect()
    assert sorted(r.family for r in alone) == ["x-bold", "x-bold_0001", "x_bold", "x_bold_0001"]
    assert discover.font_counts(discover.judged_fonts(spark, folders, distinct=False, include="copy")).first().include_skipped == 4


def test_large_font_pools(spark):
    n = 25_000
    pool = spark.range(n).select(F.format_string("f%06d", "id").alias("family"), F.format_string("/%06d.ttf", "id").alias("path"), F.col("id").cast("int").alias("family_idx"), F.lit(0).alias("variant_idx"), F.lit(1).cast("long").alias("n_variants"))
    got = fonts.assign(spark.range(20_000).withColumnRenamed("id", "line_id"), pool)
    row = got.agg(F.count("*").alias("n"), F.count_if(F.col("family_idx") >= 20000).alias("late"), F.max("family_idx").alias("most")).first()
    assert row.n == 20_000 and 3600 < row.late < 4400 and row.most > 24_900


def test_measures(spark):
    parts = spark.createDataFrame([(0, 3, 30, 10), (0, 1, 10, 50), (1, 0, 5, 9), (2, 2, 1, 1)], "page_id long, lines long, whole long, each long")
    merged = metrics.merged(parts, ("whole",), ("each",))
    assert sorted(tuple(r) for r in merged.select("page_id", "lines", "whole", "each").collect()) == [(0, 4, 40, 20), (1, 0, 5, 0), (2, 2, 1, 1)]
    rolled = metrics.rollup(merged, ("lines",), ("whole", "each"), 2)
    assert sorted(tuple(r) for r in rolled.select("part", "pages", "lines", "whole", "each").collect()) == [(0, 2, 4, 45, 20), (1, 1, 2, 1, 1)]


@pytest.mark.parametrize("bad", [["--line-words-min", "0"], ["--word-chars-min", "30"], ["--phrase48-words-mode", "11"], ["--crop-pad-x", "-1"], ["--label-source-repeat", "0"], ["--photocopy-bleed-intensity-max", "1.5"], ["--resume", "--overwrite"], ["--reject-crop-width-over", "-2"]])
def test_options(bad):
    with pytest.raises(ValueError):
        config.check(config.parser().parse_args(bad))


def test_defaults(tmp_path):
    o = config.check(config.parser().parse_args(["--crop-pad-x", "5"]))
    assert (o.crop_pad_x_min, o.crop_pad_x_max) == (5, 5) and config.unit(o) == units.UNITS["line"]
    assert discover.default_sources(str(tmp_path / "none")) == []
    for name in ("ckbwiki-latest-pages-articles.xml.bz2", "kuwiki-latest-pages-articles1.xml", "other.xml"):
        (tmp_path / name).write_text("x")
    assert len(discover.default_sources(str(tmp_path))) == 2
    assert discover.availability([f"{tmp_path}/other.xml:text", f"{tmp_path}/gone:text"])[1] == [f"{tmp_path}/gone:text"]
    got = discover.download("x", str(tmp_path / "d"), (tmp_path / "other.xml").as_uri())
    assert Path(got).read_text() == "x"
    with pytest.raises(ValueError):
        discover.download("nothing", str(tmp_path))


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i, lines in enumerate((["a", "b", "a"], ["b", "c"])):
        (src / f"{i}.txt").write_text("\n".join(lines))
        docs = documents.lines(spark, str(src)).withColumn("doc_key", F.sha1("line"))
        documents.write(documents.distinct(docs, seen="seen"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_interleave_sums(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("source"))
    got = {n: {r.doc_id: round(r.arrival, 9) for r in units.interleave(docs.repartition(n)).collect()} for n in (1, 6)}
    assert got[1] == got[6] and len(got[1]) == 500
    for s in (0, 1):
        own = [got[1][i] for i in sorted(got[1]) if (i % 3 == 0) == bool(s)]
        assert own == sorted(own)
