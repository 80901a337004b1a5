"""Golden strings."""

import pytest
from pyspark.sql import functions as F

from glyphloom.functions import text as T
from glyphloom.operators import fonts, sheets, units
from glyphloom.sources import files, jsonl

TW = "ـ"


def value(spark, f, s):
    return spark.createDataFrame([(s,)], "s string").select(f(F.col("s"))).first()[0]


@pytest.mark.parametrize(
    ("options", "given", "expected"),
    [
        ({}, f"ب{TW}ب", "بب"),
        ({}, f"ب{TW}", f"ب{TW}"),
        ({}, f"ا{TW}", "ا-"),
        ({}, f"{TW}ب", "ب"),
        ({}, f"ب {TW} ب", "ب - ب"),
        ({}, f"ب{TW}\u064e{TW}ب", "ب\u064eب"),
        ({}, f"ب{TW}\u200eب", f"ب{TW}ب"),
        ({}, f"ب{'\u064e' * 500}{TW}{'\u064e' * 70}{TW}", f"ب{'\u064e' * 500}{TW}{'\u064e' * 70}{TW}"),
        ({}, f"ا{'\u064e' * 500}{TW}\u064e{TW}{TW} {TW}x{TW}{TW}", f"ا{'\u064e' * 500}-\u064e-- -x--"),
        ({}, f"ب{TW}{TW}x{TW}ب{TW}", f"ب{TW}{TW}xب{TW}"),
        ({"profile": "none"}, f"ب{TW}ب", f"ب{TW}ب"),
        ({}, "كىي", "کیي"),
        ({"yeh": True}, "يب بي", "یب بي"),
        ({"profile": "none"}, "a\u00adb\u200dc\u200cd", "abc\u200cd"),
        ({"zwnj": True}, "a\u200cb", "ab"),
        ({"marks": True}, "ب\u064e\u0670", "ب"),
        ({}, " a \t b\n\n\n\nc ", "a b\n\nc"),
        ({}, "a\n \n\nb", "a\n \n\nb"),
        ({}, "\u00a0a\u00a0b\u00a0", "a\u00a0b"),
    ],
)
def test_normalize(spark, options, given, expected):
    assert value(spark, lambda c: T.normalize_label(c, **options), given) == expected


def test_context_is_looked_up_in_batches(spark):
    """Java tries all ranges of a class on each character: tatweels of 0.1 GB took a minute."""
    rows = spark.createDataFrame([(f"ب{TW}ب يَب",), (None,), ("",)], "s string")
    for f in (T.tatweel, T.yeh_nonfinal, lambda c: T.passes_script(c, "arabic_no_latin_digit")):
        plan = rows.select(f(F.col("s")))._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan and "regexp_replace" not in plan
    assert [tuple(r) for r in rows.select(T.tatweel(F.col("s")), T.yeh_nonfinal(F.col("s")), T.passes_script(F.col("s"), "arabic_no_latin_digit")).collect()] == [("بب يَب", f"ب{TW}ب یَب", True), (None, None, None), ("", "", False)]
    many = spark.createDataFrame([([f"ا{TW}", None, "x"],), (None,), ([],)], "s array<string>")
    assert [r[0] for r in many.select(T.tatweel(F.col("s"), many=True)).collect()] == [["ا-", None, "x"], None, []]
    cut = spark.createDataFrame([(f"ب{TW}ب".encode() + b"\xff",)], "s binary").select(T.tatweel(F.col("s").cast("string")).cast("binary"))
    assert bytes(cut.first()[0]) == "بب".encode() + b"\xff"


def test_unknown_profile(spark):
    with pytest.raises(ValueError):
        T.normalize_label(F.lit("a"), profile="x")
    with pytest.raises(ValueError):
        T.passes_script(F.lit("a"), "x")


@pytest.mark.parametrize(("given", "expected"), [("&lt;b&gt;x&lt;/b&gt;<p>y</p>z", "x y\nz"), ("a<br>b</br>c", "a b\nc")])
def test_html(spark, given, expected):
    assert value(spark, T.clean_html, given) == expected


def test_wikitext(spark):
    assert value(spark, T.clean_wikitext, "{{a{{b}}c}} '''x''' [[p|q]] [[r]] <ref>s</ref>") == "{{a c}} x q r s"


def test_blocks(spark):
    join = lambda *b: spark.range(1).select(T.join_unique_blocks(F.array(*map(F.lit, b)))).first()[0]
    assert join("Title", "TITLE ", "body") == "Title\n\nbody"
    assert join("STRASSE", "straße") == "STRASSE"
    assert join("ΣΑΣ", "σας", "ﬁn", "FIN", "ŉx", "ʼNX", "ı", "i", "ẞ", "ss") == "ΣΑΣ\n\nﬁn\n\nŉx\n\nı\n\ni\n\nẞ"


def test_hooks(spark):
    up = lambda c: F.upper(c)
    assert value(spark, lambda c: T.normalize_label(c, transliterate=lambda x: F.replace(x, F.lit("a"), F.lit("b")), outer=up), "xa ") == "XB"
    assert value(spark, lambda c: T.clean_wikitext(c, parser=lambda x: F.regexp_extract(x, "<b>(.*)</b>", 1)), "{{a}} <b>x</b> [[p|q]]") == "x"
    lines = spark.createDataFrame([(0, "f", i, f'{{"id": {i + 1}, "lang": "{lang}", "text": "{"y" * 60}"}}') for i, lang in enumerate(("en", "xx", ""))], "source_idx int, file string, n long, line string")
    got = {r.doc_key: r.text for r in jsonl.first_documents(lines, outer=up).collect()}
    assert got == {"1": "y" * 60, "2": "Y" * 60, "3": "Y" * 60}


@pytest.mark.parametrize(("mode", "given", "expected"), [("arabic_no_latin", "سل é", True), ("arabic_no_latin", "سل ö", False), ("arabic_no_latin_digit", "سل²", False), ("arabic_letters_marks_space", "س١،", True), ("arabic_letters_marks_space", "س\u200cل", False)])
def test_script(spark, mode, given, expected):
    assert value(spark, lambda c: T.passes_script(c, mode), given) is expected


@pytest.mark.parametrize(("given", "expected"), [("vendor/MyFont-Bold.ttf", "myfont"), ("noto/Regular-Bold.ttf", "noto"), ("Bold.ttf", "bold")])
def test_family(spark, given, expected):
    assert value(spark, fonts.family_key, given) == expected


def test_words(spark):
    docs = spark.createDataFrame([(1, "hello؟ab cd!x")], "doc_id long, text string")
    assert [r.text for r in units.units(docs, "word").orderBy("para_idx", "unit_idx").collect()] == ["hello", "ab", "cd"]


def test_compaction(spark):
    df = spark.range(1).select(F.lit(300).alias("n_lines"), F.col("id").alias("page_id"))
    r = sheets.layout(df).first()
    assert r.sheet_height <= 16000 and r.compacted and r.gap == 4


def test_line_ids_any_partitions(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    for n in (1, 7):
        got = units.with_line_ids(rows.repartition(n), "k").collect()
        assert all(r.line_id == r.k for r in got) and len(got) == 1000


def test_files(spark, tmp_path):
    lines = ['{"id": 0, "uuid": "u", "title": "T", "text": "' + "x" * 60 + '"}', "", "{broken", "[1]", '{"id": "a", "text": "short"}', '{"id": "a", "text": "' + "y" * 60 + '"}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    got = jsonl.documents(spark, str(tmp_path / "a.jsonl")).collect()
    assert [(r.doc_key, r.title) for r in got] == [("u", "T")]
    (tmp_path / "b.jsonl").write_text("\n".join(['{"id": "u", "text": "' + "z" * 60 + '"}', '{"id": "new", "text": "' + "z" * 60 + '"}']))
    both = files.read(spark, [f"{tmp_path}/b.jsonl:jsonl", f"{tmp_path}/a.jsonl:jsonl"])
    assert sorted((r.source_idx, r.text[:1]) for r in both.collect()) == [(0, "z"), (0, "z")]  # u is taken from the first of the sources
    for i in range(3):
        (tmp_path / f"t{i}.txt").write_text(f"{i} " + "w" * 60)
    assert [r.text[0] for r in files.read(spark, [f"{tmp_path}/t{i}.txt:text" for i in range(3)]).collect()] == ["0", "1", "2"]
    assert files.read(spark, [f"{tmp_path}/t*.txt:text", f"{tmp_path}/t0.txt:text"], skip=1).count() == 2
    page = lambda title, body, more="": f"<page><title>{title}</title>{more}<revision><text xml:space='preserve'>{body}</text></revision></page>"
    (tmp_path / "w.xml").write_text("<mediawiki>" + page("A", "a" * 100) + page("B", "b" * 99) + page("C", "c" * 200, "<redirect title='A'/>") + "</mediawiki>")
    assert [r.title for r in files.wikipedia(spark, str(tmp_path / "w.xml")).collect()] == ["A"]
    (tmp_path / "l.txt").write_text("\ufeffone\r\n\nimg\ttwo\none\n", encoding="utf-8")
    assert [r.label for r in files.labels(spark, str(tmp_path / "l.txt")).orderBy("label_idx").collect()] == ["one", "two"]
    assert files.spec("c:/x:TEXT") == ("c:/x", "text")
