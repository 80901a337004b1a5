"""Text functions from Column to Column; all stay in the JVM but the decoding of HTML entities and what looks at classes of many ranges."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType

from .unicode import ARABIC, LATIN, MARKS, SPACE, TATWEEL, ZWNJ, letters, ranges

Hook = Callable[[Column], Column]
PROFILES = ("none", "conservative_sorani")
MODES = ("any", "arabic_no_latin", "arabic_no_latin_digit", "arabic_letters_marks_space")
#: Fixed: language tags whose texts skip the outer normaliser.
SKIPPED_LANGUAGES = ("en", "eng", "english", "ar", "ara", "arabic", "fa", "fas", "per", "persian", "farsi", "tr", "tur", "turkish", "ku", "kur", "kmr", "kurmanji", "ckb", "srd", "ku-ar", "ku-latn")
#: Fixed patterns of markup: ends of HTML blocks, tags; templates, links, emphasis of wikitext.
BLOCK_END, TAG = r"(?i)</(p|div|br|li|h[1-6]|article|section|blockquote)>", r"<[^>]+>"
TEMPLATE, LINK, EMPHASIS = r"\{\{[^{}]*\}\}", r"\[\[(?:[^|\]]*\|)?([^\]]+)\]\]", r"'{2,}"
#: Fixed: where a text is cut into paragraphs.
PARAGRAPH = r"[\n\x{61F}?!\x{61B};\x{3002}]+"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(letters(SPACE)))


def _class(kind: str) -> str:
    """Python looks a character up in a table, where Java tries each range of a class in turn."""
    return f"[{''.join(re.escape(x) for x in letters(kind))}]"


@functools.cache
def _context() -> tuple[re.Pattern, re.Pattern, frozenset, frozenset, frozenset]:
    run = f"[{re.escape(TATWEEL)}{_class('M')[1:]}*+"
    return re.compile(TATWEEL + run), re.compile(f"ي(?={run}{_class('AL')})"), *(frozenset(letters(k)) for k in ("M", "AL", "JOIN"))


def _each(change: Callable[[str], str], sign: str, texts: pa.Array) -> pa.Array:
    """Changes the texts, or those in arrays, that hold this sign; bytes that are no UTF-8 stay as they are."""
    if pa.types.is_list(texts.type):
        texts = texts.take(pa.array(range(len(texts)))) if texts.offset else texts
        return pa.ListArray.from_arrays(texts.offsets, _each(change, sign, texts.values), mask=texts.is_null() if texts.null_count else None)
    held = sign.encode()
    out = [change(x.decode("utf-8", "surrogateescape")).encode("utf-8", "surrogateescape") if x is not None and held in x else x for x in texts.cast(pa.binary()).to_pylist()]
    return pa.array(out, pa.binary()).view(pa.string())


def _tatweel(text: str) -> str:
    runs, _, marks, letter, joins = _context()

    def by(m: re.Match) -> str:
        found, end = m.group(), m.end()
        if end < len(text) and text[end] in letter:
            return found.replace(TATWEEL, "")
        at = m.start() - 1
        while at >= 0 and text[at] in marks:
            at -= 1
        return found if at >= 0 and text[at] in joins else found.replace(TATWEEL, "-")

    return runs.sub(by, text)


def _yeh(text: str) -> str:
    return _context()[1].sub("ی", text)


def _contextual(change: Callable[[str], str], sign: str, many: bool) -> Callable[[Column], Column]:
    kind = ArrayType(StringType()) if many else StringType()

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        return _each(change, sign, texts)

    return lambda c: run(c.cast("array<binary>" if many else "binary"))


def tatweel(c: Column, many: bool = False) -> Column:
    """A tatweel before an Arabic letter goes (marks and tatweels between them don't count); else it stays after a letter that joins forward and becomes a dash after anything else. many: of an array of texts."""
    return _contextual(_tatweel, TATWEEL, many)(c)


def yeh_nonfinal(c: Column, many: bool = False) -> Column:
    return _contextual(_yeh, "ي", many)(c)


def strip_marks(c: Column) -> Column:
    return F.translate(c, letters(MARKS), "")


def drop_zwnj(c: Column) -> Column:
    return F.replace(c, F.lit(ZWNJ), F.lit(""))


def blanks(c: Column) -> Column:
    """One blank for runs of blanks and tabs, at most one empty line, nothing at the ends."""
    c = F.regexp_replace(c, r"[ \t\r\f\x0B]+", " ")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def normalize_label(c: Column, profile: str = "conservative_sorani", marks: bool = False, yeh: bool = False, zwnj: bool = False, outer: Hook | None = None, transliterate: Hook | None = None, many: bool = False) -> Column:
    """The label normaliser. What looks at neighbours comes first, since it looks at those of the original text. Hooks are functions of a column: a transliteration is applied first, an outer normaliser next. many: of an array of texts."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; known: {', '.join(PROFILES)}")
    sorani = profile == "conservative_sorani"

    def hooked(c: Column) -> Column:
        for hook in (transliterate, outer):
            c = hook(c) if hook else c
        return c

    def rest(c: Column) -> Column:
        if marks:
            c = strip_marks(c)
        c = F.translate(c, letters("Cf"), "")
        if sorani:
            c = F.translate(c, "كى", "کی")
        if zwnj:
            c = drop_zwnj(c)
        return blanks(c)

    each = (lambda f, c: F.transform(c, lambda x: f(x))) if many else (lambda f, c: f(c))
    c = each(hooked, c) if transliterate or outer else c
    if sorani:  # by Python, which can't be called from within a lambda function
        c = tatweel(c, many)
    if yeh:
        c = yeh_nonfinal(c, many)
    return each(rest, c)


@F.pandas_udf(StringType())
def _unescape(texts):
    import html

    return texts.map(html.unescape, na_action="ignore")


def clean_html(c: Column, **options) -> Column:
    """Entities are decoded before tags go, so an escaped tag goes too; ends of blocks become new lines, other tags blanks."""
    c = F.when(c.contains("&"), _unescape(c)).otherwise(c)
    return normalize_label(F.regexp_replace(F.regexp_replace(c, BLOCK_END, "\n"), TAG, " "), **options)


def clean_wikitext(c: Column, parser: Hook | None = None, **options) -> Column:
    """Innermost templates go once, links keep their label, tags become blanks, quotes of emphasis go; or a parser does all of it."""
    for pattern, by in ((TEMPLATE, " "), (LINK, "$1"), (TAG, " "), (EMPHASIS, "")) if parser is None else ():
        c = F.regexp_replace(c, pattern, by)
    return normalize_label(parser(c) if parser else c, **options)


def block_key(c: Column) -> Column:
    """White space joined and case folded, for comparison only: lower case of upper case is full folding but for two letters, and its final sigma. What stands between the two keeps the optimiser from dropping the first."""
    c = F.upper(F.translate(F.array_join(words(c), " "), "\u0131", "\ufdd0"))
    return F.translate(F.lower(F.replace(c, F.lit("\u1e9e"), F.lit("SS"))), "\u03c2", "\u03c3")


def join_unique_blocks(blocks: Column, **options) -> Column:
    """The blocks of an array, each normalised, without empty ones and those that repeat an earlier one but for case and white space, joined by empty lines."""
    clean = normalize_label(F.transform(blocks, lambda b: F.coalesce(b, F.lit(""))), many=True, **options)
    keyed = F.filter(F.transform(clean, lambda b: F.struct(block_key(b).alias("k"), b.alias("b"))), lambda x: x["k"] != "")
    start = F.struct(F.array().cast("array<string>").alias("k"), F.array().cast("array<string>").alias("b"))
    kept = F.aggregate(keyed, start, lambda a, x: F.when(F.array_contains(a["k"], x["k"]), a).otherwise(F.struct(F.array_append(a["k"], x["k"]).alias("k"), F.array_append(a["b"], x["b"]).alias("b"))))
    return F.array_join(kept["b"], "\n\n")


def has_arabic(c: Column) -> Column:
    return c.rlike(f"[{ranges(ARABIC)}]")


def passes_script(c: Column, mode: str = "any") -> Column:
    if mode not in MODES:
        raise ValueError(f"unknown script filter {mode!r}; known: {', '.join(MODES)}")
    if mode == "any":
        return F.lit(True)

    held = f"[{ranges(ARABIC)}]"
    other = {"arabic_no_latin": f"[{LATIN}]", "arabic_no_latin_digit": f"[{LATIN}{ranges('digit')}]", "arabic_letters_marks_space": f"[^{ranges(ARABIC)}{ranges(SPACE)}]"}[mode]

    @F.arrow_udf(BooleanType())
    def run(texts: pa.Array) -> pa.Array:
        return pc.and_not(pc.match_substring_regex(texts, held), pc.match_substring_regex(texts, other))

    return run(c)


def uses_outer_normaliser(language: Column) -> Column:
    tag = F.lower(F.trim(language))
    return F.coalesce((tag == "") | ~tag.isin(*SKIPPED_LANGUAGES), F.lit(True))


#: Fixed: characters that a document has to have at least, by its source.
LEAST = {"wikipedia": 100, "wikitext": 51, "text": 51, "jsonl": 51}


def long_enough(c: Column, kind: str) -> Column:
    return F.length(c) >= LEAST[kind]


def words(c: Column) -> Column:
    """Split at white space. Its other characters become blanks first: a regular expression tries each range of a class on each character."""
    space = letters(SPACE)
    return F.filter(F.split(F.translate(c, space, " " * len(space)), " +"), lambda w: w != "")


def doc_key(c: Column) -> Column:
    return F.sha1(strip(c))
