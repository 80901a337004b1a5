"""Classes of characters as regular-expression ranges, made from Python's Unicode tables on the driver: those of the JVM and of RE2 are older."""

from __future__ import annotations

import functools
import sys
import unicodedata

#: Fixed: Arabic letters that don't join to the next one.
NON_JOINING = ["0621-0625", "0627", "0629", "062F-0632", "0648", "0649", "0671-0673", "0675", "0688-069A", "06C0", "06C4-06CB", "06D5"]
#: Fixed: marks that strip_marks drops.
MARKS = ["064B-065F", "0670", "06D6-06ED"]
#: Fixed: blocks of the Arabic script.
ARABIC = ["0600-06FF", "0750-077F", "08A0-08FF", "FB50-FDFF", "FE70-FEFF"]
#: Fixed: white space as Python's strip and split know it.
SPACE = ["0009-000D", "001C-0020", "0085", "00A0", "1680", "2000-200A", "2028-2029", "202F", "205F", "3000"]
#: Fixed: letters that count as Latin.
LATIN = "A-Za-zÇĞİÖŞÜçğıöşü"
TATWEEL, ZWNJ = "ـ", "‌"


def spans(points: list[int]) -> list[str]:
    out: list[list[int]] = []
    for p in points:
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return [f"{a:04X}" if a == b else f"{a:04X}-{b:04X}" for a, b in out]


def members(ranges: list[str]) -> list[int]:
    out = []
    for r in ranges:
        a, _, b = r.partition("-")
        out += range(int(a, 16), int(b or a, 16) + 1)
    return out


@functools.cache
def class_ranges(kind: str) -> tuple[str, ...]:
    category = unicodedata.category
    every = range(sys.maxunicode + 1)
    if kind == "M":
        found = [p for p in every if category(chr(p))[0] == "M"]
    elif kind == "Cf":
        found = [p for p in every if category(chr(p)) == "Cf" and p != 0x200C]
    elif kind == "AL":
        found = [p for p in range(0x600, 0xFF00) if unicodedata.name(chr(p), "").startswith("ARABIC LETTER ") and category(chr(p))[0] != "M"]
    elif kind == "JOIN":
        found = sorted(set(members(list(class_ranges("AL")))) - set(members(NON_JOINING)))
    else:
        found = [p for p in every if chr(p).isdigit()]
    return tuple(spans(found))


def ranges(kind: str | list[str]) -> str:
    """The inside of a character class, for Java and RE2 alike; kind: M, Cf (without ZWNJ), AL, JOIN, digit, or ranges of hexadecimal points."""
    return "".join("-".join(f"\\x{{{x}}}" for x in r.split("-")) for r in (class_ranges(kind) if isinstance(kind, str) else kind))


def letters(kind: str | list[str]) -> str:
    """The characters of a class one after the other, as translate and btrim take them."""
    return "".join(map(chr, members(list(class_ranges(kind)) if isinstance(kind, str) else kind)))
