"""Personal data in texts, also disguised, reported at the characters of the source.

Transducers rewrite a text step by step (look-alike letters and digits, invisible characters, spelled-out digits, at/dot
disguises) and keep for each written character the source span it came from.  Identifiers found in the rewritten text are
mapped back through these spans; those that the plain text shows already stay as they are.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import short_batches
from tidemark.llm.spans import Layer

KINDS = ("email", "ip", "card", "phone")
FOUND = "array<struct<kind:string,start:int,end:int,disguised:boolean>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Look-alike letters (Cyrillic, Greek, Armenian, Latin variants) and the ASCII letters they pass for.
LOOK_ALIKES = dict(zip(
    "аеорсухіјѕԁԛԝһӏАВЕКМНОРСТУХІЈЅԌΑΒΕΖΗΙΚΜΝΟΡΤΥΧαοινρυκτοցհոսօıɑɡⅼⅰⅴⅹⅽⅾⅿ",
    "aeopcyxijsdqwhlABEKMHOPCTYXIJSGABEZHIKMNOPTYXaoivpuktoghnuoiaglivxcdm",
    strict=True,
))
# Characters that are not seen, and forms of dot, at and hyphen.
INVISIBLE = "­​‌‍⁠﻿"
MARKS = {"․": ".", "。": ".", "｡": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", " ": " ", " ": " ", " ": " "}
# Digits by name, in English, German, French and Spanish.
DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8",
    "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
# At and dot in the same languages.
AT_WORDS = "at ät arroba arobase".split()
DOT_WORDS = "dot punkt punto point".split()
# Escaped signs, as URLs and HTML write them.
ESCAPED = {"%40": "@", "%2e": ".", "%2b": "+", "&#64;": "@", "&#x40;": "@", "&commat;": "@", "&#46;": ".", "&#x2e;": ".", "&period;": ".", "&#43;": "+", "&#x2b;": "+"}
# Ends of domain names that make a plain "name @ host.end" an address.
ENDS = "com net org edu gov mil int info biz name io co me dev app ai tv us uk de fr es it nl eu ch at be se no dk fi pl pt ru cn jp in br au ca mx".split()

_ODD = re.compile(r"[^\x00-ɏ‘-‟…]|[ ­·]")
_NAMED = "|".join(sorted(DIGITS, key=len, reverse=True))
_AT, _SPOT = "|".join(AT_WORDS), "|".join(DOT_WORDS)
_SPELLED = re.compile(rf"\b(?:(?:plus|más|mas)[\s,]+)?(?:{_NAMED})\b(?:[\s,.\-]+(?:(?:{_NAMED})\b|(?:{_SPOT})\b|[0-9]+\b))*", re.I)
_SPELLED_PART = re.compile(rf"\b(?:plus|más|mas)\b|\b(?:{_NAMED})\b|\b(?:{_SPOT})\b|[0-9]+|[\s,.\-]+", re.I)
_A_NAME = re.compile(rf"\b(?:{_NAMED})\b", re.I).search
_ESCAPED = re.compile("|".join(map(re.escape, ESCAPED)), re.I)
_BRACKETED = re.compile(rf"(?<!\s)\s*+[\[({{<]\s*({_AT}|{_SPOT}|@|\.)\s*[\])}}>]\s*", re.I)


def _name_at_host(at: str, dot: str) -> re.Pattern:
    return re.compile(
        rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]++(?:(?:\.|\s+(?:{dot})\s+)[A-Za-z0-9_%+-]+)*+(?P<at>\s+(?:{at})\s+|\s*@\s*)"
        rf"[A-Za-z0-9-]++(?P<labels>(?:(?:\.|\s+(?:{dot})\s+)[A-Za-z0-9-]+)++)",
        re.I,
    )


#: "look at this point" is English prose, so "point" is a dot beside the at of other languages only.
_NAME_AT_HOST = (_name_at_host(_AT, "dot|punkt|punto"), _name_at_host("ät|arroba|arobase", _SPOT))
_LABEL = re.compile(rf"(?P<between>\.|\s+(?:{_SPOT})\s+)(?P<label>[A-Za-z0-9-]+)", re.I)
_TOUCHED_BEFORE = re.compile(r"[0-9+][\s,.()\-]*\Z", re.A)
_TOUCHED_AFTER = re.compile(r"[\s,.()\-]*[0-9]", re.A)
_DOT = re.compile(rf"(?<!\s)\s++(?:{_SPOT})\s+", re.I)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part cannot hold an @, so a match runs from the start of the characters before an @, as far as the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: list[str]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> list[str]:
    return [c for c in text if "0" <= c <= "9"]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind; failing ones are dropped, not retried."""
    found = [("email", s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 12 <= len(d := _digits(m.group())) <= 19 and _luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


def _ascii_of(c: str) -> str:
    """The ASCII character that ``c`` passes for, "" for one that is not seen, otherwise ``c``."""
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if c in MARKS:
        return MARKS[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", c)  # full-width, mathematical and circled forms
    return plain if len(plain) == 1 and plain < "\x80" else c


def _look_alikes(layer: Layer) -> Layer:
    edits = [(m.start(), m.end(), new) for m in _ODD.finditer(layer.text) if (new := _ascii_of(m.group())) != m.group()]
    return layer.rewritten(edits) if edits else layer


def _few_are_digits(text: str, m: re.Match, names: int, found: list[tuple[str, int, int]]) -> bool:
    """Whether a run of less than four names may stand for digits: it touches written ones or a plus sign.

    One name beside an identifier that is whole without it is prose.
    """
    before = _TOUCHED_BEFORE.search(text, max(0, m.start() - 8), m.start())
    after = _TOUCHED_AFTER.match(text, m.end())
    if not (before or after or any("0" <= c <= "9" for c in m.group())):
        return False
    start, end = before.start() if before else m.start(), after.end() if after else m.end()
    return names > 1 or not any(s <= end and e > start for _, s, e in found)


def _spelled_digits(layer: Layer, few: bool) -> Layer:
    edits, found = [], None
    for m in _SPELLED.finditer(layer.text):
        parts = list(_SPELLED_PART.finditer(layer.text, m.start(), m.end()))
        names = sum(p.group().lower() in DIGITS for p in parts)
        if names < 4:
            if not few:
                continue
            found = base_spans(layer.text) if found is None else found
            if not _few_are_digits(layer.text, m, names, found):
                continue
        for p in parts:
            word = p.group().lower()
            if word in DIGITS:
                edits.append((p.start(), p.end(), DIGITS[word]))
            elif word in DOT_WORDS:
                edits.append((p.start(), p.end(), "."))
            elif word in ("plus", "más", "mas"):
                edits.append((p.start(), p.end(), "+"))
            elif not word.isdigit():
                edits.append((p.start(), p.end(), "." if "." in word else ""))
    return layer.rewritten(edits) if edits else layer


def _at_dot(layer: Layer) -> Layer:
    edits = [(m.start(), m.end(), "@" if m[1] == "@" or m[1].lower() in AT_WORDS else ".") for m in _BRACKETED.finditer(layer.text)]
    if edits:
        layer = layer.rewritten(edits)
    for pattern in _NAME_AT_HOST:
        layer = _spaced_at_dot(layer, pattern)
    return layer


def _spaced_at_dot(layer: Layer, pattern: re.Pattern) -> Layer:
    edits = []
    for m in pattern.finditer(layer.text):
        end = _end_of_host(layer.text, m)
        if end is None:
            continue
        dots = [(d.start(), d.end(), ".") for d in _DOT.finditer(layer.text, m.start(), end)]
        if dots or m["at"] != "@":
            if m["at"].strip() != "@" and not dots and _is_word(layer.text[m.start():m.start("at")]):
                continue  # "word at host.com" is prose
            edits += sorted([*dots, (m.start("at"), m.end("at"), "@")])
    return layer.rewritten(edits) if edits else layer


def _is_word(name: str) -> bool:
    """Whether a local part is a plain word or number, also one with hyphens."""
    return name.replace("-", "").isalpha() or name.isdigit()


def _end_of_host(text: str, m: re.Match) -> int | None:
    """Where the host ends: at the last label that can end one.

    After a spelled dot, or if the local part is no plain word, that is any of two letters or more; otherwise one of ``ENDS``.
    """
    word = _is_word(text[m.start():m.start("at")])
    for label in reversed(list(_LABEL.finditer(text, m.start("labels"), m.end("labels")))):
        end = label["label"].lower()
        if len(end) > 1 and end.isalpha() and (end in ENDS or label["between"] != "." or not word):
            return label.end()
    return None


_SIGNS = re.compile(rf"[\[({{<]\s*(?:{_AT}|{_SPOT}|@|\.)\s*[\])}}>]", re.I)
_AT_HOST = re.compile(rf"\s(?:{_AT})\s+[a-z0-9-]++\s*+(?:\.|(?:{_SPOT})\s)\s*[a-z]")


def normalised(text: str, few: bool = True) -> Layer:
    """``text`` after all transducers; ``few`` says whether less than four spelled digits beside others are rewritten too."""
    layer = Layer.source(text)
    if not text.isascii():
        layer = _look_alikes(layer)
    if ("%" in layer.text or "&" in layer.text) and (edits := [(m.start(), m.end(), ESCAPED[m.group().lower()]) for m in _ESCAPED.finditer(layer.text)]):
        layer = layer.rewritten(edits)
    if _A_NAME(layer.text):
        layer = _spelled_digits(layer, few)
    low = layer.text.lower()
    if "@" in low or _AT_HOST.search(low) or _SIGNS.search(low):
        layer = _at_dot(layer)
    return layer


def all_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, disguised): the base spans, then what only the rewritten text shows."""
    found = [(*s, False) for s in base_spans(text)]
    layer = normalised(text)
    if layer.text == text:
        layers = []
    else:  # what is found without the short runs stays, whatever these change
        plain = normalised(text, few=False)
        layers = [layer] if plain.text == layer.text else [plain, layer]
    known = {f[:3] for f in found}
    for layer in layers:
        for kind, s, e in base_spans(layer.text):
            span = (kind, *layer.span(s, e))
            if span not in known:
                known.add(span)
                found.append((*span, True))
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda x: (x[1], rank[x[0]], x[2], x[3]))


def _found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([[dict(zip(("kind", "start", "end", "disguised"), s)) for s in all_spans(t or "")] for t in texts], dtype=object)


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, found) for every row of ``df``: ``found`` lists kind, start, end (code points, end exclusive) and disguised.

    A null or empty text has an empty list.  Equal rows stay, each with its own result; a null id stays null; an empty
    table gives no rows; other columns are not read, whatever their names.  Texts are scanned whole, one by one.
    """
    short_batches(df.sparkSession)
    return df.select(F.col(id_col), F.pandas_udf(_found, FOUND)(F.col(text_col)).alias("found"))
