"""Personal data, plain and disguised, with offsets of the source text.

Plain identifiers are matched on the text itself.  Disguised ones are matched
on a normalised text: transducers map homoglyphs to ASCII, runs of spelled
digits to digits and at/dot disguises to their signs, and carry for every
normalised character the source characters it stands for.  A match there is
mapped back and added where it rests on at least one changed character and
lies within no plain span of its kind; a plain span that it covers stays too.

Lines in which no transducer has anything to change are passed over
(`disguised`); that changes no result.  Bounds of a disguised address: a
local name of five parts, parts of 64 characters (as mail allows), a host of
eight labels, labels of 63 characters (as names allow); of a disguised IP: a
part in at most three words.  Plain identifiers have no such bounds.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from sys import maxsize

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scan

KINDS = ("email", "ip", "card", "phone")

# -- plain identifiers ------------------------------------------------------

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @, dotted domain: linear in the text, one step for each @."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time of every dotted run of digits; parts at most 255."""
    for m in _DOTTED.finditer(text):
        parts = [p.span() for p in _PART.finditer(text, *m.span())]
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            if all(len(text[a:b].lstrip("0")) <= 3 and int(text[a:b].lstrip("0") or 0) <= 255 for a, b in four):
                yield four[0][0], four[3][1]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": emails, "ip": ips, "card": cards, "phone": phones}

# -- transducers ------------------------------------------------------------

# Characters that look like ASCII ones (Greek and Cyrillic letters, signs); the
# full-width forms follow from a rule.
_LOOKS = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l", "Ѕ": "S", "І": "I", "Ј": "J",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "α": "a", "ι": "i", "ρ": "p", "υ": "u", "κ": "k",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ℓ": "l",
    "﹫": "@", "․": ".", "。": ".", "｡": ".", "﹒": ".", "·": ".", "‧": ".", "∙": ".", "•": ".",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹣": "-",
    " ": " ", " ": " ", " ": " ", " ": " ", "　": " ", "﹢": "+",
    # blanks; characters without width
    "\u00a0": " ", "\u2007": " ", "\u2009": " ", "\u202f": " ", "\u3000": " ", "\ufe62": "+",
    "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "", "\ufeff": "", "\u00ad": "",
}
_LOOKS |= {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}
# decimal digits of other scripts, ten in a row from each zero
_LOOKS |= {chr(z + d): str(d) for z in (0x660, 0x6F0, 0x966, 0x9E6, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)
           for d in range(10)}
_LONG_DASH = "–—"       # in prose also between words
_GLYPH = re.compile("[" + "".join(map(re.escape, _LOOKS)) + "]")

# Digits, plus, at and dot in words of English, German, French and Spanish.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8",
    "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}
_PLUS = r"(?:plus|más)"
_AT = r"(?:at|ät|arroba|arobase|klammeraffe)"
_DOT = r"(?:dot|punkt|punto|point)"

_WORD = "(?:" + "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True)) + ")"
_SPELLED = re.compile(rf"(?<![^\W_])(?:{_PLUS}[ ,-]{{1,3}})?{_WORD}(?:[ ,-]{{1,3}}{_WORD})+(?![^\W_])", re.I)
_SPELLED_PART = re.compile(rf"{_PLUS}|{_WORD}", re.I)
_BRACKET_AT = re.compile(rf" {{0,3}}(?:\[ {{0,3}}(?:{_AT}|@) {{0,3}}\]|\( {{0,3}}(?:{_AT}|@) {{0,3}}\)|\{{ {{0,3}}(?:{_AT}|@) {{0,3}}\}}|< {{0,3}}(?:{_AT}|@) {{0,3}}>) {{0,3}}", re.I)
_BRACKET_DOT = re.compile(rf" {{0,3}}(?:\[ {{0,3}}(?:{_DOT}|\.) {{0,3}}\]|\( {{0,3}}(?:{_DOT}|\.) {{0,3}}\)|\{{ {{0,3}}(?:{_DOT}|\.) {{0,3}}\}}|< {{0,3}}(?:{_DOT}|\.) {{0,3}}>) {{0,3}}", re.I)
_NAME = r"[A-Za-z0-9_%+-]{1,64}"
# The last labels after which one bare "at" is taken for an address.
_TOP = "(?:com|net|org|edu|gov|info|io|co|de|fr|es|eu|uk|us|biz|dev|test|example)"
# a sign in words between blanks, underscores or hyphens
_SEP_AT, _SEP_DOT = (rf"(?: {{1,3}}{w} {{1,3}}|_{w}_|-{w}-)" for w in (_AT, _DOT))
_BARE_EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-]){_NAME}(?:(?:{_SEP_DOT}|\.){_NAME}){{0,4}}?(?:{_SEP_AT}|@)"
    rf"[A-Za-z0-9-]{{1,63}}?(?:(?:{_SEP_DOT}|\.)[A-Za-z0-9-]{{1,63}}?){{0,6}}?(?:{_SEP_DOT}|\.){_TOP}"
    rf"(?![A-Za-z0-9-]|{_SEP_DOT}[A-Za-z0-9])", re.I)
# Two signs in words, or @ itself before a dot in words: any last label of letters.
_LABEL, _ANY = r"[A-Za-z0-9-]{1,63}?", r"[A-Za-z]{2,63}"
_LOCAL_WORDS = rf"(?<![A-Za-z0-9._%+-]){_NAME}(?:(?:{_SEP_DOT}|\.){_NAME}){{0,4}}?"
_LOCAL_DOTS = rf"(?<![A-Za-z0-9._%+-])(?:{_NAME}\.){{0,3}}?{_NAME}{_SEP_DOT}{_NAME}(?:(?:{_SEP_DOT}|\.){_NAME}){{0,3}}?"
_HOST_DOTS = rf"{_LABEL}(?:\.{_LABEL}){{0,6}}?{_SEP_DOT}(?:{_LABEL}(?:{_SEP_DOT}|\.)){{0,6}}?{_ANY}"
_WORD_END = rf"(?![A-Za-z0-9-]|{_SEP_DOT}[A-Za-z0-9])"
_WORD_EMAIL = re.compile(rf"{_LOCAL_WORDS}(?:{_SEP_AT}|@){_HOST_DOTS}{_WORD_END}", re.I)
_DOTTED_EMAIL = re.compile(rf"{_LOCAL_DOTS}{_SEP_AT}{_LABEL}(?:\.{_LABEL}){{0,6}}?\.{_ANY}{_WORD_END}", re.I)
# What stands between "at" and "dot" in prose ("at the dot on", "at polka dot", "at match point and").
_PROSE = re.compile(
    r" {1,3}at {1,3}(?:(?:the|an?|this|that|each|every|any|some|no|one|which|my|your|his|her|its|our|their|polka)"
    r" {1,3}dot|[a-z]+ {1,3}point) ", re.I)
_BARE_AT, _BARE_DOT = re.compile(_SEP_AT, re.I), re.compile(_SEP_DOT, re.I)
_PART_IP = rf"(?:[0-9]{{1,3}}|{_WORD}(?:[ ,-]{{1,3}}{_WORD}){{0,2}})"
_WORDY_IP = re.compile(rf"(?<![\w.]){_PART_IP}(?:(?: {{0,3}}{_DOT} {{0,3}}| {{0,3}}\. {{0,3}}){_PART_IP}){{3}}(?!\w)", re.I)
_LOOSE_DOT = re.compile(rf" {{0,3}}(?:{_DOT}|\.) {{0,3}}", re.I)
_DOUBLE = re.compile(rf"(?<![^\W_])(double|triple) {{1,3}}({_WORD})(?![^\W_])", re.I)
_ENTITY = re.compile("&(?:#64|commat|#x40);|&(?:#46|period|#x2e);", re.I)
_O_DIGITS = re.compile(r"(?<![^\W_])(?=[OoIl|]{0,30}[0-9])[0-9OoIl|]{2,40}(?![^\W_])")
_O = {"O": "0", "o": "0", "I": "1", "l": "1", "|": "1"}

# one look-alike letter as a whole part of an address in digits
_LONE_LOOK = re.compile(r"(?<=[0-9]\.)[OoIl|](?!\w)|(?<![\w.])[OoIl|](?=\.[0-9])")
# one digit word between digits
_LONE_WORD = re.compile(rf"(?<=[0-9][ -]){_WORD}(?=[ -][0-9])", re.I)
# blanks around @ or dots, before the last labels above
_SPACED_DOT = r"(?: {1,3}\. {1,3}|\.)"
_SPACED_EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-]){_NAME}(?:\.{_NAME}){{0,4}}?(?: {{1,3}}@ {{0,3}}|@ {{0,3}})"
    rf"{_LABEL}(?:{_SPACED_DOT}{_LABEL}){{0,6}}?{_SPACED_DOT}{_TOP}(?![A-Za-z0-9-])", re.I)

# What the transducers look for, for lines to be passed over quickly (`disguised`): brackets around a sign, "at" before a
# dotted name, look-alikes beside a digit or in a part of an address, loose dots between digits.
_BRACKETED = re.compile(rf"[\[({{<] *(?:{_AT}|{_DOT}|[@.]) *[\])}}>]", re.I).search
_AT_NAME = re.compile(rf"[ _-]{_AT}[ _-]{{1,3}}[A-Za-z0-9-]{{1,63}}\.[A-Za-z0-9]", re.I).search
_DIGIT = re.compile("[0-9]").search
_BESIDE_DIGIT = re.compile(r"[0-9](?:[OoIl|]|(?<=[OoIl|].))|\.[OoIl|](?!\w)|(?<=[OoIl|])\.[0-9]|[0-9] {1,3}\.|[0-9]\. ").search
_LOOSE_AT = re.compile(r" @|@ |@[A-Za-z0-9.-]* {1,3}\. ").search
_DOT_WORDS = ("dot", "punkt", "punto", "point")
_LOW = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))


def _cased(word: str) -> set[bytes]:
    """The word as case-free patterns match it, ASCII letters in lower case."""
    out = [""]
    for c in word:
        other = {c, c.upper()} if not c.isascii() else {c, "\u017f"} if c == "s" else {c}
        out = [x + y for x in out for y in other]
    return {x.encode() for x in out}


_DIGIT_BYTES = frozenset().union(*map(_cased, _DIGIT_WORDS))


class Traced:
    """A text with the source characters (``start``, ``stop``) of each of its characters."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.start = np.arange(len(text), dtype=np.int64)
        self.stop = self.start + 1
        self.changed = np.zeros(len(text), bool)

    def put(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the ranges (a, b) in ascending order; every new character stands for the whole range."""
        edits = [(a, b, new) for a, b, new in edits if self.text[a:b] != new]
        if not edits:
            return
        text, start, stop, changed, at = [], [], [], [], 0
        for a, b, new in edits:
            if not new:         # what is left around a dropped character counts as changed
                self.changed[max(0, a - 1):b + 1] = True
            text += [self.text[at:a], new]
            start += [self.start[at:a], np.full(len(new), self.start[a])]
            stop += [self.stop[at:a], np.full(len(new), self.stop[b - 1])]
            changed += [self.changed[at:a], np.ones(len(new), bool)]
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.start = np.concatenate([*start, self.start[at:]])
        self.stop = np.concatenate([*stop, self.stop[at:]])
        self.changed = np.concatenate([*changed, self.changed[at:]])

    def sub(self, pattern: re.Pattern, new: Callable[[re.Match], str]) -> None:
        self.put([(*m.span(), new(m)) for m in pattern.finditer(self.text)])


def _address(m: re.Match) -> str:
    """An address in words, its signs put in.  A bare "at" alone is no disguise of a plain word: left as it is."""
    text = m.group()
    local = _BARE_AT.split(text, maxsplit=1)[0] if "@" not in text else ""
    if local.isalpha() and not _BARE_DOT.search(text):
        return text
    return _BARE_DOT.sub(".", _BARE_AT.sub("@", text))


def _words(m: re.Match) -> str:
    """An address with two signs in words, or one beside @, its signs put in; prose is left as it is."""
    text = m.group()
    if "@" in text:
        return _BARE_DOT.sub(".", text)
    return text if _PROSE.search(text) else _BARE_DOT.sub(".", _BARE_AT.sub("@", text))


def _digits(text: str) -> str:
    return "".join(_DIGIT_WORDS.get(w.lower(), "+") for w in _SPELLED_PART.findall(text))


def _dotted(m: re.Match) -> str:
    return ".".join(p if p.isdigit() else _digits(p) for p in _LOOSE_DOT.split(m.group()))


def normalise(text: str) -> Traced:
    """The transducers in order: homoglyphs, look-alike digits, entities, spelled digits, bracketed signs, bare words."""
    t = Traced(text)
    t.sub(_GLYPH, lambda m: _LOOKS[m.group()])
    t.sub(_O_DIGITS, lambda m: "".join(_O.get(c, c) for c in m.group()))
    t.sub(_ENTITY, lambda m: "@" if m.group().lower() in ("&#64;", "&commat;", "&#x40;") else ".")
    t.sub(_LONE_LOOK, lambda m: _O[m.group()])
    t.sub(_DOUBLE, lambda m: " ".join([m[2]] * (2 if m[1].lower() == "double" else 3)))
    t.sub(_WORDY_IP, _dotted)
    t.sub(_SPELLED, lambda m: _digits(m.group()))
    t.sub(_LONE_WORD, lambda m: _digits(m.group()))
    t.sub(_BRACKET_AT, lambda m: "@")
    t.sub(_BRACKET_DOT, lambda m: ".")
    t.sub(_SPACED_EMAIL, lambda m: m.group().replace(" ", ""))
    t.sub(_BARE_EMAIL, _address)
    t.sub(_WORD_EMAIL, _words)
    t.sub(_DOTTED_EMAIL, _words)
    return t


def disguised(text: str) -> bool:
    """False only where no identifier can come of what the transducers change.

    Digit words alone must be four at least (an IP has four parts), one does
    beside a digit; any dot in words does.
    """
    if not text.isascii() and not _LOOKS.keys().isdisjoint(set(text)):
        return True
    if _BRACKETED(text) or _AT_NAME(text) or "&#" in text or "@" in text and _LOOSE_AT(text):
        return True
    low = text.casefold()
    if any(w in low for w in _DOT_WORDS) or "&commat" in low or "&period" in low:
        return True
    digit = _DIGIT(text)
    if digit and _BESIDE_DIGIT(text):
        return True
    words = sum(map(_DIGIT_BYTES.__contains__, text.encode("utf-8", "surrogatepass").translate(_LOW).split()))
    return words >= 4 or words >= 1 and digit is not None


def within(spans: list[tuple[int, int]], start: int, stop: int) -> bool:
    """Whether one of the spans (ascending, disjoint) holds the range whole."""
    i = bisect_right(spans, (start, maxsize)) - 1
    return i >= 0 and stop <= spans[i][1]


def dashed(text: str, spans: list[tuple[int, int]], start: int, stop: int) -> bool:
    """Whether the range is one plain span and words that a long dash sets off from it: no part of an address."""
    i = bisect_left(spans, (start, start))
    if i == len(spans) or spans[i][1] > stop:
        return False
    a, b = spans[i]
    return (a == start or text[a - 1] in _LONG_DASH) and (b == stop or text[b] in _LONG_DASH)


def find(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, stop, plain) by start, then kind as listed, then stop; offsets in code points."""
    text = text or ""
    plain = {k: list(FINDERS[k](text)) for k in KINDS}
    out = [(k, a, b, True) for k in KINDS for a, b in plain[k]]
    if disguised(text):
        first = 0
        for line in text.split("\n"):            # no identifier runs over a line's end
            if line and disguised(line):
                t = normalise(line)
                for k in KINDS if t.changed.any() else ():
                    for a, b in FINDERS[k](t.text):
                        if t.changed[a:b].any():
                            s, e = int(t.start[a]) + first, int(t.stop[b - 1]) + first
                            if not within(plain[k], s, e) and not (k == "email" and dashed(text, plain[k], s, e)):
                                out.append((k, s, e, False))
            first += len(line) + 1
    return sorted(out, key=lambda r: (r[1], KINDS.index(r[0]), r[2]))


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row of ``docs(doc_id, text)``; see `find`.

    ``spans``: kind, start and stop (code points, stop exclusive) and whether
    the match is plain.  Null and empty texts have none.  Repeated rows each
    get a row; other columns are not read.
    """
    def rows(it):
        for doc_id, text in it:
            yield doc_id, [{"kind": k, "start": a, "stop": b, "plain": p} for k, a, b, p in find(text)]
    return scan(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                "doc_id long, spans array<struct<kind:string,start:long,stop:long,plain:boolean>>", rows)
