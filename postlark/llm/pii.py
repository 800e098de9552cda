"""Personal data in texts, plain or disguised, with its place in the source.

Emails, network addresses, payment card numbers and phone numbers are found by patterns: leftmost
matches that do not overlap, and those that fail their test (parts up to 255, a check digit, a number
of digits) are dropped. These are the base spans.

Disguised ones are found behind transducers. Each rewrites a text and keeps, for every stretch of its
output, the stretch of its input, so that a span of the last output maps back to the source through
all of them:

1. characters: letters of other scripts that look like ASCII ones, wide and styled forms, digits of
   any script, other hyphens and spaces; characters without width are deleted;
2. spelled numbers: runs of number words and numerals, with "plus", "dot" and "double", become
   numerals. Spelled digits lose what is between them; numerals keep a space;
3. addresses: "at" and "dot" in brackets, as character references or as words between the parts of
   an address become ``@`` and ``.``. As plain words they need a whole address around them: two parts
   joined by a disguised dot, or a name that is no ordinary word before a plain domain.

The same patterns run on what the transducers return. A span that they add is not within a base span
of its kind; base spans stay as they are.

Patterns are searched in time linear in the text, however long its runs are. Texts are taken whole. Arrow
first marks, for all texts of a batch at once, which searches cannot find anything in which text; its
patterns let pass whatever the searches may find.

Edge cases: a null or empty text has no spans, an empty string of them, and the hash of that string.
Equal rows have equal spans. A null id is passed on, other columns are ignored, an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Collection, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")

Span = tuple[int, int]
Spans = dict[str, list[Span]]

# The characters of an address before the @, and the patterns of the base spans. They
# find what the plain patterns find; possessive ones keep no way back through a long run.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_GROUPED = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CARD_DIGITS = range(13, 20)
_PHONE_DIGITS = range(9, 16)


def _emails(text: str) -> list[Span]:
    """A name starts at the first of its characters before an @ that a domain follows."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        name = text[low:at]
        size = len(name) - len(name.rstrip(_LOCAL))
        domain = size and _DOMAIN.match(text, at + 1)
        low = at + 1
        if domain:
            out.append((at - size, domain.end()))
            low = domain.end()
        at = text.find("@", low)
    return out


def _addresses(text: str) -> list[Span]:
    """Each four parts of numbers joined by dots."""
    out = []
    for found in _DOTTED.finditer(text):
        parts = found.group().split(".")
        start = found.start()
        for i in range(0, len(parts) - 3, 4):
            own = parts[i : i + 4]
            end = start + sum(map(len, own)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in own):
                out.append((start, end))
            start = end + 1
    return out


def passes_luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _cards(text: str) -> list[Span]:
    out = []
    for found in _GROUPED.finditer(text):
        if found.end() - found.start() >= _CARD_DIGITS.start:
            digits = found.group().replace(" ", "").replace("-", "")
            if len(digits) in _CARD_DIGITS and passes_luhn(digits):
                out.append(found.span())
    return out


def _phones(text: str) -> list[Span]:
    out = []
    for found in _PHONE.finditer(text):
        own = found.group()
        if len(own) - sum(map(own.count, "+ ().-")) in _PHONE_DIGITS:
            out.append(found.span())
    return out


_SEARCHES = {"email": _emails, "ip": _addresses, "card": _cards, "phone": _phones}


def plain_spans(text: str, kinds: Collection[str] = KINDS) -> Spans:
    """Spans of each kind, as code points; none of kinds that are not asked for."""
    return {kind: _SEARCHES[kind](text) if kind in kinds else [] for kind in KINDS}


class Rewritten:
    """A text rewritten in places, and the way back from it."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        """``edits`` are (start, end, new text) in order, without overlaps."""
        parts: list[str] = []
        # Starts of stretches in the new text, with the stretch of the source, and whether the
        # stretch is a copy.
        self.starts: list[int] = []
        self.stretches: list[tuple[int, int, bool]] = []
        size = at = 0

        def put(part: str, start: int, end: int, same: bool) -> None:
            nonlocal size
            if part:
                self.starts.append(size)
                self.stretches.append((start, end, same))
                parts.append(part)
                size += len(part)

        for start, end, new in edits:
            put(source[at:start], at, start, True)
            put(new, start, end, False)
            at = end
        put(source[at:], at, len(source), True)
        self.text = "".join(parts)

    def _stretch(self, place: int) -> tuple[int, int]:
        """The source of one character."""
        i = bisect_right(self.starts, place) - 1
        start, end, same = self.stretches[i]
        if same:
            own = start + place - self.starts[i]
            return own, own + 1
        return start, end

    def back(self, span: Span) -> Span:
        """The place in the source that a span comes from."""
        return self._stretch(span[0])[0], self._stretch(span[1] - 1)[1]


# Letters of other scripts by the ASCII letters they look like.
LOOKALIKES = {
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ",
    "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ΥҮ",
    "Z": "Ζ", "a": "аα", "b": "Ь", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һ",
    "i": "іι", "j": "ј", "l": "ӏ", "o": "оο", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "υ",
    "v": "ѵν", "w": "ԝ", "x": "х", "y": "уү",
    ".": "․。｡", "-": "‐‑‒–—―−﹣", " ": "         "
    "     　",
    "": "­​‌‍⁠﻿",
}


@cache
def _characters() -> tuple[dict[str, str], re.Pattern]:
    """Every character to rewrite, with what it becomes, and a pattern of all."""
    known = {c: new for new, old in LOOKALIKES.items() for c in old}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        digit = unicodedata.decimal(char, None)
        if digit is not None:
            known.setdefault(char, str(digit))
        elif unicodedata.decomposition(char).startswith(("<wide>", "<font>", "<small>")):
            plain = unicodedata.normalize("NFKC", char)
            if len(plain) == 1 and plain.isascii():
                known.setdefault(char, plain)
    return known, re.compile(f"[{''.join(map(re.escape, known))}]")


def plain_characters(text: str) -> Rewritten | None:
    """The first transducer; None where it has nothing to do."""
    if text.isascii():
        return None
    known, pattern = _characters()
    edits = [(m.start(), m.end(), known[m.group()]) for m in pattern.finditer(text)]
    return Rewritten(text, edits) if edits else None


# Number words of four languages, and words for a dot, a plus and a repetition.
DIGIT_WORDS = {
    "0": "zero oh zéro null cero", "1": "one un une eins uno", "2": "two deux zwei zwo dos",
    "3": "three trois drei tres", "4": "four quatre vier cuatro", "5": "five cinq fünf cinco",
    "6": "six sechs seis", "7": "seven sept sieben siete", "8": "eight huit acht ocho",
    "9": "nine neuf neun nueve",
}
DOT_WORDS = "dot point punkt punto"
PLUS_WORDS = "plus más"
REPEATS = {"double": 2, "triple": 3}

_DIGIT_OF = {word: digit for digit, words in DIGIT_WORDS.items() for word in words.split()}
_WORD = "|".join([*_DIGIT_OF, *DOT_WORDS.split(), *PLUS_WORDS.split(), *REPEATS])
_DOT = "|".join(DOT_WORDS.split())
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_BRACKETED_DOT = rf"{_OPEN} ?(?:{_DOT}|\.) ?{_CLOSE}"
_TOKEN = rf"(?:{_BRACKETED_DOT}|(?:{_WORD})(?!\w)|[0-9]++|[+.()])"
# At least three tokens with at most two blanks, commas or hyphens between them. A run starts at a
# number word, a numeral, a plus or a bracket that is not within a word.
_RUN = re.compile(rf"(?<!\w){_TOKEN}(?:[ ,\-]{{0,2}}+(?:(?<![^\W\d])){_TOKEN}){{2,}}+", re.IGNORECASE)
_PART = re.compile(
    rf"(?P<dot>[ ,]{{0,2}}(?:{_BRACKETED_DOT}|(?<!\w)(?:{_DOT})(?!\w))[ ,]{{0,2}})"
    rf"|(?P<plus>(?<!\w)(?:{'|'.join(PLUS_WORDS.split())})(?!\w)[ ,]{{0,2}})"
    rf"|(?P<words>(?<!\w)(?:(?:{'|'.join(REPEATS)}) )?(?:{'|'.join(_DIGIT_OF)})(?!\w))"
    rf"|(?P<comma>,[ ]?)",
    re.IGNORECASE,
)
# A run is looked at only if a word or a bracketed dot is near a numeral or another word.
_SPELLED = re.compile(rf"(?<!\w)(?:{_WORD})(?!\w)|{_BRACKETED_DOT}", re.IGNORECASE)


def spelled_numbers(run: str) -> Rewritten:
    """The second transducer, on a run of number words and numerals."""
    edits: list[tuple[int, int, str]] = []
    last = -1
    for found in _PART.finditer(run):
        start, end = found.span()
        if found["dot"]:
            new = "."
        elif found["plus"]:
            new = "+"
        elif found["comma"]:
            new = " "
        else:
            *repeat, word = found.group().lower().split()
            new = _DIGIT_OF[word] * (REPEATS[repeat[0]] if repeat else 1)
            # Nothing stays between two spelled digits.
            if last >= 0 and not run[last:start].strip(" ,-"):
                while edits and edits[-1][0] >= last:
                    edits.pop()
                start = last
            last = end
        edits.append((start, end, new))
    return Rewritten(run, edits)


def _number_spans(text: str) -> Iterator[tuple[str, Span]]:
    for run in _RUN.finditer(text):
        own = run.group()
        if not _SPELLED.search(own):
            continue
        rewritten = spelled_numbers(own)
        found = plain_spans(rewritten.text)
        for kind in ("ip", "card", "phone"):
            for span in found[kind]:
                start, end = rewritten.back(span)
                yield kind, (run.start() + start, run.start() + end)


# What an @ may be written as. The word needs more around it than the rest.
_AT = re.compile(
    r"@|&#64;|&#x40;|&commat;|%40|(?<![A-Za-z0-9])(?:at|arroba)(?![A-Za-z0-9])", re.IGNORECASE
)
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_PLAIN_DOT = re.compile(r"\.(?=[A-Za-z0-9-])")
_MARKED_DOT = re.compile(
    rf"[ \t]{{0,3}}+(?:{_BRACKETED_DOT}|&#46;|&period;)[ \t]{{0,3}}+", re.IGNORECASE
)
_BLANK_DOT = re.compile(
    rf"[ \t]{{1,3}}+(?:{_DOT}|\.)[ \t]{{1,3}}+|_(?:{_DOT})_", re.IGNORECASE
)
# A disguised dot at the end of what comes before a name.
_DOT_BEFORE = re.compile(
    rf"(?:[ \t]{{0,3}}(?:{_BRACKETED_DOT}|&#46;|&period;)[ \t]{{0,3}}|[ \t_]{{1,3}}(?:{_DOT})[ \t_]{{1,3}})$",
    re.IGNORECASE,
)
_TOP = re.compile(r"[A-Za-z]{2,}$")
_BLANK = " \t"


def _around(text: str, start: int, end: int) -> tuple[int, int, str]:
    """A written @ with its brackets and blanks, and how sure it is one."""
    a, b = start, end
    while a and start - a < 2 and text[a - 1] in _BLANK:
        a -= 1
    while b < len(text) and b - end < 2 and text[b] in _BLANK:
        b += 1
    word = text[start:end].lower() in ("at", "arroba")
    if a and b < len(text) and text[a - 1] in "[({<" and text[b] in "])}>":
        a, b, sure = a - 1, b + 1, "bracketed"
    elif text[start:end] != "@" and not word:
        return start, end, "bracketed"
    elif word and a and text[a - 1] == "_" and text[b : b + 1] == "_":
        return a - 1, b + 1, "word"
    elif word:
        return (a, b, "word") if a < start and b > end else (start, end, "")
    else:
        return a, b, "spaced" if a < start or b > end else "plain"
    while a and start - a < 5 and text[a - 1] in _BLANK:
        a -= 1
    while b < len(text) and b - end < 5 and text[b] in _BLANK:
        b += 1
    return a, b, sure


def _domain(text: str, at: int) -> tuple[int, list[tuple[int, int]], bool]:
    """End of a domain, its disguised dots, and whether the first dot is one. Ends at ``at`` if none."""
    label = _LABEL.match(text, at)
    dots: list[tuple[int, int]] = []
    n = 0
    first = False
    end = label.end() if label else at
    while label:
        end = label.end()
        plain = _PLAIN_DOT.match(text, end)
        disguised = None if plain else _MARKED_DOT.match(text, end)
        # After a plain first dot, a blank ends the domain.
        if not plain and not disguised and (first or not n):
            disguised = _BLANK_DOT.match(text, end)
        dot = plain or disguised
        label = dot and _LABEL.match(text, dot.end())
        if label:
            if disguised:
                dots.append(disguised.span())
                first = first or n == 0
            n += 1
    return (end, dots, first) if n else (at, [], False)


def _name(text: str, low: int, at: int) -> tuple[int, list[tuple[int, int]]]:
    """Start of a name that ends at ``at``, and its disguised dots in order."""
    dots: list[tuple[int, int]] = []
    while True:
        part = text[low:at]
        own = at - (len(part) - len(part.rstrip(_LOCAL)))
        if own == at:
            return (dots[0][1], dots[1:]) if dots else (at, [])
        # A dot word takes nine characters at most, with blanks and brackets below twenty.
        before = text[max(low, own - 20) : own]
        dot = _DOT_BEFORE.search(before)
        if not dot:
            return own, dots
        at = own - len(before) + dot.start()
        dots.insert(0, (at, own))


def _address_edits(text: str) -> Iterator[list[tuple[int, int, str]]]:
    """The third transducer: what to rewrite for each disguised address."""
    low = 0
    for found in _AT.finditer(text):
        if found.start() < low:
            continue
        start, end, sure = _around(text, *found.span())
        if not sure:
            continue
        stop, dots, disguised = _domain(text, end)
        if stop == end:
            continue
        begin, name_dots = _name(text, low, start)
        name = text[begin:start]
        top = _TOP.search(text[end:stop])
        if begin == start or not top:
            continue
        if sure == "plain" and not (disguised or name_dots):
            continue
        if sure == "word" and not disguised and not (name_dots or _telling(name)):
            continue
        low = stop
        yield [
            *[(a, b, ".") for a, b in name_dots],
            (start, end, "@"),
            *[(a, b, ".") for a, b in dots],
            (begin, stop, ""),
        ]


def _telling(name: str) -> bool:
    """Whether a name is no ordinary word: letters joined with digits or marks."""
    inner = any(c in "0123456789._%+-" for c in name)
    return inner and name[0].isalnum() and name[-1].isalnum() and any(c.isalpha() for c in name)


def _email_spans(text: str) -> Iterator[tuple[str, Span]]:
    for *edits, (begin, stop, _) in _address_edits(text):
        own = text[begin:stop]
        rewritten = Rewritten(own, [(a - begin, b - begin, new) for a, b, new in edits])
        for span in _emails(rewritten.text):
            start, end = rewritten.back(span)
            yield "email", (begin + start, begin + end)


def _whole_word(text: str, span: Span) -> bool:
    """Whether no letter or digit adjoins the span."""
    start, end = span
    return not (
        (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    )


def added_spans(text: str, base: Spans, searches: Collection[str] | None = None) -> Spans:
    """Spans that only the transducers show.

    ``searches`` are those of ``SEARCHES`` that may find something in the text as it is; a text
    whose characters are rewritten is searched for everything.
    """
    known = SEARCHES if searches is None else searches
    first = plain_characters(text) if "characters" in known else None
    plain = first.text if first else text
    found = []
    if first or "numbers" in known:
        found += _number_spans(plain)
    if first or "addresses" in known:
        found += _email_spans(plain)
    if first:
        found += [
            (kind, span)
            for kind, spans in plain_spans(plain).items()
            for span in spans
            if _whole_word(plain, span)
        ]
    out: Spans = {kind: [] for kind in KINDS}
    for kind, span in sorted(found, key=lambda x: (x[1][0], -x[1][1])):
        start, end = first.back(span) if first else span
        own = out[kind]
        within = any(a <= start and end <= b for a, b in base[kind])
        if not within and (not own or own[-1][1] <= start):
            own.append((start, end))
    return out


# Patterns for Arrow, without look-around: each finds something wherever its search does.
_ANY_TOKEN = rf"(?:{_BRACKETED_DOT}|{_WORD}|[0-9]+|[+.()])"
_ANY_WORD = rf"(?:{_BRACKETED_DOT}|(?:^|[^A-Za-z])(?:{_WORD}))"
_BETWEEN = r"[ ,\-]{0,2}"
_ANY_DOT = (
    rf"(?:[ \t]{{0,3}}(?:{_BRACKETED_DOT}|&#46;|&period;)[ \t]{{0,3}}"
    rf"|[ \t_]{{1,3}}(?:{_DOT}|\.)[ \t_]{{1,3}}|\.)"
)


def _ranges(characters: Collection[str]) -> str:
    """A character class of Arrow's patterns."""
    codes = sorted(map(ord, characters))
    starts = [c for i, c in enumerate(codes) if not i or codes[i - 1] != c - 1]
    ends = [c for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    pairs = zip(starts, ends, strict=True)
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in pairs) + "]"


@cache
def _marks() -> dict[str, str]:
    return {
        "email": "@",
        "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
        "card": r"[0-9](?:[ \-]?[0-9]){12}",
        "phone": r"\+[0-9][ ().0-9\-]",
        "characters": _ranges(_characters()[0]),
        "numbers": (
            rf"(?i){_ANY_WORD}{_BETWEEN}{_ANY_TOKEN}{_BETWEEN}{_ANY_TOKEN}"
            rf"|{_ANY_TOKEN}{_BETWEEN}{_ANY_WORD}{_BETWEEN}{_ANY_TOKEN}"
            rf"|{_ANY_TOKEN}{_BETWEEN}{_ANY_TOKEN}{_BETWEEN}{_ANY_WORD}"
        ),
        "addresses": (
            r"(?i)@|&#64;|&#x40;|&commat;|%40|(?:^|[^A-Za-z0-9])(?:at|arroba)"
            rf"[ \t_\])}}>]{{1,8}}[A-Za-z0-9\-]+{_ANY_DOT}[A-Za-z0-9\-]"
        ),
    }


SEARCHES = (*KINDS, "characters", "numbers", "addresses")


def marked(texts: pa.Array) -> list[tuple[str, ...]]:
    """The searches that may find something in each text."""
    found = [
        pc.fill_null(pc.match_substring_regex(texts, _marks()[name]), False).to_numpy(False)
        for name in SEARCHES
    ]
    out: list[tuple[str, ...]] = [()] * len(texts)
    every = np.array(found, dtype=bool)
    for row in np.flatnonzero(every.any(axis=0)).tolist():
        out[row] = tuple(name for name, own in zip(SEARCHES, every[:, row], strict=True) if own)
    return out


def all_spans(text: str | None, searches: Collection[str] = SEARCHES) -> tuple[Spans, Spans]:
    """Base and added spans of a text."""
    base = plain_spans(text or "", searches)
    return base, added_spans(text or "", base, searches)


def written(spans: Spans) -> str:
    """``kind:start:end`` by kind and start, joined by commas."""
    return ",".join(
        f"{kind}:{start}:{end}" for kind in KINDS for start, end in sorted(spans[kind])
    )


_RESULT = (
    ", ".join(f"n_{kind} bigint" for kind in KINDS)
    + ", base_sha256 string, spans string, n_added bigint"
)


def personal_data(docs: DataFrame) -> DataFrame:
    """Every row's number of base spans of each kind, hash of these, all spans, number of added."""
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A text at a time, as Python strings take several times the room of Arrow ones.
            texts = batch.column(1)
            rows = [
                _row(text.as_py(), searches) if searches else _NONE
                for text, searches in zip(texts, marked(texts), strict=True)
            ]
            columns = zip(*rows, strict=True) if rows else [[]] * (len(KINDS) + 3)
            kinds = [*[pa.int64()] * len(KINDS), pa.string(), pa.string(), pa.int64()]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays],
                names=["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans", "n_added"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, {_RESULT}")


def _row(text: str | None, searches: Collection[str] = SEARCHES) -> tuple:
    base, added = all_spans(text, searches)
    every = {kind: base[kind] + added[kind] for kind in KINDS}
    return (
        *[len(base[kind]) for kind in KINDS],
        hashlib.sha256(written(base).encode()).hexdigest(),
        written(every),
        sum(map(len, added.values())),
    )


_NONE = _row("")
