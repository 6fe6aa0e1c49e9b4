"""Personal data, with offset-preserving deobfuscation.

Four patterns find plain identifiers. Beside them, three transducers undo
disguises: look-alike characters, spelled digits, and "at" and "dot" for
their signs, in English, German, French and Spanish. Each keeps, for every character it writes, the span of source
characters that it stands for; identifiers found in the normal form are
mapped back to the source text.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text

KINDS = ("email", "ip", "card", "phone")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# Characters that look like ASCII letters.
LOOK_ALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "А": "A", "В": "B", "С": "C", "Е": "E",
    "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "Α": "A", "Β": "B",
    "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "․": ".", "。": ".", "﹒": ".", "﹫": "@", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "\u2212": "-", "\u00a0": " ", "\u2007": " ", "\u2009": " ", "\u202f": " "}
# Soft hyphen, zero-width characters and joiners, byte order mark.
NOTHING = ("\u00ad", "\u200b", "\u200c", "\u200d", "\u2060", "\ufeff")
# Digits in English, German, French and Spanish.
DIGITS = {
    "en": ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"),
    "de": ("null", "eins", "zwei", "drei", "vier", "f\u00fcnf", "sechs", "sieben", "acht", "neun"),
    "fr": ("z\u00e9ro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"),
    "es": ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve")}
# Other forms of them.
DIGIT_FORMS = {"oh": "0", "zwo": "2", "fuenf": "5", "zero": "0", "une": "1"}
DIGIT_WORDS = DIGIT_FORMS | {w: str(d) for words in reversed(DIGITS.values()) for d, w in enumerate(words)}

_ODD = re.compile("[" + "".join(LOOK_ALIKES) + "".join(NOTHING)
                  + "\uff01-\uff5e\u0660-\u0669\u06f0-\u06f9\u0966-\u096f]")


def _one_of(words) -> str:
    """A pattern of any of the words, longest first, tried by their first letters."""
    by_first: dict[str, list[str]] = {}
    for w in sorted(words, key=lambda w: (-len(w), w)):
        by_first.setdefault(w[0], []).append(w[1:])
    return "(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in sorted(by_first.items())) + ")"


_DIGIT_WORD = _one_of(DIGIT_WORDS)
_NO_LETTER = r"(?![^\W\d_])"
# A run of spelled digits, perhaps with plain ones between: three words at least.
_SPELLED = re.compile(
    rf"(?<![^\W\d_])(?:(?i:plus|m[\u00e1a]s)[\x20-]+)?(?i:{_DIGIT_WORD}|[0-9])"
    rf"(?:[\x20,.-]{{1,2}}(?i:{_DIGIT_WORD}|[0-9]){_NO_LETTER}){{2,}}")
_SPELLED_PART = re.compile(rf"(?i:(plus|m[\u00e1a]s)|({_DIGIT_WORD}))|([0-9])")

# The signs by name. A bare English "at" is mostly prose, so it only counts before a disguised dot.
AT_NAMES = ("arobase", "arroba", "klammeraffe")
DOT_NAMES = ("dot", "punkt", "point", "punto")
_ANY_AT, _ANY_DOT = "|".join(("at", "@", *AT_NAMES)), "|".join(DOT_NAMES)
_OPEN, _CLOSE = r"[(\[{<]", r"[)\]}>]"
# A disguised dot, and a label before it of 63 characters at most, as all are.
_HIDDEN_DOT = rf"(?:\s*{_OPEN}\s*(?i:{_ANY_DOT}|\.)\s*{_CLOSE}|\s+(?i:{_ANY_DOT})\s)"
_LABEL = r"[A-Za-z0-9-]{1,63}"
# "at jane.doe@...": the at-sign comes later.
_NO_SIGN_LATER = rf"(?![A-Za-z0-9._%+-]+(?:@|\s*{_OPEN}\s*(?i:{_ANY_AT})))"
# Blanks before a bracket are taken from the start of their run only: else a long run would be
# scanned once from each of its characters.
_AT = re.compile(rf"(?:(?<!\s)\s+)?{_OPEN}\s*(?i:{_ANY_AT})\s*{_CLOSE}\s*"
                 rf"|(?<=[A-Za-z0-9])\s+(?i:at)\s+(?={_LABEL}(?:(?P<dot>\.)[A-Za-z0-9]|{_HIDDEN_DOT})){_NO_SIGN_LATER}"
                 rf"|(?<=[A-Za-z0-9])\s+(?i:@|{'|'.join(AT_NAMES)})\s+(?={_LABEL}(?:\.[A-Za-z0-9]|{_HIDDEN_DOT}))"
                 rf"{_NO_SIGN_LATER}"
                 # jane-at-example-dot-com: the same joint on both sides
                 rf"|(?<=[A-Za-z0-9])(?P<joint>[-_])(?i:{_ANY_AT})(?P=joint)(?=[A-Za-z0-9]{{1,63}}(?:-[A-Za-z0-9]{{1,63}}){{0,3}}?"
                 rf"(?P=joint)(?i:{_ANY_DOT})(?P=joint))")
_DOT = re.compile(rf"(?<=[A-Za-z0-9])(?:\s*{_OPEN}\s*(?i:{_ANY_DOT}|\.)\s*{_CLOSE}\s*|\s+(?i:{_ANY_DOT})\s+"
                  rf"|([-_])(?i:{_ANY_DOT})\1)(?=[A-Za-z0-9])")
_AT_HINT = re.compile(rf"(?i:{_OPEN}\s*(?:{_ANY_AT})\s*{_CLOSE}|\s(?:{_ANY_AT})\s|([-_])(?:{_ANY_AT})\1)")
_DOT_HINT = re.compile(rf"(?i:{_OPEN}\s*(?:{_ANY_DOT}|\.)\s*{_CLOSE}|\s(?:{_ANY_DOT})\s|([-_])(?:{_ANY_DOT})\1)")
# Any disguise of a sign holds one of these, in lower case.
_SIGN_PARTS = (*_ANY_AT.split("|")[2:], *DOT_NAMES, " @ ")
_BRACKETED = re.compile(rf"{_OPEN}\s*(?i:at|@|\.)\s*{_CLOSE}")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the run of local characters before each at-sign, as far as it is free."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1, start):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", max(free, at + 1))
    return out


def find(text: str) -> list[tuple[str, int, int]]:
    """Plain identifiers, by kind and start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 16 <= len(m.group()) <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return out


@dataclass
class Normal:
    """A normal form; ``starts`` and ``ends`` hold each character's source span."""

    text: str
    starts: list[int]
    ends: list[int]

    def rewritten(self, edits: list[tuple[int, int, str]]) -> Normal:
        """This form with non-overlapping (start, end, new) pieces replaced, in order."""
        text, starts, ends, done = [], [], [], 0
        for start, end, new in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[done:start])
            starts += self.starts[done:start]
            ends += self.ends[done:start]
            if new:
                text.append(new)
                starts += [self.starts[start]] * len(new)
                ends += [self.ends[end - 1]] * len(new)
            done = end
        return Normal("".join(text), starts, ends)


def look_alikes(form: Normal) -> Normal:
    """Look-alikes, full-width forms and digits of other scripts to ASCII; invisible characters go."""
    edits = []
    for m in _ODD.finditer(form.text):
        c = m.group()
        new = "" if c in NOTHING else LOOK_ALIKES.get(c) or unicodedata.normalize("NFKC", c)
        if new and not new.isascii():
            new = str(unicodedata.digit(new, "")) or c
        edits.append((m.start(), m.end(), new))
    return form.rewritten(edits)


def spelled_digits(form: Normal) -> Normal:
    """Runs of spelled digits to digits, without what stands between them."""
    edits = []
    for m in _SPELLED.finditer(form.text):
        if not any(p.group(2) for p in _SPELLED_PART.finditer(m.group())):
            continue
        done = m.start()
        for p in _SPELLED_PART.finditer(form.text, m.start(), m.end()):
            new = "+" if p.group(1) else DIGIT_WORDS.get(p.group().lower(), p.group())
            if p.start() > done:
                edits.append((done, p.start(), ""))
            edits.append((p.start(), p.end(), new))
            done = p.end()
    return form.rewritten(edits)


def signs(form: Normal, source: str) -> Normal:
    """"at" and "dot", in brackets or between words of an address, to their signs.

    Before a dot that is plain in the source, a bare "at" stays.
    """
    form = form.rewritten([(m.start(), m.end(), "@") for m in _AT.finditer(form.text)
                           if m.start("dot") < 0 or source[form.starts[m.start("dot")]] != "."])
    return form.rewritten([(m.start(), m.end(), ".") for m in _DOT.finditer(form.text)])


def _signs_likely(text: str) -> bool:
    low = text.lower()
    return bool(any(p in low for p in _SIGN_PARTS) and (_DOT_HINT.search(text) or _AT_HINT.search(text))
                or _BRACKETED.search(text) or "@" in text and _AT_HINT.search(text))


def disguised(text: str, plain: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Identifiers that only the normal form shows, as source spans.

    A disguise may leave a part that looks plain ("ne@example.com" behind a
    Cyrillic letter): the whole is then found beside the plain part. Spans
    that lie in a plain one of their kind are left out. A bare "at" counts
    before a disguised dot only ("met at example.org" is prose); a name
    joined with hyphens, "x-at-y-dot-z", always counts as an address.
    """
    odd = not text.isascii() and _ODD.search(text)
    if not (odd or _SPELLED.search(text) or _signs_likely(text)):
        return []
    form = Normal(text, list(range(len(text))), list(range(1, len(text) + 1)))
    form = look_alikes(form) if odd else form
    form = signs(spelled_digits(form), text)
    if form.text == text:
        return []
    # Spans of a kind don't overlap, so the last one that starts by then is the only one that may hold another.
    starts = {kind: [s for k, s, _ in plain if k == kind] for kind in KINDS}
    ends = {kind: [e for k, _, e in plain if k == kind] for kind in KINDS}
    out = []
    for kind, start, end in find(form.text):
        a, b = form.starts[start], form.ends[end - 1]
        k = bisect_right(starts[kind], a) - 1
        if form.text[start:end] == text[a:b] or k >= 0 and ends[kind][k] >= b:
            continue
        # A whole plain address, then a blank: what follows is the next word of the sentence.
        if kind == "email" and k >= 0 and starts[kind][k] == a and text[ends[kind][k]].isspace():
            continue
        out.append((kind, a, b))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data in whole texts: ``id_col`` and ``spans``, a row per document.

    ``spans``: array of (kind, start, end, disguised), by kind as in
    ``KINDS``, then start; offsets in code points of the source, end
    exclusive. Plain spans stay as their patterns find them; a disguised one
    may overlap or hold them.

    - null or empty text: no spans
    - very long texts: whole; every pattern's work is linear in the text
    - equal texts, repeated rows, null ids: a row each; empty table: no rows
    """
    def one(text):
        if not text:
            return []
        plain = find(text)
        spans = [(*f, False) for f in plain] + [(*f, True) for f in disguised(text, plain)]
        return [{"kind": k, "start": s, "end": e, "disguised": d}
                for k, s, e, d in sorted(spans, key=lambda f: (KINDS.index(f[0]), f[1], f[2]))]

    out = map_text(docs, F.col(text_col), [id_col],
                   "spans array<struct<kind:string,start:int,end:int,disguised:boolean>>",
                   lambda: lambda texts: [[one(t) for t in texts]])
    return out.select(F.col(f"row.`{id_col}`").alias(id_col), "spans")
