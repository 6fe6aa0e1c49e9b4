"""Secret scans with a guess-cost estimate of credential values.

Three patterns find the well-known kinds. Beside them, whatever stands as a
value behind a credential word (``pwd: ...``, ``passphrase is ...``) is
rated by dynamic programming: the cheapest way to write it as a sequence of
common words, dates, repeats, keyboard walks and brute-force characters.
A value that would take many guesses is a secret; a placeholder isn't.
"""

from __future__ import annotations

import re
from functools import lru_cache
from math import log10

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, stored

# Guesses (as a power of ten) from which a value counts as a secret.
MIN_LOG10_GUESSES = 10.0
# Kinds of characters (lower, upper, digits, other) that such a value has at least: any value is rated.
MIN_CLASSES = 1
# The commonest words of the corpus are known to guessers, too: so many at most, of so many
# letters, in so many documents at least. Only this list is limited by them. Words of equal
# count are taken together or not at all.
CORPUS_WORDS = 20_000
WORD_LETTERS = (3, 24)
WORD_DOCS = 3
MIN_VALUE = 6
# Longer values are rated anew each time.
MEMO_CHARS = 128

KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
# A whole identifier (perhaps with " key" behind it) and the sign that gives it a value.
CONTEXT = re.compile(
    r"(?<![\w-])((?ai:mot[ -]de[ -]passe)(?![\w-])|[\w-]++(?:\x20(?ai:keys?)(?![\w-]))?)[\"'`]?\]?\s*+"
    r"(?:(?ai:(is|ist|est|es))\b\s*+(:)?|[:=]+>?)\s*+(?:(?ai:bearer|basic)\x20++)?")
# Credential words: the long ones anywhere in an identifier, the short ones as a part of it by
# underscore, hyphen, digit or camel case (not "compass", "author", "spinning").
KEY = re.compile(
    r"(?ai:passw(?:or)?d|passphrase|passcode|pwd|secret|token|api[ _-]?key|credential|authorization"
    r"|passwort|kennwort|contrase[\u00f1n]a|mot[ _-]?de[ _-]?passe)|(?<![^\W\d_])(?ai:clave)(?![^\W\d_])"
    r"|(?<![^\W\d_])(?ai:pass|pin|auth)(?![^\W\d_])"
    r"|(?<![^\W\d_])(?:[Pp]ass|[Pp]in|[Aa]uth)(?=[A-Z])"
    r"|(?<=[a-z])(?:P(?:ass|ASS|in|IN)|A(?:uth|UTH))(?![a-z])")
QUOTED = re.compile(r"([\"'`])((?:(?!\1)[^\\\n]|\\.)*+)\1")
# A comma, semicolon or ampersand before the next name with a value ends a bare value.
BARE = re.compile(r"[\"'`]?((?:[^\s\"'`,;&<]|[,;&](?!\s*+[\w-]++\s*+[:=])|<(?!/))++)")
# Any match of ASSIGN or CONTEXT holds one of these, in lower case.
HINTS = ("pass", "pwd", "pin", "secret", "token", "api", "credential", "auth", "kennwort", "contrase", "clave")
# Behind a bare "is", plain words go on with the sentence unless they are quoted ("is case-sensitive").
PROSE = re.compile(r"[^\W\d_]+(?:['\u2019-][^\W\d_]+)+|[^\W\d_]?[^\W\d_A-Z]{,15}")

# Words that guessers try first, the commonest at the start.
COMMON_WORDS = (
    "password", "admin", "welcome", "letmein", "qwerty", "secret", "login", "master", "dragon", "monkey",
    "shadow", "sunshine", "princess", "football", "baseball", "superman", "batman", "iloveyou", "trustno",
    "starwars", "hello", "freedom", "whatever", "changeme", "change", "default", "guest", "test", "user",
    "root", "pass", "passwd", "your", "here", "my", "the", "example", "sample", "dummy", "placeholder",
    "insert", "enter", "key", "token", "api", "value", "string", "none", "null", "true", "false", "todo",
    "redacted", "hidden", "required", "invalid", "missing", "empty", "unknown", "summer", "winter", "spring",
    "autumn", "monday", "friday", "january", "april", "june", "july", "august", "october", "december", "love",
    "money", "michael", "jordan", "jennifer", "thomas", "charlie", "daniel", "hunter", "killer", "george",
    "computer", "internet", "server", "database", "system", "access", "account", "private", "public", "demo",
    "temp", "house", "summer", "flower", "cheese", "coffee", "orange", "purple", "yellow", "silver", "golden",
    "correct", "horse", "battery", "staple", "and", "for", "new", "old", "not", "set", "one", "two", "app")

_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_LEET = str.maketrans("@430!1$57+", "aaeoilssti"[:10])
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
# What stands for a value or leads to a page is no secret by itself: an address up to its query, without
# a name and password, and words in brackets ("<your-token-here>", perhaps without the closing one). It
# costs as much as a choice among so many.
_LINK = re.compile(r"(?i:https?|ftp)://[^\s@?#]++(?!@)")
_STAND_IN = re.compile(r"[<\[{($%]+(?:[a-z]{1,15}|[A-Z]{1,15})(?:[ _.-](?:[a-z]{1,15}|[A-Z]{1,15}))+[>\]})%]*"
                       r"|[<\[{($%]+(?:[a-z]{1,15}|[A-Z]{1,15})[>\]})%]+")
STAND_INS = 1000


def _neighbours() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for r, row in enumerate(_ROWS):
        for i, c in enumerate(row):
            near[c] = {row[j] for j in (i - 1, i + 1) if 0 <= j < len(row)}
            near[c] |= {other[j] for d in (-1, 1) if 0 <= r + d < len(_ROWS)
                        for other in (_ROWS[r + d],) for j in (i, i - d) if 0 <= j < len(other)}
    return near


_NEAR = _neighbours()
_RANK = {}
for _i, _w in enumerate(COMMON_WORDS):
    _RANK.setdefault(_w, _i + 1)


class Words:
    """Ranks of the words that guessers try: the fixed ones, then those of the corpus, commonest first."""

    def __init__(self, corpus: list[str]):
        self.rank = dict(_RANK)
        for i, w in enumerate(corpus):
            self.rank[w] = min(i + 1 + len(COMMON_WORDS), self.rank.get(w, i + 1 + len(COMMON_WORDS)))
        self.longest = max(map(len, self.rank))
        self.cost = lru_cache(maxsize=4096)(lambda value: _cost(value, self.rank, self.longest))

    def log10_guesses(self, value: str) -> float:
        return self.cost(value) if len(value) <= MEMO_CHARS else _cost(value, self.rank, self.longest)


def _class_size(c: str) -> int:
    return 10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 100


def _brute(c: str) -> float:
    return log10(_class_size(c))


def log10_guesses(value: str) -> float:
    """Least cost of any segmentation, as a power of ten; in time linear in the value's length."""
    return _FIXED.log10_guesses(value)


def _cost(value: str, ranks: dict[str, int], longest: int) -> float:
    n = len(value)
    low = value.lower()
    low = low if len(low) == n else value
    plain = low.translate(_LEET)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]    # by start: (end, cost)
    for i in range(n):
        for j in range(i + 2, min(n, i + longest) + 1):
            rank = ranks.get(low[i:j]) or 2 * ranks.get(plain[i:j], 0)
            if rank:
                ends[i].append((j, log10(rank * (2 if value[i:j] != low[i:j] else 1)) + 0.3))
    for m in _DATE.finditer(value):
        ends[m.start()].append((m.end(), log10(119 if len(m.group()) == 4 else 119 * 365)))
    for pattern in (_LINK, _STAND_IN):
        for m in pattern.finditer(value):
            ends[m.start()].append((m.end(), log10(STAND_INS)))
    run = walk = 0
    for i in range(1, n + 1):
        if i == n or value[i] != value[run]:
            for s in range(run, i - 2):     # any part of a run from its start on
                ends[s].append((i, log10(_class_size(value[run]) * (i - s))))
            run = i
        if i == n or low[i] not in _NEAR.get(low[i - 1], ()):
            for s in range(walk, i - 2):
                ends[s].append((i, log10(len(_NEAR) * 4 * (i - s))))
            walk = i
    best = [0.0] + [float("inf")] * n
    for i in range(n):
        here = best[i]
        if here + _brute(value[i]) < best[i + 1]:
            best[i + 1] = here + _brute(value[i])
        for j, cost in ends[i]:
            if here + cost < best[j]:
                best[j] = here + cost
    return best[n]


_FIXED = Words([])


def _classes(value: str) -> int:
    return sum((any(c.islower() for c in value), any(c.isupper() for c in value),
                any(c.isdigit() for c in value), any(not c.isalnum() for c in value)))


def _value(text: str, at: int) -> tuple[int, int]:
    """Span of the value at ``at``: up to the closing quote on its line, else up to a blank or quote."""
    if m := QUOTED.match(text, at):
        return m.span(2)
    m = BARE.match(text, at)
    return (m.start(1), m.start(1) + len(m.group(1).rstrip(".)]}!?:,;>"))) if m else (at, at)


def base_spans(text: str, words: Words = _FIXED) -> list[tuple[str, int, int, float | None]]:
    """The three well-known kinds, in no order; assigned values come with their cost."""
    out = []
    low = text.lower()
    if any(h in low for h in ("passw", "secret", "token", "api")):
        out += [("assign", m.start(), m.end(), words.log10_guesses(m.group(2)))
                for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text) if len(m.group()) >= 18]
    out += [("hex", m.start(), m.end(), None) for m in HEX.finditer(text)]
    return out


def guess_spans(text: str, taken: list[tuple[str, int, int, float | None]], min_log10: float,
                min_classes: int, words: Words = _FIXED) -> list[tuple[str, int, int, float]]:
    """Credential values that take many guesses and reach beyond the spans found before."""
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    out = []
    covered = []
    for s, e in sorted((s, e) for _, s, e, _ in taken):
        if covered and s <= covered[-1][1]:
            covered[-1][1] = max(e, covered[-1][1])
        else:
            covered.append([s, e])
    k = 0
    m = CONTEXT.search(text)
    while m:
        after = m.end()
        start, end = _value(text, after) if KEY.search(m.group(1)) else (after, after)
        if m.group(2) and not m.group(3) and start == after and PROSE.fullmatch(text, start, end):
            end = start
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        if k < len(covered) and covered[k][0] <= start and end <= covered[k][1]:
            after = end
        elif end - start >= MIN_VALUE and _classes(text[start:end]) >= min_classes:
            cost = words.log10_guesses(text[start:end])
            if cost >= min_log10:
                out.append(("guess", start, end, cost))
                after = end
        # A value that isn't accepted may itself be a name with a value. Few follow each other
        # without a blank: each adds to the cost.
        m = CONTEXT.search(text, after)
    return out


def least_count(counts: DataFrame, most: int, bins: int = 1024) -> int:
    """The least ``n`` that at most ``most`` rows of ``counts`` reach.

    Histograms of ``n``, each inside one bin of the last: ``bins`` rows at
    most reach the driver a round, and the rounds are few (the logarithm of
    the largest count to the base ``bins``).
    """
    top = counts.agg(F.max("n")).first()[0]
    if top is None:
        return 1
    low, high, above = 1, top, 0        # ``above``: rows with n > high
    while True:
        width = -(-(high - low + 1) // bins)
        found = {r.bin: r["count"] for r in counts.where(F.col("n").between(low, high)).groupBy(
            F.floor((F.col("n") - low) / width).alias("bin")).count().collect()}
        for b in sorted(found, reverse=True):
            if above + found[b] > most:
                break
            above += found[b]
        else:
            return low
        if width == 1:
            return low + b + 1
        low, high = low + b * width, min(high, low + (b + 1) * width - 1)


def corpus_words(docs: DataFrame, text_col: str = "text", most: int | None = None) -> list[str]:
    """The words in most documents, lower case, commonest first: ``CORPUS_WORDS`` or ``most`` of them, or fewer.

    What stands behind a colon, an equals sign or "is" isn't counted, so
    that a secret in many copies doesn't become a word. The counts are
    written; only words of the least count that fits reach the driver.
    """
    value = r"""(?i)(?:[:=]|\bis\b)[\s:=]*+(?:"[^"\n]*+"|'[^'\n]*+'|`[^`\n]*+`|\S++)"""
    text = F.lower(F.regexp_replace(F.col(text_col).cast("string"), value, " "))
    least, longest = WORD_LETTERS
    found = docs.select(F.explode(F.array_distinct(F.split(text, r"[^\p{L}]+"))).alias("word"))
    counts = stored(found.where(F.length("word").between(least, longest)).groupBy("word")
                    .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= WORD_DOCS), "corpus-words")
    common = counts.where(F.col("n") >= least_count(counts, CORPUS_WORDS if most is None else most)).collect()
    return [r.word for r in sorted(common, key=lambda r: (-r.n, r.word))]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         min_log10: float = MIN_LOG10_GUESSES, min_classes: int = MIN_CLASSES) -> DataFrame:
    """Secrets in whole texts: ``id_col`` and ``spans``, a row per document.

    ``spans``: array of (kind, start, end, log10_guesses), by start, then
    kind; offsets in code points, end exclusive; ``log10_guesses``, the
    least cost of the value, for kinds ``assign`` (all are returned, strong
    or not) and ``guess`` (from ``min_log10`` on).

    Texts are read twice: the corpus's own common words are counted first.

    - null or empty text: no spans
    - very long texts and values: whole; the rating is linear in the value
    - equal texts, repeated rows, null ids: a row each; empty table: no rows
    """
    common = corpus_words(docs, text_col)

    def make():
        words = Words(common)

        def one(text):
            if not text:
                return []
            found = base_spans(text, words)
            all_of = found + guess_spans(text, found, min_log10, min_classes, words)
            return [{"kind": k, "start": s, "end": e, "log10_guesses": c}
                    for k, s, e, c in sorted(all_of, key=lambda f: (f[1], KINDS.index(f[0])))]
        return lambda texts: [[one(t) for t in texts]]

    out = map_text(docs, F.col(text_col), [id_col],
                   "spans array<struct<kind:string,start:int,end:int,log10_guesses:double>>", make)
    return out.select(F.col(f"row.`{id_col}`").alias(id_col), "spans")
