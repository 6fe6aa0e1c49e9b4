"""Reading a byte-pair-encoding tokenizer file (the public JSON layout).

Supported, which covers the byte-level and the word-end kinds: normalizers
NFC, Replace of white space and Lowercase; pre-tokenizers Split by a regular
expression whose matches are the words, and ByteLevel; BPE without dropout,
unknown token or byte fallback; decoders ByteLevel and none.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata
from dataclasses import dataclass, field

import regex

# Largest tokenizer file that is broadcast to the executors.
MAX_FILE_BYTES = 64 << 20

# The split that byte-level tokenizers apply before merging (fixed value).
BYTE_LEVEL_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+"
                    r"|[\s]+(?![^\s])|[\s]+")


# Letters and numbers that Unicode 16 has beside those of
# Python's tables (15.1), and upper-case letters that Python can't lower.
NEWER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
NEWER_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
NEWER_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
_NEWER_UPPER = re.compile("[" + "".join(map(chr, NEWER_LOWER)) + "]")


@functools.cache
def _ranges(kind: str, newest: bool, limit: int) -> str:
    """The characters of a Unicode class up to ``limit``, as ranges inside a character class.

    With explicit ranges the standard ``re`` module can match the classes,
    several times as fast as a property lookup. ``newest``: by the current
    Unicode tables (the byte-level split), else by those of Unicode 16 (the
    others); the two differ in letters added to Unicode lately.
    """
    if kind == "s":
        return r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    text = "".join(chr(c) for c in range(limit + 1) if not 0xD800 <= c < 0xE000)
    if newest:
        codes = [ord(m.group()) for m in regex.finditer(rf"\p{{{kind}}}", text)]
    else:
        newer = {c for a, b in (NEWER_LETTERS if kind == "L" else NEWER_NUMBERS) for c in range(a, b + 1)}
        codes = [ord(c) for c in text if unicodedata.category(c)[0] == kind or ord(c) in newer]
    out, start = [], 0
    for i, c in enumerate(codes):
        if i + 1 == len(codes) or codes[i + 1] != c + 1:
            out.append(f"\\U{codes[start]:08x}-\\U{c:08x}")
            start = i + 1
    return "".join(out)


@functools.cache
def _compiled(pattern: str, newest: bool, limit: int = sys.maxunicode) -> re.Pattern:
    """A split pattern, whose classes all stand inside brackets, for texts of characters up to ``limit``."""
    for name, kind in ((r"\p{L}", "L"), (r"\p{N}", "N"), (r"\s", "s")):
        if name in re.sub(r"\[[^]]*\]", "", pattern):
            raise ValueError(f"the split has {name} outside brackets")
        pattern = pattern.replace(name, _ranges(kind, newest, limit))
    return re.compile(pattern)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the files.

    Printable bytes stand for themselves; the others take the characters
    from U+0100 on, in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@dataclass
class Vocabulary:
    """A tokenizer's tables; words are byte strings, symbols are token ids."""

    first: list[int]                        # id of each byte inside a word
    last: list[int]                         # id of each byte at a word's end
    pairs: dict[int, int]                   # left id << 32 | right id -> rank
    merged: list[int]                       # by rank: the merged id
    tokens: dict[int, str]                  # id -> token, special ones included
    special: dict[str, int]
    split: re.Pattern                       # for any text
    split_basic: re.Pattern                 # for texts without characters over U+FFFF; faster
    lower: bool
    compose: bool
    byte_decoder: bool
    cut: re.Pattern | None = field(default=None)

    def __post_init__(self):
        if self.special:
            longest = sorted(self.special, key=len, reverse=True)
            self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")")

    def words(self, text: str) -> list[str]:
        if _latin(text):  # nothing to compose, and each letter lowers by itself
            return self.split_basic.findall(text.lower() if self.lower else text)
        text = self.normal(text)
        basic = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return (self.split_basic if basic else self.split).findall(text)

    def pieces(self, text: str) -> list[str]:
        """A text's words, with special tokens' strings as pieces of their own."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.words(text)
        out: list[str] = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self.words(part)
        return out

    def normal(self, text: str) -> str:
        if self.compose:
            text = unicodedata.normalize("NFC", text)
        if self.lower:  # character by character: no final sigma
            text = text.replace("Σ", "σ").lower()
            if _NEWER_UPPER.search(text):
                text = text.translate(NEWER_LOWER)
        return text


def _flat(node, kinds: str) -> list[dict]:
    if node is None:
        return []
    return [x for n in node[kinds] for x in _flat(n, kinds)] if node["type"] == "Sequence" else [node]


def load(data: bytes) -> Vocabulary:
    """Tables of a tokenizer file; ValueError for a kind that isn't supported."""
    spec = json.loads(data)
    model = spec["model"]
    if model.get("type", "BPE") != "BPE" or model.get("dropout") or model.get("unk_token") \
            or model.get("byte_fallback") or model.get("ignore_merges") \
            or model.get("continuing_subword_prefix"):
        raise ValueError("only plain byte-pair encoding is supported")
    lower = compose = False
    for step in _flat(spec["normalizer"], "normalizers"):
        if step["type"] == "NFC":
            compose = True
        elif step["type"] == "Lowercase":
            lower = True
        elif step != {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}:
            raise ValueError(f"normalizer {step['type']} isn't supported")
    split, newest = None, False
    for step in _flat(spec["pre_tokenizer"], "pretokenizers"):
        if step["type"] == "Split" and step["behavior"] == "Removed" and step["invert"]:
            split = step["pattern"]["Regex"]
        elif step["type"] == "ByteLevel" and not step["add_prefix_space"]:
            if step["use_regex"]:
                split, newest = BYTE_LEVEL_SPLIT, True
        else:
            raise ValueError(f"pre-tokenizer {step['type']} isn't supported")
    if split is None:
        raise ValueError("no rule splits the text")
    vocab = model["vocab"]
    end = model.get("end_of_word_suffix") or ""
    alphabet = byte_alphabet()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    parts = [(vocab[a], vocab[b]) for a, b in merges]
    merged = [vocab[a + b] for a, b in merges]
    born = {new: r for r, new in enumerate(merged)}
    # Merging a pair everywhere at once equals merging one place at a time
    # when no merged token can be part of an earlier merge.
    if len(born) != len(parts) or any(born.get(x, -1) >= r for r, p in enumerate(parts) for x in p):
        raise ValueError("merges out of order")
    pairs = {a << 32 | b: r for r, (a, b) in enumerate(parts)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError("added tokens with options aren't supported")
    decoder = spec["decoder"]
    if decoder is not None and decoder["type"] != "ByteLevel":
        raise ValueError(f"decoder {decoder['type']} isn't supported")
    return Vocabulary(
        first=[vocab[c] for c in alphabet], last=[vocab[c + end] for c in alphabet], pairs=pairs, merged=merged,
        tokens={i: t for t, i in vocab.items()} | {i: t for t, i in special.items()},
        special=special, split=_compiled(split, newest), split_basic=_compiled(split, newest, 0xFFFF), lower=lower, compose=compose,
        byte_decoder=decoder is not None)


def read_file(path: str) -> bytes:
    """A tokenizer file's bytes, for a broadcast of checked size."""
    with open(path, "rb") as f:
        data = f.read(MAX_FILE_BYTES + 1)
    if len(data) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    return data
