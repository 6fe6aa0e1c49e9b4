"""BPE encoding and decoding with batched numpy merge rounds.

The symbols of many words lie in one flat array. Each round finds every
adjacent pair's rank by binary search over the sorted pair keys, takes the
lowest rank of each word, and merges that pair in all words at once.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocabulary as V
from .common import map_text

# Words whose ids a worker remembers; the memory is cleared when it is full.
MEMO_WORDS = 400_000
# Longer words are encoded anew each time.
MEMO_CHARS = 64
# Symbols merged together; a longer word gets an array of its own.
FLAT_SYMBOLS = 1 << 20

NO_RANK = np.iinfo(np.int64).max


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocab: V.Vocabulary):
        self.vocab = vocab
        keys = np.fromiter(vocab.pairs, dtype=np.int64, count=len(vocab.pairs))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.fromiter(vocab.pairs.values(), dtype=np.int64, count=len(keys))[order]
        self.merged = np.array(vocab.merged, dtype=np.int64)
        self.first = np.array(vocab.first, dtype=np.int64)
        self.last = np.array(vocab.last, dtype=np.int64)
        self.memo: dict[str, bytes] = {}
        if vocab.byte_decoder:
            back = {c: b for b, c in enumerate(V.byte_alphabet())}
            self.token_bytes = {i: bytes(back[c] for c in t) if t not in vocab.special else t.encode()
                                for i, t in vocab.tokens.items()}
        else:
            self.token_bytes = {i: t.encode() for i, t in vocab.tokens.items()}

    # -- encoding ---------------------------------------------------------

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of symbol pairs, by binary search over the sorted keys."""
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def merge_rounds(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words (none may be empty) in one array, and each word's end in it."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        sym = self.first[raw]
        ends = np.cumsum(lengths) - 1
        sym[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(sym), NO_RANK)   # of each symbol with the next one of its word
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.rank_of(sym[inner], sym[inner + 1])
        done_sym, done_word = [], []
        while len(sym):
            # the lowest rank of each word still here
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(word)]))
            over = low == NO_RANK
            if over.any():  # words without a pair are finished
                done_sym.append(sym[over])
                done_word.append(word[over])
                sym, word, rank, low = sym[~over], word[~over], rank[~over], low[~over]
            take = np.flatnonzero(rank == low)
            # equal pairs that overlap (a a a): every second one of a run, from the left
            seq = np.arange(len(take))
            head = np.maximum.accumulate(np.where(np.r_[True, np.diff(take) != 1][:len(take)], seq, 0))
            take = take[(seq - head) % 2 == 0]
            sym[take] = self.merged[rank[take]]
            keep = np.ones(len(sym), dtype=bool)
            keep[take + 1] = False
            at = take - np.arange(len(take))    # where the merged symbols are from now on
            sym, word, rank = sym[keep], word[keep], rank[keep]
            rank[at] = NO_RANK
            # new ranks beside the merged symbols only
            look = np.unique(np.r_[at, at - 1])
            look = look[(look >= 0) & (look < len(sym) - 1)]
            look = look[word[look] == word[look + 1]]
            rank[look] = self.rank_of(sym[look], sym[look + 1])
        ids = np.concatenate(done_sym)
        owner = np.concatenate(done_word)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.cumsum(np.bincount(owner, minlength=len(words)))

    def learn(self, words: list[str], into: dict[str, bytes]) -> None:
        """Put the packed ids of new words into a dictionary."""
        batch: list[str] = []
        size = 0
        for w in [*words, None]:
            if w is None or (batch and size + 4 * len(w) > FLAT_SYMBOLS):
                if batch:
                    ids, ends = self.merge_rounds([x.encode() for x in batch])
                    packed, start = ids.astype("<u4").tobytes(), 0
                    for x, end in zip(batch, (4 * ends).tolist(), strict=True):
                        into[x] = packed[start:end]
                        start = end
                batch, size = [], 0
            if w is not None:
                batch.append(w)
                size += len(w)

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids, packed as little-endian unsigned 32-bit integers."""
        special = self.vocab.special
        split = [self.vocab.pieces(t) if t else [] for t in texts]
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        if not memo:
            memo.update((s, np.array([i], "<u4").tobytes()) for s, i in special.items())
        new = {w for words in split for w in words}.difference(memo)
        self.learn([w for w in new if len(w) <= MEMO_CHARS], memo)
        long: dict[str, bytes] = {}
        self.learn([w for w in new if len(w) > MEMO_CHARS], long)
        look = memo if not long else {**memo, **long}
        return [b"".join(map(look.__getitem__, words)) for words in split]

    # -- decoding ---------------------------------------------------------

    def decode_batch(self, packed: list[bytes]) -> list[str]:
        """The text of each packed id sequence, special tokens kept."""
        between = b"" if self.vocab.byte_decoder else b" "
        get = self.token_bytes.__getitem__
        return [between.join(map(get, np.frombuffer(p, "<u4").tolist())).decode("utf-8", "replace")
                for p in packed]


@functools.lru_cache(maxsize=2)
def codec(data: bytes) -> Codec:
    """The codec of a tokenizer file, made once per worker."""
    return Codec(V.load(data))


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  decode: bool = True) -> DataFrame:
    """Encode whole texts and decode the ids again.

    ``tokenizer`` is the path of a tokenizer file on the driver; it is
    broadcast (64 MB at most). Result: ``id_col``, ``ids`` (binary,
    little-endian unsigned 32-bit) and ``decoded`` (string, null unless
    ``decode``), a row per input row.

    - null or empty text: no ids, decoded to the empty text
    - very long texts: whole; the merge arrays hold one word at least
    - equal texts and repeated rows: a row each; empty table: no rows
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(V.read_file(tokenizer))

    def make():
        c = codec(shared.value)

        def run(texts):
            ids = c.encode_batch(texts)
            return ids, c.decode_batch(ids) if decode else [None] * len(ids)
        return run

    out = map_text(docs, F.col(text_col), [id_col], "ids binary, decoded string", make)
    return out.select(F.col(f"row.`{id_col}`").alias(id_col), "ids", "decoded")
