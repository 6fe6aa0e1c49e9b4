"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a linked list. A heap gives the adjacent pair of the
lowest rank (leftmost first); it is merged and its new neighbours go on the
heap. The count is the initial symbols less the merges; no ids are emitted.
"""

from __future__ import annotations

import functools
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocabulary as V
from .common import map_text

# Words whose counts a worker remembers; the memory is cleared when it is full.
MEMO_WORDS = 500_000
# Longer words are counted anew each time.
MEMO_CHARS = 64


class Counter:
    def __init__(self, vocab: V.Vocabulary):
        self.vocab = vocab
        self.memo = _Memo(self)

    def word(self, word: bytes) -> int:
        """Tokens of one word (not empty)."""
        get, merged = self.vocab.pairs.get, self.vocab.merged
        n = len(word)
        first = self.vocab.first
        sym = [first[b] for b in word]
        sym[-1] = self.vocab.last[word[-1]]
        after = list(range(1, n + 1))       # n: no right neighbour
        before = list(range(-1, n - 1))
        # An entry is rank << 32 | place of the left symbol.
        heap = [r << 32 | i for i, r in enumerate(map(get, [a << 32 | b for a, b in zip(sym, sym[1:])]))
                if r is not None]
        heapify(heap)
        merges = 0
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            j = after[i]
            if j >= n or sym[i] < 0 or get(sym[i] << 32 | sym[j]) != top >> 32:
                continue  # one of the two has been merged meanwhile
            merges += 1
            new = sym[i] = merged[top >> 32]
            sym[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = get(new << 32 | sym[k])
                if r is not None:
                    heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = get(sym[h] << 32 | new)
                if r is not None:
                    heappush(heap, r << 32 | h)
        return n - merges

    def text(self, text: str | None) -> int:
        return sum(map(self.memo.__getitem__, self.vocab.pieces(text))) if text else 0


@functools.lru_cache(maxsize=2)
def counter(data: bytes) -> Counter:
    """The counter of a tokenizer file, made once per worker."""
    return Counter(V.load(data))


class _Memo(dict):
    """Word -> count; counts what it doesn't hold."""

    def __init__(self, counter: Counter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> int:
        if word in self.counter.vocab.special:
            return 1
        n = self.counter.word(word.encode())
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = n
        return n


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts of whole texts: ``id_col``, ``n_bytes`` and ``n_tokens`` (longs).

    ``tokenizer`` is the path of a tokenizer file on the driver; it is
    broadcast (64 MB at most).

    - null or empty text: 0 bytes, 0 tokens
    - very long texts: whole, in time n log n of the longest word
    - equal texts and repeated rows: a row each; empty table: no rows
    """
    shared = docs.sparkSession.sparkContext.broadcast(V.read_file(tokenizer))

    def make():
        c = counter(shared.value)
        return lambda texts: ([len(t.encode()) if t else 0 for t in texts], [c.text(t) for t in texts])

    out = map_text(docs, F.col(text_col), [id_col], "n_bytes bigint, n_tokens bigint", make)
    return out.select(F.col(f"row.`{id_col}`").alias(id_col), "n_bytes", "n_tokens")
