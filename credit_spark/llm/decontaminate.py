"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test windows are the patterns and words the symbols. For each window length
a block-shift table gives, for the two words read, how far the search may
move on; where the shift is zero, a bucket keyed by those two words (the
windows' suffix) holds the windows to compare directly.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, stored

WINDOW = 10
# Benchmark text that one search pass broadcasts, in UTF-8 bytes; a larger
# benchmark is searched in several passes. A Python worker's tables take
# about 70 times the bytes of the text.
BLOCK_BYTES = 4 << 20

# Word characters: everything but ASCII other than letters and digits; A-Z is lowered.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Search:
    """Wu-Manber tables of test windows, one set for each window length."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        owners: dict[tuple, object] = {}    # the item, or a set of several
        known: dict[bytes, bytes] = {}      # so that equal words are one object
        for item, text in items:
            w = [known.setdefault(x, x) for x in words(text)]
            for i in range(max(len(w) - window, 0) + 1 if w else 0):
                key = tuple(w[i:i + window])
                held = owners.setdefault(key, item)
                if isinstance(held, set):
                    held.add(item)
                elif held != item:
                    owners[key] = {held, item}
        self.owners = owners
        by_length = defaultdict(list)
        for pattern in owners:
            by_length[len(pattern)].append(pattern)
        self.tables = [(m, *self._tables(m, patterns)) for m, patterns in sorted(by_length.items())]

    @staticmethod
    def _tables(m: int, patterns: list[tuple]) -> tuple[int, dict, dict]:
        block = min(2, m)
        shift: dict[tuple, int] = {}
        bucket: dict[tuple, list] = defaultdict(list)
        for p in patterns:
            for end in range(block, m + 1):
                key = p[end - block:end]
                shift[key] = min(shift.get(key, m), m - end)
            bucket[p[m - block:]].append(p)
        return block, shift, dict(bucket)

    def find(self, text: list[bytes]) -> list[tuple[int, int, tuple]]:
        """(first word, end word, window) of every occurrence."""
        found = []
        n = len(text)
        for m, block, shift, bucket in self.tables:
            skip = m - block + 1
            end = m
            while end <= n:
                key = tuple(text[end - block:end])
                step = shift.get(key, skip)
                if step:
                    end += step
                    continue
                first = text[end - m]
                for p in bucket[key]:
                    if p[0] == first and p == tuple(text[end - m:end]):
                        found.append((end - m, end, p))
                end += 1
        return found

    def hits(self, text: list[bytes]) -> tuple[list[list[int]], list[str]]:
        """Merged [first, end) runs of hit words, and the items with windows in the text."""
        found = self.find(text)
        runs: list[list[int]] = []
        for start, end, _ in sorted(found, key=lambda f: f[:2]):
            if runs and start <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], end)
            else:
                runs.append([start, end])
        items = set()
        for held in (self.owners[p] for p in {f[2] for f in found}):
            items |= held if isinstance(held, set) else {held}
        return runs, sorted(map(str, items - {None}))


_built: dict[str, Search] = {}


def _tables_of(name: str, items: Broadcast, window: int) -> Search:
    """The tables of a broadcast block, made once per worker; only the last block's are kept."""
    if name not in _built:
        _built.clear()
        _built[name] = Search(items.value, window)
    return _built[name]


def _search(df: DataFrame, items: list, text_col: str, carry: list[str], window: int) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(items)
    name = uuid.uuid4().hex

    def make():
        search = _tables_of(name, shared, window)

        def run(texts):
            split = [words(t) for t in texts]
            found = [search.hits(w) if w else ([], []) for w in split]
            return [len(w) for w in split], [f[0] for f in found], [f[1] for f in found]
        return run

    return map_text(df, F.col(text_col), carry, "n_words bigint, runs array<array<int>>, items array<string>", make)


def find_leaks(docs: DataFrame, benchmark: DataFrame, carry: list[str], text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Words of documents that lie inside any occurrence of a test window.

    Result: struct ``row`` of the carried columns, ``n_words``, ``runs``
    (array of [first word, end word) runs, merged), ``items`` (sorted ids,
    as strings, of items with occurring windows); a row per document.

    The benchmark is the stated query set: its size is summed first, and it
    is dealt into blocks of ``block_bytes`` (distinct items, by a hash of id
    and text, so a text that many items share is dealt too). One block is a
    single map over the documents. Several are a pass each; the passes' hits of a document are merged by its row number
    in a stored copy.

    - null or empty text, or one without words: 0 words, no hits
    - null or empty item text: no windows; null item id: its windows count,
      but it isn't listed; repeated items: listed once
    - equal documents and repeated rows: a row each; empty tables: no hits
    """
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text")) \
        .where("length(text) > 0").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))

    def block(i):
        return [(r.item, r.text) for r in dealt.where(F.col("block") == i).select("item", "text").toLocalIterator()]

    if blocks == 1:
        return _search(docs, block(0), text_col, carry, window)
    kept = stored(docs.select(F.struct(*carry).alias("row"), F.col(text_col).alias("text"),
                              F.monotonically_increasing_id().alias("at")), "leak-docs")
    passes = None
    for i in range(blocks):
        one = stored(_search(kept, block(i), "text", ["at"], window).where("size(items) > 0 or size(runs) > 0")
                     .select("row.at", "runs", "items"), "leak-pass")
        passes = one if passes is None else passes.unionByName(one)
    # A document's runs: at most one for each word, so no larger than its text.
    merged = passes.groupBy("at").agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    counted = _search(kept, [], "text", ["row", "at"], window).select("row.row", "row.at", "n_words")
    join = F.aggregate(
        "runs", F.expr("cast(array() as array<array<int>>)"),
        lambda acc, r: F.when((F.size(acc) > 0) & (F.element_at(F.element_at(acc, -1), 2) >= r[0]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1),
                                       F.array(F.array(F.element_at(F.element_at(acc, -1), 1),
                                                       F.greatest(F.element_at(F.element_at(acc, -1), 2), r[1])))))
        .otherwise(F.concat(acc, F.array(r))))
    return (counted.join(merged, "at", "left")
            .select("row", "n_words", F.coalesce(join, F.expr("cast(array() as array<array<int>>)")).alias("runs"),
                    F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items")))


def n_hit():
    """Hit words, from ``runs``."""
    return F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + r[1] - r[0])


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents without any hit word; all columns as they were."""
    return find_leaks(docs, benchmark, docs.columns, text_col).where(F.size("runs") == 0).select("row.*")
