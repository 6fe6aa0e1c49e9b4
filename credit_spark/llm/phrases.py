"""Substring dedup: words inside passages that an earlier document holds are removed.

A passage is any ``window`` consecutive words. The work is linear in the
texts, however many passages recur:

1. Sketch: every window names one phrase (of ``phrase`` words) inside it, the
   one of least hash. Equal windows name equal phrases, and neighbours mostly
   the same one, so a text has few. Phrases found in one text only can't lie
   in a recurring passage that named them.
2. Confirm: windows that named a recurring phrase are counted by a 128-bit
   hash; those in two or more texts recur, and their first document is known.
3. Compile: texts are dealt into shards. Each shard gets the passages that
   its texts share with earlier documents, as text cut from those documents,
   and compiles one Aho-Corasick automaton over words (pyahocorasick). Its
   patterns are the phrases at every (window - phrase + 1)-th word of a
   passage: every window of a passage holds one.
4. Stream: the texts of the shard run through its automaton. Every window
   around an occurrence is compared with the passages word by word; the
   words of the equal ones, if the passage is from an earlier document, go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

WINDOW = 50
# Words of one shard's texts, about: bounds an automaton's memory.
SHARD_WORDS = 500_000

# Odd factors of the rolling hashes, and their inverses modulo 2^64.
_BASES = (0x9E3779B97F4A7C17, 0xC2B2AE3D27D4EB4F)
_TURNS = tuple(pow(b, -1, 1 << 64) for b in _BASES)


def split(text: str | None) -> list[bytes]:
    """The words of a text: all but ASCII white space, as UTF-8."""
    return (text or "").encode().split()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(h: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` entries of ``h`` (unsigned 64-bit)."""
    n = len(h)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    up = np.full(n, _BASES[which], dtype=np.uint64)
    up[0] = 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * np.cumprod(up), out=sums[1:])
    down = np.full(n - size + 1, _TURNS[which], dtype=np.uint64)
    down[0] = 1
    return _mix((sums[size:] - sums[:n - size + 1]) * np.cumprod(down))


def sliding_min(a: np.ndarray, size: int) -> np.ndarray:
    """Least of every run of ``size`` entries."""
    out, have = a, 1
    while have * 2 <= size:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = size - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def named_phrases(h: np.ndarray, window: int, phrase: int) -> np.ndarray:
    """The phrase that every window names, as its hash; from the hashes of a text's words."""
    if len(h) < window:
        return np.zeros(0, dtype=np.uint64)
    return sliding_min(rolling(h, phrase), window - phrase + 1)


def _digest(joined: bytes) -> bytes:
    return hashlib.blake2b(joined, digest_size=16).digest()


def _sha(joined: bytes) -> str:
    return hashlib.sha256(joined).hexdigest()


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for start, n in slices(batch.column(column)):
            part = batch.slice(start, n)
            yield part, part.column(column).to_pylist()


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 32) -> Iterator[pa.RecordBatch]:
    """Small parts of batches, as their texts are unpacked all at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _sketch(window: int, phrase: int):
    def run(batches):
        for part, texts in _texts(batches, 1):
            digest, sha, n_words, phrases = [], [], [], []
            for text in texts:
                words = split(text)
                joined = b" ".join(words)
                digest.append(_digest(joined))
                sha.append(_sha(joined))
                n_words.append(len(words))
                named = named_phrases(word_hashes(words), window, phrase) if len(words) >= window else ()
                phrases.append(np.unique(named).view(np.int64) if len(named) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(digest, pa.binary()), pa.array(n_words, pa.int64()), pa.array(sha),
                 pa.array(phrases, pa.list_(pa.int64()))], names=["doc_id", "digest", "n_words", "sha", "phrases"])
    return run


def _pack(window: int):
    """Texts that hold a window, by digest, compressed for the shuffle."""
    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for part, texts in _texts(batches, 1):
            digest, packed, ids = [], [], []
            for doc, text in zip(part.column(0).to_pylist(), texts):
                words = split(text)
                if doc is not None and len(words) >= window:
                    joined = b" ".join(words)
                    ids.append(doc)
                    digest.append(_digest(joined))
                    packed.append(press.compress(joined))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(digest, pa.binary()), pa.array(packed, pa.binary())],
                names=["first", "digest", "packed"])
    return run


def _windows(window: int, phrase: int):
    """Distinct windows of each text that named a recurring phrase, as two hashes."""
    def run(batches):
        press = zstandard.ZstdDecompressor()
        for batch in _parts(batches):
            rows = zip(*(c.to_pylist() for c in batch.columns))
            for doc, shard, packed, phrases in rows:
                h = word_hashes(press.decompress(packed).split(b" "))
                recurs = np.isin(named_phrases(h, window, phrase), np.array(phrases, dtype=np.int64).view(np.uint64))
                a, at = np.unique(rolling(h, window)[recurs], return_index=True)
                b = rolling(h, window, 1)[recurs][at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(len(a), doc)),
                     pa.array(np.full(len(a), shard))], names=["a", "b", "doc", "shard"])
    return run


def _cut(window: int):
    """Passages: the runs of a text's wanted windows, as words joined by a blank."""
    def run(batches):
        press = zstandard.ZstdDecompressor()
        for batch in _parts(batches):
            out = []
            for doc, shard, packed, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                words = press.decompress(packed).split(b" ")
                hit = np.isin(rolling(word_hashes(words), window), np.array(wanted, dtype=np.int64).view(np.uint64))
                edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
                out += [(doc, shard, b" ".join(words[s:e + window - 1])) for s, e in zip(edge[::2], edge[1::2])]
            doc, shard, passage = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int64()), pa.array(doc, pa.int64()), pa.array(passage, pa.binary())],
                names=["shard", "doc", "passage"])
    return run


class Shard:
    """An automaton over the passages of a shard, and the passages themselves."""

    def __init__(self, passages: Sequence[tuple[int, bytes]], window: int, phrase: int):
        self.window, self.phrase = window, phrase
        self.code: dict[bytes, int] = {}
        step = window - phrase + 1
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
        flat, docs, starts = [], [], []
        for doc, passage in passages:
            ids = [self.code.setdefault(w, len(self.code) + 1) for w in passage.split(b" ")]
            for at in range(0, len(ids) - phrase + 1, step):
                self.automaton.add_word(tuple(ids[at:at + phrase]))
            n = len(ids) - window + 1
            starts.append(np.arange(len(flat), len(flat) + n))
            docs.append(np.full(n, doc))
            flat += ids
        if not starts:
            return
        self.automaton.make_automaton()
        self.flat = np.array(flat, dtype=np.int64)
        starts, docs = np.concatenate(starts), np.concatenate(docs)
        h = rolling(_mix(self.flat.view(np.uint64)), window)[starts]
        order = np.argsort(h, kind="stable")
        self.hash, self.start, self.doc = h[order], starts[order], docs[order]

    def covered(self, doc: int, words: Sequence[bytes]) -> np.ndarray:
        """Which words lie in a window that starts in a document before ``doc``."""
        gone = np.zeros(len(words), dtype=bool)
        if not self.code or len(words) < self.window:
            return gone
        ids = tuple(self.code.get(w, 0) for w in words)
        ends = np.fromiter((e for e, _ in self.automaton.iter(ids)), np.int64)
        if not len(ends):
            return gone
        window = self.window
        # A window that holds an occurrence starts at most ``window - phrase`` words before it.
        n = len(ids) - window + 1
        first = ends - self.phrase + 1
        near = np.zeros(n + 1, dtype=np.int64)
        np.add.at(near, np.clip(first - (window - self.phrase), 0, n), 1)
        np.add.at(near, np.minimum(first + 1, n), -1)
        at = np.flatnonzero(np.cumsum(near[:n]))
        text = np.array(ids, dtype=np.int64)
        h = rolling(_mix(text.view(np.uint64)), window)[at]
        place = np.searchsorted(self.hash, h)
        mine = np.lib.stride_tricks.sliding_window_view(text, window)
        theirs = np.lib.stride_tricks.sliding_window_view(self.flat, window)
        hit = np.zeros(len(text) + 1, dtype=np.int64)
        while len(at):
            # Every passage window of the same hash, one after another.
            same = place < len(self.hash)
            same[same] = self.hash[place[same]] == h[same]
            at, place, h = at[same], place[same], h[same]
            early = self.doc[place] < doc
            a, p = at[early], self.start[place[early]]
            for k in range(0, len(a), 4096):
                found = a[k:k + 4096][(mine[a[k:k + 4096]] == theirs[p[k:k + 4096]]).all(axis=1)]
                np.add.at(hit, found, 1)
                np.add.at(hit, found + window, -1)
            place = place + 1
        return np.cumsum(hit[:-1]) > 0


def _stream(window: int, phrase: int):
    """Per text: what is left. A shard's passages come before its texts."""
    def run(batches):
        press = zstandard.ZstdDecompressor()
        shard, passages, automaton = None, [], None
        for batch in _parts(batches):
            out = []
            for key, doc, digest, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if key != shard:
                    shard, passages, automaton = key, [], None
                if digest is None:
                    passages.append((doc, payload))
                    continue
                if automaton is None:
                    automaton, passages = Shard(passages, window, phrase), []
                words = press.decompress(payload).split(b" ")
                gone = automaton.covered(doc, words)
                if gone.any():
                    edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                    spans = [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])]
                    out.append((digest, int(gone.sum()), _sha(b" ".join(w for w, g in zip(words, gone) if not g)), spans))
            digest, n, sha, spans = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["digest", "n_removed", "sha", "spans"])
    return run


def find_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """Words of recurring passages in all but the document of least id.

    Result: ``doc_id`` (long), ``n_words``, ``n_removed`` (longs), ``removed``
    (array of ``start`` and ``end``, word numbers from 0, end exclusive) and
    ``kept_sha256`` (of the words left, joined by a blank), a row per input
    row.

    - null or empty text, or fewer words than a window: nothing is removed
    - equal texts: one of them, of the least id, goes through the automata;
      the others lose all their words if they hold a window
    - repeated rows (same id): none is before the other, each has its row
    - a null id is neither before nor after any other: nothing is removed
      from it, and nothing for it
    - empty table: no rows; other columns, whatever their names, are ignored
    - a passage that a third of all documents hold: phrases and windows are
      counted with partial aggregation; a shard gets it once
    """
    phrase = max(1, window // 2)
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    sketch = stored(base.mapInArrow(
        _sketch(window, phrase), "doc_id long, digest binary, n_words long, sha string, phrases array<long>"), "sketch")

    # Distinct texts, each under its least id.
    texts = stored(sketch.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.first("n_words").alias("n_words"), F.first("phrases").alias("phrases"))
        .where("first IS NOT NULL"), "texts")
    named = texts.where("phrases IS NOT NULL").select("digest", "first", F.explode("phrases").alias("phrase"))
    recurring = stored(named.groupBy("phrase").agg(F.min("first").alias("low"), F.max("first").alias("high"))
                       .where("low < high").select("phrase"), "phrases")
    held = (named.join(recurring, "phrase").groupBy("digest", "first")
            .agg(F.collect_list("phrase").alias("phrases")))
    held = stored(held.join(texts.select("digest", "n_words"), "digest"), "held")
    total = held.agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    held = held.select("digest", "first", "phrases", F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard"))
    packed = base.mapInArrow(_pack(window), "first long, digest binary, packed binary")
    # Repeated rows, of one id and text, are one text here.
    found = stored(held.join(packed, ["digest", "first"]).dropDuplicates(["digest"]), "held-texts")

    # Windows that recur, with their first document, for the shards that need them.
    windows = (found.select("first", "shard", "packed", "phrases")
               .mapInArrow(_windows(window, phrase), "a long, b long, doc long, shard long")
               .groupBy("a", "b", "shard").agg(F.min("doc").alias("low"), F.max("doc").alias("high")))
    windows = stored(windows, "windows")
    least = stored(windows.groupBy("a", "b").agg(F.min("low").alias("doc"), F.max("high").alias("last"))
                   .where("doc < last").select("a", "b", "doc"), "recurring")
    wanted = (windows.join(least, ["a", "b"]).where("high > doc").groupBy("doc", "shard")
              .agg(F.collect_list("a").alias("wanted")))
    sources = found.select(F.col("first").alias("doc"), "packed")
    passages = (wanted.join(sources, "doc").select("doc", "shard", "packed", "wanted")
                .mapInArrow(_cut(window), "shard long, doc long, passage binary"))

    every = passages.select("shard", "doc", F.lit(None).cast("binary").alias("digest"),
                            F.col("passage").alias("payload")) \
        .unionByName(found.select("shard", F.col("first").alias("doc"), "digest", F.col("packed").alias("payload")))
    left = stored(every.repartition("shard").sortWithinPartitions("shard", F.col("digest").isNotNull())
                  .mapInArrow(_stream(window, phrase), "digest binary, n_removed long, sha string, "
                              "spans array<struct<start:long,end:long>>"), "left")

    all_words = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    none = F.array().cast("array<struct<start:long,end:long>>")
    whole = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= window)
    part = (F.col("doc_id") == F.col("first")) & F.col("n_removed").isNotNull()
    out = (sketch.select("doc_id", "digest", "n_words", F.col("sha").alias("own"))
           .join(texts.select("digest", "first"), "digest", "left").join(left, "digest", "left"))
    return out.select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).when(part, F.col("n_removed")).otherwise(F.lit(0).cast("long"))
        .alias("n_removed"),
        F.when(whole, all_words).when(part, F.col("spans")).otherwise(none).alias("removed"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).when(part, F.col("sha")).otherwise(F.col("own"))
        .alias("kept_sha256"))
