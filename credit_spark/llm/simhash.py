"""SimHash near-dedup with pivot distance tables.

Each distinct fingerprint gets a table row of Hamming distances to fixed
reference fingerprints (pivots). Distances obey the triangle inequality, so
a pair whose rows differ by more than the limit in any coordinate can't
link; it is discarded without a comparison. The survivors are compared.

So that not all pairs need be looked at, fingerprints meet in buckets: cut
into limit + 2 blocks, two fingerprints within the limit agree in two whole
blocks at least, so each goes to a bucket for every two of its blocks. That
loses no pair. Within a bucket, rows are sorted by the first pivot distance,
and only a window of them is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, stored
from .components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
N_PIVOTS = 24
# Fingerprints of a bucket compared by one task; a larger bucket is split
# into parts of about this size, and every two parts meet.
BUCKET_ROWS = 4096
# Rows that a task compares at a time.
BATCH_ROWS = 1 << 17
# Shingles whose bits are counted at a time.
COUNTED = 1 << 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return 0
    ones, total = np.zeros(64, dtype=np.int64), max(len(words) - shingle, 0) + 1
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    ends = ends.tolist()
    h = xxhash.xxh64_intdigest
    span = min(shingle, len(words)) - 1
    for lo in range(0, total, COUNTED):
        hi = min(lo + COUNTED, total)
        hashes = np.array([h(joined[s:e], SEED) for s, e in zip(starts[lo:hi], ends[lo + span:hi + span])],
                          dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, carry: list[str], text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Struct ``row`` of the carried columns and ``fp``, the fingerprint as a signed long."""
    def make():
        return lambda texts: [np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
                              .view(np.int64).tolist()]
    return map_text(docs, F.col(text_col), carry, "fp bigint", make)


def pivots(n: int = N_PIVOTS) -> list[int]:
    """Reference fingerprints, from a fixed rule: hashes of their numbers."""
    return [xxhash.xxh64_intdigest(f"pivot {i}", SEED) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def blocks(max_bits: int) -> list[list[tuple[int, int]]]:
    """For each bucket kind the (shift, width) of its two blocks of bits."""
    edges = [64 * i // (max_bits + 2) for i in range(max_bits + 3)]
    return [[(a, b - a) for a, b in pair] for pair in combinations(list(zip(edges, edges[1:])), 2)]


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of linked rows; ``label`` holds each row's set, as its least row."""
    while len(i):
        low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        apart = low != high
        i, j, low, high = i[apart], j[apart], low[apart], high[apart]
        np.minimum.at(label, high, low)
        while True:  # to the roots
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def linked(group: np.ndarray, fp: np.ndarray, max_bits: int, refs: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside groups, as pairs of fingerprints.

    Rows come sorted by group and distance to the first pivot, so the rows
    that may link to a row follow it at once.
    """
    table = [np.bitwise_count(fp ^ np.uint64(p)).astype(np.int16) for p in refs]
    label = np.arange(len(fp))
    alive = np.arange(len(fp) - 1)
    step = 1
    while len(alive):
        alive = alive[alive + step < len(fp)]
        j = alive + step
        alive = alive[(group[alive] == group[j]) & (table[0][j] - table[0][alive] <= max_bits)]
        i, j = alive, alive + step
        for row in table[1:]:
            if not len(i):
                break
            near = np.abs(row[i] - row[j]) <= max_bits
            i, j = i[near], j[near]
        near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        _union(label, i[near], j[near])
        step += 1
    at = np.flatnonzero(label != np.arange(len(fp)))
    return fp[at], fp[label[at]]


def _link_task(max_bits: int, refs: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = [], []

        def flush(last: bool):
            """Compare all whole groups; the last one may go on in the next batch."""
            nonlocal keys, fps
            key, fp = np.concatenate(keys), np.concatenate(fps)
            end = len(key) if last else int(np.argmax((key == key[-1]).all(axis=1)))
            group = np.cumsum(np.r_[True, (key[1:end] != key[:end - 1]).any(axis=1)]) if end else key[:0, 0]
            a, b = linked(group, fp[:end], max_bits, refs) if end else (fp[:0], fp[:0])
            keys, fps = [key[end:]], [fp[end:]]
            a, b = a.view(np.int64), b.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))],
                                              names=["high", "low"])

        held = 0
        for batch in batches:
            keys.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                                  for c in range(3)], axis=1))
            fps.append(batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64))
            held += batch.num_rows
            if held >= BATCH_ROWS:
                yield flush(False)
                held = len(fps[0])
        if fps:
            yield flush(True)
    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links that connect all fingerprints within ``max_bits``: longs ``high`` > ``low``.

    ``distinct`` has each fingerprint once, as the long ``fp``. Not every
    linked pair is returned, but every linked pair is connected.
    """
    fp = F.col("fp")
    kinds = blocks(max_bits)

    def bits(shift, width):
        return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))

    keyed = distinct.select("fp", F.explode(F.array(*[
        F.shiftleft(F.lit(k).cast("long"), 56).bitwiseOR(
            F.shiftleft(bits(*one), two[1]).bitwiseOR(bits(*two)))
        for k, (one, two) in enumerate(kinds)])).alias("key"))
    # Stored, so that the join knows its size; it is mostly empty.
    large = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)
                   .select("key", F.ceil(F.col("n") / bucket_rows).cast("int").alias("parts")), "large-buckets")
    part = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
    met = (keyed.join(large, "key", "left").withColumn("part", part)
           .withColumn("with", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
           .select("key", F.least("part", "with").alias("p"), F.greatest("part", "with").alias("q"), "fp"))
    refs = pivots()
    first = F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(refs[0]))))
    return (met.repartition("key", "p", "q").withColumn("d", first)
            .sortWithinPartitions("key", "p", "q", "d").select("key", "p", "q", "fp")
            .mapInArrow(_link_task(max_bits, refs), "high long, low long").where("high != low"))


def groups(fps: DataFrame, id_col: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Each distinct ``fp`` and its group: columns ``fp``, ``least`` (the group's least id), ``label`` (its least fp).

    Copies are counted out first, with partial aggregation, so a hot text
    is one row from then on.
    """
    distinct = stored(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprints")
    linked_to = components(links(distinct.select("fp"), max_bits))
    labelled = distinct.join(linked_to.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("label", "fp").alias("label"))
    # Groups of one need no further join.
    least = labelled.groupBy("label").agg(F.min("least").alias("group_least"))
    return labelled.join(least, "label").select("fp", F.col("group_least").alias("least"), "label")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """Fingerprint and group of every document: ``id_col``, ``fp`` (signed long), ``component_id``.

    Documents whose fingerprints differ in ``max_bits`` bits or fewer link;
    a group is what links connect, and ``component_id`` its least id.

    - null or empty text, or no words: fingerprint zero, linked like any other
    - fewer words than a shingle: the whole sequence is the shingle
    - null ids: a row each; a group without any id has a null component_id
    - equal texts and repeated rows: a row each, in one group
    - empty table: no rows
    """
    fps = stored(fingerprints(docs, [id_col], text_col, shingle)
                 .select(F.col(f"row.`{id_col}`").alias("id"), "fp"), "document-fps")
    found = groups(fps, "id", max_bits).select("fp", F.col("least").alias("component_id"))
    return fps.join(found, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group stays: the one of the least id; all columns as they were.

    Rows without an id come last; of several rows with the least id the one
    with the least fingerprint stays, then the first in the input.
    """
    fps = stored(fingerprints(docs, docs.columns, text_col, shingle)
                 .withColumn("at", F.monotonically_increasing_id()), "document-fps")
    found = groups(fps.select(F.col(f"row.`{id_col}`").alias("id"), "fp"), "id", max_bits).select("fp", "label")
    slim = fps.select("fp", "at", F.col(f"row.`{id_col}`").alias("id"))
    # First of each fingerprint, then of each group: a hot text is reduced before the shuffle.
    place = F.struct(F.col("id").isNull().alias("none"), "id", "fp", "at")
    one = slim.groupBy("fp").agg(F.min(place).alias("first"))
    first = one.join(found, "fp").groupBy("label").agg(F.min("first").alias("first")).select("first.at")
    return fps.join(first, "at", "left_semi").select("row.*")
