"""Line dedup: lines that many documents share are dropped from all of them.

Lines are normalised, exploded as hashes, counted by distinct document, and
those over the threshold are dropped; the others are joined by position.

Which lines a text loses depends on the text alone (and the corpus counts),
so texts are identified by a 128-bit hash; only hashes and positions are
shuffled for the counts, and the text once, to meet its dropped positions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_CHARS = 1
MIN_DOCS = 10

_SPACES = " \t\n\x0b\f\r"


def line_keys(text: Column) -> Column:
    """The normalised lines of a text: A-Z lowered, white space stripped at both ends."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.transform(F.split(low, "\n"), lambda x: F.trim(x, F.lit(_SPACES)))


def _hash(x: Column) -> Column:
    """128 bits: two independent 64-bit hashes."""
    return F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit("second"), x).alias("b"))


def drop_shared_lines(docs: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS,
                      min_docs: int = MIN_DOCS) -> DataFrame:
    """Drop the lines whose key ``min_docs`` or more documents hold.

    Result: struct ``row`` (all columns of ``docs``), ``n_lines``,
    ``n_dropped`` (longs) and ``kept`` (the other lines, joined by a line
    feed), a row per input row. A document is a row; it counts once for a
    key, however often it holds it.

    - null or empty text: one empty line, which is never dropped
    - a text that loses all lines: the empty text
    - equal texts and repeated rows: documents of their own, all counted
    - empty table: no rows
    - a line or a text that a third of all rows hold: counted with partial
      aggregation; in the two joins the other side has one row for each hash
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.struct(*docs.columns).alias("row"), text.alias("text"))
    keyed = base.select(_hash(F.col("text")).alias("doc"), line_keys(F.col("text")).alias("keys"))
    long_enough = lambda k: F.char_length(k) >= min_chars
    hashed = stored(keyed.select(
        "doc", F.transform("keys", lambda k: F.when(long_enough(k), _hash(k))).alias("lines"),
        F.transform(F.array_distinct(F.filter("keys", long_enough)), _hash).alias("distinct")), "line-hashes")
    # The small sides of both joins are stored, so that their size is known:
    # small, they are broadcast; large, they are shuffled for the join alone,
    # and the rows of a hot line or text can be split.
    shared = stored(hashed.select(F.explode("distinct").alias("key")).groupBy("key")
                    .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("key"), "shared-lines")
    dropped = stored(hashed.select("doc", F.posexplode("lines").alias("at", "key")).where(F.col("key").isNotNull())
                     .join(shared, "key").groupBy("doc").agg(F.collect_set("at").alias("drop")),
                     "dropped-lines")
    # The lines stand in a column of their own, so that they are split once.
    joined = base.withColumn("doc", _hash(F.col("text"))).join(dropped, "doc", "left") \
        .withColumn("split", F.split("text", "\n"))
    split = F.col("split")
    kept = F.when(F.col("drop").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), "drop"),
                                 lambda i: F.get(split, i)), "\n"))
    return joined.select("row", F.size(split).cast("long").alias("n_lines"),
                         F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def clean(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents with shared lines dropped; ``length_col`` is their new length.

    A null text stays null.
    """
    out = drop_shared_lines(docs, text_col)
    new = {text_col: F.when(F.col(f"row.`{text_col}`").isNotNull(), F.col("kept"))}
    if length_col in docs.columns:
        new[length_col] = F.when(F.col("n_dropped") > 0, F.char_length("kept").cast(docs.schema[length_col].dataType)) \
            .otherwise(F.col(f"row.`{length_col}`"))
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
