"""From raw documents to token ids, in five stages.

1. quality rules: documents judged good by weak supervision stay
2. line dedup: lines that ten or more documents share go, from all of them
3. SimHash near-dedup: one document of each near-duplicate group stays
4. benchmark decontamination: documents with a test window go
5. BPE: token ids, and the text decoded from them

Every stage reads all that the one before kept, from Parquet, and takes any
further columns along, whatever their names: operators carry a row as one
struct, so nothing clashes with their own columns. Only the last stage
returns columns of its own. No stage needs ids that are unique or not null;
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_spark.llm import bpe, decontaminate, line_dedup, quality, simhash
from credit_spark.llm.common import stored, table
from credit_spark.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, as they were.

    - null, empty and short texts (under 50 words): go
    - very long texts: judged whole
    - equal texts and repeated rows: one verdict, each row judged
    - a posterior of just a half: stays
    """
    return quality.clean(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without shared lines; ``n_chars`` follows the text.

    - null text: stays null; empty text: stays, an empty line is never dropped
    - very long texts: whole, lines are counted and dropped one by one
    - equal texts and repeated rows: each counts as a document of its own
    - a line in just ten documents: goes
    """
    return line_dedup.clean(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each near-duplicate group, as it was.

    - null and empty texts: fingerprint zero, one group, one of them stays
    - very long texts: one fingerprint of the whole text
    - equal texts and repeated rows: one stays
    - null ids come last; ties of the least id: the least fingerprint, then
      the first row
    """
    return simhash.keep_first(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window, as they were.

    - null and empty texts: have no words, so they stay
    - very long texts: searched whole
    - equal texts and repeated rows: each row judged, all alike
    - benchmark items that are null, empty or repeated: no windows, or the same again
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded``.

    - null and empty texts: no ids, decoded to the empty text
    - very long texts: whole
    - equal texts and repeated rows: a row each, in no given order
    """
    out = bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate_stage),
    ("bpe", encode),
]

# SQL can't express fingerprints and byte-pair merging; tests compare the
# rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
