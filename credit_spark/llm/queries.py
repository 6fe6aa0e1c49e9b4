"""The registered queries: one thin query per operator, on whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, decontaminate, divergence, line_dedup, phrases, pii, quality, secret_scan, shards,
               simhash, sql, token_count, whitening)
from .common import table

# Folder of the public tokenizer files (a parameter of a deployment).
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
TOKEN_LIMIT = 512
SHARDS = 16


def tokenizer_path(name: str) -> str:
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join(TOKENIZERS, name)
    return public_tokenizers.path(name)


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of all documents, as digests."""
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return out.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, and whether they pass the limit."""
    out = token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside benchmark windows."""
    out = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    hit = decontaminate.n_hit()
    return out.select("row.doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (hit > 0).alias("contaminated"))


def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations from the perspective of each participant."""
    out = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("masks", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return out.withColumn("masks", F.array_join(spans, ","))


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards along the curve, row counts at most one apart."""
    out = shards.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "curve_index")


def _joined(spans):
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def _count(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    out = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    strong = F.filter("spans", lambda s: s["log10_guesses"] >= secret_scan.MIN_LOG10_GUESSES)
    return out.select("doc_id", *[_count("spans", k) for k in secret_scan.KINDS[:3]],
                      F.sha2(_joined(base), 256).alias("base_sha256"), _joined("spans").alias("spans"),
                      F.size(strong).cast("long").alias("n_strong"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate groups of all documents."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all documents keep when shared lines go."""
    out = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    out = quality.judge(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op10_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    out = pii.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: ~s["disguised"])
    return out.select("doc_id", *[_count(base, k) for k in pii.KINDS],
                      F.sha2(_joined(base), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all documents keep when passages of earlier documents go."""
    return phrases.find_repeats(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_words", "n_removed", "kept_sha256")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four leading whitened components of all embeddings."""
    out, model, error = whitening.whiten(table(spark, sf_dir, "embeddings"))
    explained = F.array(*[F.lit(float(e) / model.trace) for e in model.values]).cast("array<double>")
    return (out.select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", "whitened", F.get(explained, "at").alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of all sources of all languages, and the terms that mark them."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_bpe_codec, op2_token_counts, op3_decontaminate, op4_chat_rotation, op5_hilbert_shards, op6_secret_scan,
    op7_simhash_dedup, op8_line_dedup, op9_quality_rules, op10_pii_scan,
    op11_substring_dedup, op12_embedding_whitening, op13_source_divergence)}
ORACLE = {
    "op3_decontaminate": sql.DECONTAMINATE,
    "op4_chat_rotation": sql.chat_rotation(),
    "op8_line_dedup": sql.LINE_DEDUP,
    "op9_quality_rules": sql.quality_rules(),
    "op13_source_divergence": sql.SOURCE_DIVERGENCE,
}
