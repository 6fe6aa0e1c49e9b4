"""Small tables with the awkward cases that every operator must handle."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType())])

LONG = "word " * 30_000 + "end"


def awkward(spark, clash: bool = True):
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rows = [
        (1, "The cat sat on the mat, then the cat slept.", "en", "a", 43),
        (2, "The cat sat on the mat, then the cat slept.", "en", "a", 43),
        (2, "The cat sat on the mat, then the cat slept.", "en", "a", 43),
        (3, None, "en", "a", None), (4, "", None, None, 0), (5, "   \n\t ", "de", "b", 6),
        (None, "no id here", "fr", "b", 10), (6, LONG, "en", "c", len(LONG)), (7, "Übergröße 🙂 ΣΑΣ", "de", None, 14)]
    df = spark.createDataFrame(rows, DOCS)
    if clash:
        from pyspark.sql import functions as F
        for name in ("row", "ids", "n_tokens", "fp", "spans", "shard", "kept", "rank", "_w", "label", "at"):
            df = df.withColumn(name, F.lit("mine"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
