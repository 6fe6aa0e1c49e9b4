"""Helpers shared by the text operators.

Conventions of all operators here:

- Input columns are named by parameters and picked first, so that further
  columns of the input, whatever their names, never clash with results.
- A null text counts as the text each operator's docstring names (mostly
  the empty text); a row is never dropped for it.
- Intermediate tables go to the folder in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType, _parse_datatype_string

from credit_spark.session import scratch_path

# Texts handed to one call of a per-batch function, in UTF-8 bytes: bounds
# the memory of a Python worker, whatever Arrow's batch size is.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: later reads survive the loss of any executor and all
    see the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, count) runs of a string array of about ``limit`` bytes each."""
    start, size = 0, 0
    lengths = texts.cast(pa.large_binary()).to_pylist() if texts.type == pa.null() else None
    import pyarrow.compute as pc
    lengths = [0] * len(texts) if lengths is not None else pc.binary_length(texts).to_pylist()
    for i, n in enumerate(lengths):
        n = n or 0
        if size and size + n > limit:
            yield start, i - start
            start, size = i, 0
        size += n + 64
    if start < len(lengths):
        yield start, len(lengths) - start


def map_text(df: DataFrame, text: Column, carry: Sequence[str], fields: str,
             make: Callable[[], Callable[[list], Sequence[Sequence]]]) -> DataFrame:
    """Add per-text results with an Arrow-batched function; no shuffle.

    ``make()`` runs once per task and returns a function from a list of
    texts to one list per field of ``fields`` (a DDL string). The result has
    a struct column ``row`` with the carried columns, untouched, and the
    fields. Fields never clash with carried columns as those are nested.
    """
    schema = _parse_datatype_string(fields)
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    names = ["row", *schema.names]
    source = df.select(F.struct(*[df[c] for c in carry]).alias("row"), text.cast("string").alias("text"))
    out = StructType([source.schema["row"], *schema.fields])

    def run(batches):
        fn = make()
        for batch in batches:
            rows, texts = batch.column(0), batch.column(1)
            for start, n in slices(texts):
                cols = fn(texts.slice(start, n).to_pylist())
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, t)
                          for c, t in zip(cols, types, strict=True)]
                yield pa.RecordBatch.from_arrays([rows.slice(start, n), *arrays], names=names)

    return source.mapInArrow(run, out)


def ranked(df: DataFrame, keys: Sequence[Column], rank: str, name: str) -> DataFrame:
    """``df`` with its 0-based rank in the order of ``keys``, as a long.

    Range partitioning by the keys and a running row number as the last
    key, so that any number of equal rows still spreads over all tasks; a
    sort in each partition; then each partition's offset, one row per
    partition, is added. Nothing is gathered in one task. The sorted rows
    are written to the shared folder first, as ranks must not change when a
    task is run again. Rows equal in all keys are ranked in any order.
    """
    spread = df.withColumn("_salt", F.monotonically_increasing_id())
    order = [*keys, F.col("_salt")]
    run = stored(spread.repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt")
                 .withColumn("_at", F.monotonically_increasing_id())
                 .withColumn("_part", F.shiftright("_at", 33))
                 .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))), name)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (run.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    # Broadcast: one row per shuffle partition, a count that the session's settings bound.
    return (run.join(F.broadcast(offsets), "_part")
            .withColumn(rank, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before"))
