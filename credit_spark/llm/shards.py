"""Sharding by a Hilbert curve over metadata dimensions.

Several metadata columns are quantised to a grid; the cells are ordered
along a Hilbert curve, so that neighbours on the curve are neighbours in
every dimension; the ordered documents are cut into runs. Each shard then
covers a small box of the metadata space, and a reader that filters on any
of the dimensions can skip most files by their minima and maxima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, stored

BITS = 5


def _rotate(x: int, by: int, n: int) -> int:
    by %= n
    return ((x << by) | (x >> (n - by))) & ((1 << n) - 1)


def curve_table(n: int) -> list[int]:
    """The n-dimensional Hilbert curve as an automaton.

    A state is a corner where the curve enters a cell and a direction. The
    entry at state * 2**n + (one bit of each coordinate) is the next state
    times 2**n, plus the n bits of the curve index.
    """
    size = 1 << n

    def ungray(g: int) -> int:
        w = 0
        while g:
            w ^= g
            g >>= 1
        return w

    def enter(w: int) -> int:
        return 0 if w == 0 else (lambda v: v ^ (v >> 1))(2 * ((w - 1) // 2))

    def along(w: int) -> int:
        trailing = lambda v: (~v & (v + 1)).bit_length() - 1  # noqa: E731  ones at the end
        return 0 if w == 0 else (trailing(w - 1) if w % 2 == 0 else trailing(w)) % n

    out = []
    for state in range(size * n):
        corner, direction = divmod(state, n)
        for cell in range(size):
            w = ungray(_rotate(cell ^ corner, n - (direction + 1) % n, n))
            after = corner ^ _rotate(enter(w), direction + 1, n)
            out.append((after * n + (direction + along(w) + 1) % n) * size + w)
    return out


def with_curve_index(df: DataFrame, cells: list[str], bits: int, name: str) -> DataFrame:
    """Add the Hilbert index of the grid cell in columns ``cells`` (0 to 2**bits - 1)."""
    n = len(cells)
    steps = F.array(*[F.lit(x) for x in curve_table(n)])
    out = df.withColumn(name, F.lit(0).cast("long")).withColumn("_state", F.lit(0))
    for b in reversed(range(bits)):
        corner = sum(((F.shiftright(F.col(c), b).bitwiseAND(F.lit(1))) * (1 << k) for k, c in enumerate(cells)),
                     F.lit(0))
        out = (out.withColumn("_step", F.get(steps, (F.col("_state") * (1 << n) + corner).cast("int")))
               .withColumn(name, F.col(name) * (1 << n) + F.col("_step").bitwiseAND(F.lit((1 << n) - 1)))
               .withColumn("_state", F.shiftright("_step", n)))
    return out.drop("_state", "_step")


def string_steps(df: DataFrame, names: list[str], bits: int) -> dict[str, list[tuple[int, str]]]:
    """For each string column: the steps that its values take, and each step's least value.

    Whole values are ordered by their UTF-8 bytes, null first. A column of
    2**bits distinct values at most gives each a step of its own; else a
    value's step is that of the rows before it: 2**bits quantiles. All
    columns are counted in one shuffle; running counts come from range
    partitions and one offset each. Steps grow with the values, so their
    least values (2**bits a column at most) are all that reaches the driver.
    """
    if not names:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("dim"), F.col(n).cast("string").alias("value"))
                                for k, n in enumerate(names)])).alias("p")
    counts = stored(df.select(pairs).groupBy("p.dim", "p.value").agg(F.count(F.lit(1)).alias("n"))
                    .repartitionByRange("dim", "value").withColumn("part", F.spark_partition_id()), "string-values")
    # One row for each column and shuffle partition.
    before = Window.partitionBy("dim").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("dim", "part").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"))
    offsets = parts.select(
        "dim", "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("rows", "values")],
        *[F.sum(c).over(Window.partitionBy("dim")).alias(f"all_{c}") for c in ("rows", "values")])
    inside = Window.partitionBy("dim", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    size = F.lit(1 << bits).cast("decimal(20,0)")
    at_row = F.col("rows_before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    at_value = F.col("values_before") + F.count(F.lit(1)).over(inside)
    step = F.when(F.col("all_values") <= (1 << bits), F.floor(at_value * size / F.col("all_values"))).otherwise(
        F.floor(at_row * size / F.col("all_rows")))
    least = (counts.join(F.broadcast(offsets), ["dim", "part"]).select("dim", "value", step.cast("int").alias("step"))
             .groupBy("dim", "step").agg(F.min("value").alias("value")).where("value IS NOT NULL").collect())
    return {n: sorted((r.step, r.value) for r in least if r.dim == k) for k, n in enumerate(names)}


def string_step(value: Column, steps: list[tuple[int, str]]) -> Column:
    """The step of a string: that of the greatest least value up to it. Null: 0."""
    out = None
    for step, least in reversed(steps):
        out = F.when(value >= F.lit(least), step) if out is None else out.when(value >= F.lit(least), step)
    return F.lit(0) if out is None else out.otherwise(0)


def size_position(value: Column) -> Column:
    """A count on a logarithmic scale: twice its bit length, and the second bit."""
    bits = F.bin(F.greatest(value.cast("long"), F.lit(0).cast("long")))
    return (2 * F.length(bits) + F.when(F.substring(bits, 2, 1) == "1", 1).otherwise(0)).cast("long")


def quantised(df: DataFrame, strings: list[str], counts: list[str], bits: int = BITS) -> DataFrame:
    """Add columns ``_q0``, ... : each dimension in 2**bits steps, the string columns first.

    Strings take the steps of ``string_steps``; counts equal steps from the
    least to the largest ``size_position``, whose bounds come from one
    aggregate over all rows. A null takes step 0.
    """
    names = string_steps(df, strings, bits)
    steps = {f"_q{k}": string_step(F.col(n).cast("string"), names[n]) for k, n in enumerate(strings)}
    sized = {f"_q{k}": size_position(F.col(n)) for k, n in enumerate(counts, len(strings))}
    bounds = df.agg(F.lit(0), *[f(v).alias(f"{n}{q}") for q, v in sized.items()
                                for n, f in (("lo", F.min), ("hi", F.max))]).first()
    for q, v in sized.items():
        lo, hi = bounds[f"lo{q}"] or 0, bounds[f"hi{q}"] or 0
        scaled = F.floor((v - lo).cast("decimal(20,0)") * (1 << bits) / (hi - lo + 1))
        # Kept in range also where a source gives other rows when it is read again.
        inside = F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), scaled))
        steps[q] = F.when(v.isNull(), 0).otherwise(inside.cast("int"))
    return df.withColumns(steps)


def _placed(docs: DataFrame, shards: int, carry: list[str], id_col: str = "doc_id", text_col: str = "text",
            strings: tuple[str, ...] = ("lang", "source"), counts: tuple[str, ...] = ("n_chars",),
            bits: int = BITS) -> DataFrame:
    """Every row with its shard and slot, and the carried columns, if any, in the struct ``row``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = [f"d{k}" for k in range(len(strings) + len(counts))]
    slim = docs.select(
        F.col(id_col).alias("id"), *[F.col(c).alias(d) for d, c in zip(names, (*strings, *counts), strict=True)],
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        *([F.struct(*carry).alias("row")] if carry else []))
    cells = [f"_q{k}" for k in range(len(names))]
    # The steps come from the metadata columns alone: the texts aren't read for them.
    stepped = quantised(slim, names[:len(strings)], names[len(strings):], bits)
    curved = with_curve_index(stepped, cells, bits, "curve_index").drop(*cells)
    order = [F.col("curve_index"), *[F.col(n) for n in names], F.col("id"), F.col("text_crc32")]
    placed = ranked(curved, order, "rank", "curve-order")
    total = placed.count()
    shard = F.floor(F.col("rank") * shards / F.lit(max(total, 1)).cast("decimal(20,0)")).cast("int")
    start = F.ceil(F.col("shard") * F.lit(total).cast("decimal(20,0)") / shards).cast("long")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("rank") - start)


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Shard and slot of every document, for shards whose row counts differ by one at most.

    Result: ``id_col``, ``size`` (UTF-8 bytes of the text plus 1),
    ``text_crc32``, ``curve_index``, ``shard`` (0 to shards - 1) and
    ``slot`` (0-based in the shard). Order: curve index, the dimensions,
    id, checksum. ``options``: ``strings`` and ``counts``, the metadata
    columns that are the dimensions, and ``bits`` of the grid.

    - null text: no bytes, as the empty text; null metadata: step 0
    - hot values: a value is one row of the counts, and its rows spread over
      the shards by the other dimensions, then by id
    - null ids, ties and repeated rows: a row each, ranked in any order
    - fewer rows than shards: some shards stay empty; empty table: no rows
    - equal texts may lie in different shards, as their metadata say
    """
    return _placed(docs, shards, [], id_col, text_col, **options).select(
        F.col("id").alias(id_col), "size", "text_crc32", "curve_index", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> None:
    """Write the documents as Parquet, a folder ``shard=k`` each, rows in curve order.

    All columns go through the one range sort, so every row finds its shard
    without a join: null ids and repeated rows are written as often as they
    come. A task's rows are a run of the curve, so they lie in one shard or
    in neighbouring ones, and a shard has as many files as runs.

    - a column ``shard`` of the input is kept; the folders then are
      ``shard_=k``, with one more underscore for each such name taken
    - empty table: no files of rows
    """
    taken = {c.lower() for c in docs.columns}
    folder = "shard"
    while folder in taken:
        folder += "_"
    placed = _placed(docs, shards, docs.columns, id_col, text_col, **options)
    (placed.sortWithinPartitions("shard", "slot").select("row.*", F.col("shard").alias(folder))
     .write.partitionBy(folder).parquet(path))
