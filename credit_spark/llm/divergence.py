"""Source divergence audit: how far each source's word use lies from its language's.

Texts become partial counts by Arrow's own functions inside ``mapInArrow``
(``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode``, hash
``group_by``); no Python object is made for a word. One shuffle by
(language, term) merges the partial counts; every term is then one row with
the counts of its sources. Shards of such rows become count matrices, whose
divergences are added up. All arithmetic is on integers and exact.

A share is p = 1 + floor(SCALE (count + 2) / (N + 2 V)): N is the sum of a
group's counts over the V kept terms of its language. The divergence of two
shares is floor((p - q)^2 / (p + q)).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
SMOOTH = 2
# SCALE = _A * _B: counts up to 2^63 / _A keep every product in 64 bits.
_A, _B = 31_250, 32_000

# All ASCII but letters parts the terms.
BREAK = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

# Distinct rows that a task merges before it hands them on: bounds its memory.
HELD_ROWS = 400_000
# Cells of one count matrix.
CELLS = 1 << 20

_PARTIAL = "lang string, source string, term string, n long, n_docs long"
_KEYS = ["lang", "source", "term"]


def _count(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Occurrences and documents of every (lang, source, term) of some texts."""
    words = pc.split_pattern_regex(pc.ascii_lower(text), pattern=BREAK)
    doc, term = pc.list_parent_indices(words), pc.list_flatten(words)
    real = pc.greater(pc.binary_length(term), 0)
    term = term.filter(real).dictionary_encode()
    doc = doc.filter(real)
    by_doc = (pa.table({"doc": doc, "term": term.indices}).group_by(["doc", "term"], use_threads=False)
              .aggregate([([], "count_all")]))
    lang, source = lang.dictionary_encode(), source.dictionary_encode()
    at = by_doc["doc"].combine_chunks()
    by_term = (pa.table({"lang": lang.indices.take(at), "source": source.indices.take(at),
                         "term": by_doc["term"], "n": by_doc["count_all"]})
               .group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("n", "count")]))
    return pa.table({
        "lang": lang.dictionary.take(by_term["lang"].combine_chunks()),
        "source": source.dictionary.take(by_term["source"].combine_chunks()),
        "term": term.dictionary.take(by_term["term"].combine_chunks()),
        "n": by_term["n_sum"].combine_chunks(), "n_docs": by_term["n_count"].combine_chunks()})


def _merge(parts: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(parts).group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("n_docs", "sum")])
    return out.rename_columns([*_KEYS, "n", "n_docs"])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n_held = [], 0
    for batch in batches:
        for start, n in slices(batch.column(2)):
            part = _count(*(c.slice(start, n) for c in batch.columns))
            held.append(part)
            n_held += part.num_rows
            if n_held > HELD_ROWS:
                held = [_merge(held)]
                n_held = held[0].num_rows
                if n_held > HELD_ROWS // 2:
                    yield from held[0].combine_chunks().to_batches()
                    held, n_held = [], 0
    if n_held:
        yield from _merge(held).combine_chunks().to_batches()


def _share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE count / total), exact for count <= total in 64 bits."""
    q = F.expr  # integer division has no function of its own
    names = {"c": f"({_A}L * ({count}))", "t": f"({total})", "b": f"{_B}L"}
    return q("1L + ({c} div {t}) * {b} + (({c} % {t}) * {b}) div {t}".format(**names))


def _shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    q, r = np.divmod(count * _A, total)
    return 1 + q * _B + r * _B // total


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                min_docs: int = MIN_DOCS) -> DataFrame:
    """Kept terms: ``lang``, ``term``, ``uses`` (array of source and n) and ``n`` of all sources.

    Written to the shared folder. A term's row holds its sources, never its
    documents: those are counted before the shuffle.
    """
    side = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    partial = docs.select(side(lang).alias("lang"), side(source).alias("source"), side(text).alias("text")) \
        .mapInArrow(_partial, _PARTIAL)
    # One exchange: both groupings are within a (lang, term).
    merged = (partial.repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
              .groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("uses"),
                                           F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")))
    return stored(merged.where(F.col("n_docs") >= min_docs).drop("n_docs"), "terms")


def totals(docs: DataFrame, terms: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``base`` (N + 2 V), ``lang_base`` and ``n_terms`` (V) of every occurring group."""
    side = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    groups = docs.select(side(lang).alias("lang"), side(source).alias("source")).distinct()
    own = (terms.select("lang", F.explode("uses").alias("u")).groupBy("lang", F.col("u.source").alias("source"))
           .agg(F.sum("u.n").alias("own")))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("all"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return (groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
            .select("lang", "source", (zero("own") + SMOOTH * zero("n_terms")).alias("base"),
                    (zero("all") + SMOOTH * zero("n_terms")).alias("lang_base"),
                    zero("n_terms").alias("n_terms")))


def _pair_sums(groups: list[tuple]):
    """A function that adds up the divergences of all pairs of a language's sources over a shard."""
    sources: dict[str, list] = {}
    for lang, source, base in sorted(groups):
        sources.setdefault(lang, []).append((source, base))
    names = {k: pa.array([s for s, _ in v], pa.string()) for k, v in sources.items()}
    bases = {k: np.array([b for _, b in v], dtype=np.int64) for k, v in sources.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            uses = batch.column(1)
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                rows = np.flatnonzero(langs.indices.to_numpy(zero_copy_only=False) == code)
                k = len(names[lang])
                acc = sums.setdefault(lang, np.zeros((k, k), dtype=np.int64))
                step = max(1, CELLS // k)
                for at in range(0, len(rows), step):
                    some = uses.take(pa.array(rows[at:at + step]))
                    flat = pc.list_flatten(some)
                    count = np.zeros((len(some), k), dtype=np.int64)
                    row = pc.list_parent_indices(some).to_numpy(zero_copy_only=False)
                    col = pc.index_in(flat.field(0), names[lang]).to_numpy(zero_copy_only=False)
                    count[row, col] = flat.field(1).to_numpy(zero_copy_only=False)
                    p = _shares(count + SMOOTH, bases[lang]).T.copy()
                    for i in range(k - 1):
                        d = p[i + 1:] - p[i]
                        acc[i, i + 1:] += (d * d // (p[i + 1:] + p[i])).sum(axis=1)
        for lang, acc in sums.items():
            for i in range(len(acc) - 1):
                n = len(acc) - 1 - i
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array([names[lang][i].as_py()] * n, pa.string()),
                     names[lang].slice(i + 1), pa.array(acc[i, i + 1:])], names=["lang", "a", "b", "value"])
    return run


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Columns ``lang``, ``source``, ``part``, ``item``, ``value`` (long) and ``rank``.

    Part ``pair``: every other source of the language, by divergence over
    all kept terms. Part ``term``: the ``top_terms`` terms that the source
    uses more than its language does. Ranks run from 1, by falling value,
    then by item in UTF-8 order.

    - null text, language or source: the empty text
    - a document is a row: repeated rows count each
    - a group without terms, or a language without kept terms, still has its
      pairs (of value 0 if no term is kept); a language of one source has none
    - ties in value are broken by the item, so ranks never tie
    - empty table: no rows; other columns, whatever their names, are ignored
    - a source or a language that holds most rows: counted before the
      shuffle; a term's row has at most one entry for each source

    The groups' totals go to every task. The result has a row for each pair
    of a language's sources, so they are at most about the square root of
    its rows.
    """
    terms = term_counts(docs, text, lang, source, min_docs)
    groups = stored(totals(docs, terms, lang, source), "groups")

    facts = groups.select("lang", "source", "base").where(F.col("n_terms") > 0).collect()
    sums = (terms.select("lang", "uses")
            .mapInArrow(_pair_sums([tuple(r) for r in facts]), "lang string, a string, b string, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p")
    sums = sums.select("lang", both, "value").select("lang", "p.source", "p.item", "value")
    keys = groups.select("lang", "source")
    pairs = (keys.join(keys.select("lang", F.col("source").alias("item")), "lang")
             .where(F.col("source") != F.col("item"))
             .join(sums, ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.coalesce("value", F.lit(0).cast("long")).alias("value")))

    used = (terms.select("lang", "term", F.col("n").alias("lang_n"), F.explode("uses").alias("u"))
            .select("lang", "u.source", "term", "lang_n", "u.n").join(groups, ["lang", "source"]))
    shares = used.select("lang", "source", "term", _share(f"n + {SMOOTH}L", "base").alias("p"),
                         _share(f"lang_n + {SMOOTH}L", "lang_base").alias("q")).where(F.col("p") > F.col("q"))
    most = shares.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                         F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    # Spark keeps each task's first rows of a group before it shuffles them.
    return pairs.select("*", rank).unionByName(most.select("*", rank).where(F.col("rank") <= top_terms))
