"""Operators that look at the whole table: substring dedup, whitening, source divergence."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from credit_spark.llm import divergence, phrases, queries, whitening
from credit_spark.llm.common import table

from .helpers import LONG, awkward, empty, rows

SMALL = "/root/testdata/sf0.001"


# --- substring dedup ----------------------------------------------------------

def brute_repeats(docs, window):
    """(id, words, removed, sha) of (id, text) rows, by a dictionary of all windows."""
    split = [(i, re.findall("[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    least = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and least.get(tuple(w[k:k + window]), i) < i:
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def passage_docs(seed, n, window):
    """Texts that share passages around the window's length, nested, adjacent and edited."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "é", "the", "x y", "Z"]) + str(rng.randint(0, 9) ** 2)
    some = lambda k: [word() for _ in range(k)]
    shared = [some(rng.choice((window - 1, window, window + 1, 2 * window, 5 * window))) for _ in range(6)]
    out = []
    for i in range(n):
        text = some(rng.randint(0, window))
        for _ in range(rng.randint(0, 4)):
            p = list(rng.choice(shared))
            if p and rng.random() < 0.3:
                p[rng.randrange(len(p))] = "edit"
            if p and rng.random() < 0.3:
                p = p[rng.randrange(len(p)):]
            text += p + some(rng.choice((0, 0, 3)))
        out.append((rng.randint(0, 2 * n), rng.choice((" ", "\n", " \t")).join(text)))
    return out + [out[0], (None, out[1][1]), (n, None), (n + 1, ""), (n + 2, " \x0b "), (-5, out[3][1])]


@pytest.mark.parametrize("seed,window,shard_words", [(1, 6, 500_000), (2, 6, 40), (4, 2, 300), (5, 1, 300)])
def test_repeats_equal_brute_force(spark, seed, window, shard_words):
    docs = passage_docs(seed, 60, window)
    # Of repeated ids with other texts, as of any rows, only the id counts.
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = phrases.find_repeats(df, window=window, shard_words=shard_words)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_repeats(docs, window)
    for r in got.collect():
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_repeats_of_the_small_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    got = rows(queries.op11_substring_dedup(spark, SMALL), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute_repeats(docs, 50)
    assert any(r[2] for r in got)


def test_repeats_of_awkward_rows(spark):
    df = awkward(spark)
    want = brute_repeats([(r.doc_id, r.text) for r in df.collect()], 5)
    assert rows(phrases.find_repeats(df, window=5), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert phrases.find_repeats(empty(spark)).count() == 0


def test_repeats_of_long_texts(spark):
    other = LONG.replace("end", "other " + "tail " * 60)
    docs = [(1, LONG), (2, other), (3, LONG)]
    got = phrases.find_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    want = {1: (30_001, 0), 2: (30_061, 30_000), 3: (30_001, 30_001)}
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got.collect()} == want


def test_a_shard_tells_windows_of_equal_hash_apart(monkeypatch):
    monkeypatch.setattr(phrases, "rolling", lambda h, size, which=0: np.zeros(max(0, len(h) - size + 1), dtype=np.uint64))
    shard = phrases.Shard([(1, b"a b c d e"), (5, b"b c d x y")], 3, 1)
    assert shard.covered(4, b"x a b c y b c x y".split()).tolist() == [False] + [True] * 3 + [False] * 5
    assert shard.covered(6, b"c d x y".split()).tolist() == [True] * 4
    assert not shard.covered(1, b"a b c".split()).any()


# --- whitening ----------------------------------------------------------------

def brute_whitened(vectors, k):
    x = np.floor(256 * np.array(vectors, dtype=float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    z = (fit * n - s) / n
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    d = x * n - s
    return n, (d * d).sum(axis=1), d / n @ u / np.sqrt(e), e / np.trace(v)


def test_whitened_equals_a_dense_solver(spark):
    want_ids = sorted((r.vec_id, r.embedding) for r in table(spark, SMALL, "embeddings").collect() if r.embedding)
    n, dev, white, explained = brute_whitened([v for _, v in want_ids], 4)
    got = {}
    for r in queries.op12_embedding_whitening(spark, SMALL).collect():
        got[r.vec_id, r.component] = r
    assert len(got) == 4 * len(want_ids)
    for c in range(4):
        mine = np.array([got[i, c + 1].whitened for i, _ in want_ids])
        sign = np.sign(mine @ white[:, c])
        assert np.abs(mine * sign - white[:, c]).max() < 1e-9
    for k, (i, _) in enumerate(want_ids):
        r = got[i, 1]
        assert (r.n, r.deviation) == (n, dev[k]) and abs(r.explained - explained[0]) < 1e-12
        assert r.identity_error < 1e-9


@pytest.mark.parametrize("name,matrix", [
    ("random", (lambda a: a.T @ a)(np.random.default_rng(0).standard_normal((90, 40)))),
    ("ties", np.diag([5.0] * 3 + [2.0] * 20 + [1.0] * 5)),
    ("flat", np.eye(12)),
    ("two directions", (lambda a: a.T @ a)(np.random.default_rng(1).standard_normal((2, 30)))),
    ("close", np.diag(np.r_[[1.0, 1 - 1e-12, 1 - 2e-12], np.linspace(0.5, 0.4, 20)])),
    ("steep", np.diag(10.0 ** -np.arange(0, 14.0))),
    ("tiny", 1e-30 * np.diag([3.0, 2.0, 1.0])), ("one", np.array([[3.0]]))])
@pytest.mark.parametrize("k", [1, 4, 40])
def test_feast_finds_all_components(name, matrix, k):
    want = np.linalg.eigvalsh(matrix)[::-1]
    rank = (want > len(want) * np.finfo(float).eps * np.abs(matrix).sum(axis=1).max()).sum()
    values, vectors = [], []
    for low, high, count in whitening.intervals(matrix, k):
        e, u = whitening.feast(matrix, low, high, count)
        values += list(e[::-1])
        vectors.append(u[:, ::-1])
    assert len(values) >= min(k, rank)
    u = np.hstack(vectors)
    assert np.abs(np.array(values) - want[:len(values)]).max() < 1e-13 * want[0]
    assert np.abs(u.T @ u - np.eye(len(values))).max() < 1e-11


def test_inertia_counts():
    a = np.random.default_rng(2).standard_normal((25, 25))
    a = a + a.T
    diag, off = whitening.tridiagonal(a)
    e = np.linalg.eigvalsh(a)
    for shift in np.linspace(e[0] - 1, e[-1] + 1, 40):
        assert whitening.count_above(diag, off, shift) == (e > shift).sum()


def test_whitened_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    vecs = [(1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (2, [-1.0, 0.0, 3.0]), (None, [0.25, -7.0, 1.0]), (3, None),
            (4, []), (5, [1.0, None, 1.0]), (6, [inf, 1.0, 1.0]), (7, [nan, 1.0, 1.0]), (8, [1e300, 1.0, 1.0]),
            (9, [1.0, 2.0]), (10, [0.0, -0.0, 0.001])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("mine") for c in ("row", "x", "whitened", "deviation", "n")})
    out, model, error = whitening.whiten(df)
    used = [(i, v) for i, v in vecs if i in (1, 2, 10) or i is None]
    n, dev, white, _ = brute_whitened([v for _, v in used], 3)
    assert (model.n, len(model.values)) == (n, 3) and error < 1e-9
    got = rows(out, "row", "deviation")
    assert sorted((r[0].vec_id, r[1]) for r in got if r[0].vec_id is not None) == sorted(
        (i, int(d)) for (i, _), d in zip(used, dev) if i is not None)
    assert out.columns == ["row", "deviation", "whitened"] and len(got) == len(used)


def test_whitened_without_variance(spark):
    for vecs in ([], [(1, None)], [(1, [])]):
        df = spark.createDataFrame(vecs, "vec_id long, embedding array<float>")
        assert whitening.whiten(df)[0].count() == 0
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    out, model, _ = whitening.whiten(df)
    assert [(r.deviation, r.whitened) for r in out.collect()] == [(0, [])] * 2 and model.n == 1


def test_deviation_is_exact_past_64_bits(spark):
    vecs = [(1, [float(1 << 50)]), (2, [0.0]), (3, [1.0])]
    out, model, _ = whitening.whiten(spark.createDataFrame(vecs, "vec_id long, embedding array<double>"))
    total = (1 << 58) + 256
    assert model.sums == [total]
    want = {1: (3 * (1 << 58) - total) ** 2, 2: total ** 2, 3: (3 * 256 - total) ** 2}
    assert {r.row.vec_id: r.deviation for r in out.collect()} == {
        i: v if v < 1 << 63 else None for i, v in want.items()}


# --- source divergence --------------------------------------------------------

def brute_audit(docs, min_docs, top):
    """Rows of (text, lang, source) documents, with Python integers."""
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    split = [(g or "", s or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t))) for t, g, s in docs]
    out = []
    for lang in {g for g, _, _ in split}:
        mine = [(s, w) for g, s, w in split if g == lang]
        held = Counter(t for _, w in mine for t in set(w))
        kept = {t for t, n in held.items() if n >= min_docs}
        counts = defaultdict(Counter)
        for s, w in mine:
            counts[s].update(t for t in w if t in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + 10 ** 9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in counts:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            term = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, o, v, r + 1) for r, (v, o) in enumerate(items)
                        if part == "pair" or r < top]
    return sorted(out, key=repr)


AUDIT = ("lang", "source", "part", "item", "value", "rank")


def audit_docs(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "cat", "é", "É", "Σ", "x-y", "a1b", "don't", "🙂", "zz", "I", "\x00q", "ſ"]
    texts = [rng.choice(("", " ", "\n", ", ")).join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(n)]
    return [(t if rng.random() > 0.05 else None, rng.choice(("en", "en", "fr", None, "de")),
             rng.choice(("a", "b", "c", "", None, "é"))) for t in texts]


def test_audit_equals_brute_force(spark, monkeypatch):
    for seed, n, min_docs, top in ((1, 300, 10, 10), (2, 60, 2, 3), (3, 40, 1, 2), (4, 40, 1000, 10)):
        docs = audit_docs(seed, n)
        df = spark.createDataFrame(docs, "text string, lang string, source string").repartition(4)
        got = divergence.audit(df, min_docs=min_docs, top_terms=top)
        assert rows(got, *AUDIT) == brute_audit(docs, min_docs, top)


def test_partial_counts_are_handed_on_in_parts(spark, monkeypatch):
    import pyarrow as pa
    docs = audit_docs(5, 200)
    cols = [[d[1] or "" for d in docs], [d[2] or "" for d in docs], [d[0] or "" for d in docs]]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["lang", "source", "text"])
    monkeypatch.setattr(divergence, "HELD_ROWS", 20)
    monkeypatch.setattr("credit_spark.llm.common.SLICE_BYTES", 200)
    total, parts = Counter(), 0
    for part in divergence._partial(iter([batch.slice(k, 7) for k in range(0, 200, 7)])):
        parts += 1
        for r in part.to_pylist():
            total[r["lang"], r["source"], r["term"], "n"] += r["n"]
            total[r["lang"], r["source"], r["term"], "docs"] += r["n_docs"]
    want = Counter()
    for lang, source, text in zip(*cols):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        found = Counter(re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
        for t, n in found.items():
            want[lang, source, t, "n"] += n
            want[lang, source, t, "docs"] += 1
    assert total == want and parts > 3


def test_shares_are_exact_for_large_counts(spark):
    rng = random.Random(3)
    cases = [(rng.randrange(1, t + 1), t) for t in (rng.randrange(1, 1 << rng.randint(2, 47)) for _ in range(300))]
    got = divergence._shares(np.array([c for c, _ in cases]), np.array([t for _, t in cases]))
    assert got.tolist() == [1 + 10 ** 9 * c // t for c, t in cases]
    df = spark.createDataFrame(cases, "c long, t long").select(divergence._share("c", "t").alias("p"))
    assert [r.p for r in df.collect()] == got.tolist()


def test_audit_of_awkward_rows(spark):
    df = awkward(spark)
    for c in ("term", "n", "uses", "item", "value", "part"):
        df = df.withColumn(c, F.lit("mine"))
    docs = [(r.text, r.lang, r.source) for r in df.collect()]
    assert rows(divergence.audit(df, min_docs=1), *AUDIT) == brute_audit(docs, 1, 10)
    assert divergence.audit(empty(spark)).count() == 0
