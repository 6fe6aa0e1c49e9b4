import random
import re

import numpy as np
import xxhash

from credit_spark.llm import components, line_dedup, simhash

from .helpers import DOCS, awkward, empty, rows


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, limit=3):
    """Least reachable index of each fingerprint."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= limit:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [root(a) for a in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_equals_bit_counts():
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 4, 7, 50, 400):
        text = " ".join("".join(rng.choice("abÄ.É") for _ in range(rng.randint(1, 4))) for _ in range(n))
        assert simhash.fingerprint(text) == brute_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(500))
    want = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "COUNTED", 7)
    assert simhash.fingerprint(text) == want


def _near_prints(seed, n):
    """Random fingerprints and chains and clouds of near ones."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice((1, 1, 2, 5, 30))):
            out.append(x)
            for _ in range(rng.choice((0, 1, 2, 3, 4))):
                x ^= 1 << rng.randrange(64)
    return sorted(set(out[:n]))


def test_links_join_all_within_the_limit(spark):
    for bucket_rows in (4096, 3):   # 3: nearly every bucket is split into parts
        prints = _near_prints(bucket_rows, 500)
        want = brute_groups(prints)
        table = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
        label = {r.node: r.label for r in components.components(
            simhash.links(table, bucket_rows=bucket_rows)).collect()}
        groups = {}
        for x, w in zip(prints, want):
            groups.setdefault(w, set()).add(label.get(signed(x), signed(x)))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_link_task_over_small_batches(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BATCH_ROWS", 1)
    prints = np.array(_near_prints(9, 300), dtype=np.uint64)
    import pyarrow as pa
    key = np.sort(np.random.default_rng(1).integers(0, 5, len(prints)))
    first = np.bitwise_count(prints ^ np.uint64(simhash.pivots()[0]))
    order = np.lexsort((first, key))
    key, fp = key[order], prints[order]
    zero = np.zeros(len(fp), dtype=np.int32)
    batches = [pa.RecordBatch.from_arrays([pa.array(key[i:i + 9]), pa.array(zero[i:i + 9]), pa.array(zero[i:i + 9]),
                                           pa.array(fp[i:i + 9].view(np.int64))], names=["key", "p", "q", "fp"])
               for i in range(0, len(fp), 9)]
    got = [(h, lo) for b in simhash._link_task(3, simhash.pivots())(iter(batches)) for h, lo in
           zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    parent = {signed(int(x)): signed(int(x)) for x in fp}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for h, lo in got:
        assert ((h ^ lo) & (2**64 - 1)).bit_count() <= 64
        parent[root(h)] = root(lo)
    for i in range(len(fp)):
        for j in range(i):
            if key[i] == key[j] and int(fp[i] ^ fp[j]).bit_count() <= 3:
                assert root(signed(int(fp[i]))) == root(signed(int(fp[j])))


def test_components_of_a_long_chain(spark):
    n = 300
    order = random.Random(4).sample(range(n), n)
    links = [(max(a, b), min(a, b)) for a, b in zip(order, order[1:])] + [(1001, 1000)] * 2
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "high long, low long")).collect()}
    assert got == {**{i: 0 for i in range(1, n)}, 1001: 1000}
    assert components.components(spark.createDataFrame([], "high long, low long")).count() == 0


def test_near_duplicates_on_awkward_rows(spark):
    docs = awkward(spark)
    out = simhash.near_duplicates(docs)
    got = rows(out, "doc_id", "component_id")
    assert (1, 1) in got and got.count((2, 1)) == 2 and {(3, 3), (4, 3), (5, 3)} <= set(got)
    assert len(got) == docs.count() and (None, None) in got
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == sorted([(1,), (3,), (6,), (7,), (None,)], key=repr)
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_first(empty(spark)).count() == 0


def brute_lines(texts, min_docs, min_chars=1):
    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    key = lambda s: lower(s).strip(" \t\n\x0b\x0c\r")
    split = [(t or "").split("\n") for t in texts]
    count = {}
    for lines in split:
        for k in {key(x) for x in lines}:
            count[k] = count.get(k, 0) + 1
    bad = {k for k, n in count.items() if n >= min_docs and len(k) >= min_chars}
    return [(len(s), sum(key(x) in bad for x in s), "\n".join(x for x in s if key(x) not in bad)) for s in split]


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(8)
    pool = ["Shared line", " shared LINE\t", "ß Straße", "STRASSE", "Äpfel", "äpfel", "", "  ", "\x0bx\r", "unique"]
    texts = ["\n".join(rng.choice(pool) + ("" if rng.random() < .7 else str(i)) for _ in range(rng.randint(1, 9)))
             for i in range(60)] + [None, "", "\n", "a\n\n"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    for min_docs in (2, 10, 30):
        out = line_dedup.drop_shared_lines(docs, min_docs=min_docs)
        got = {r.row.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in out.collect()}
        assert [got[i] for i in range(len(texts))] == brute_lines(texts, min_docs)


def test_line_dedup_on_awkward_rows(spark):
    docs = awkward(spark)
    out = line_dedup.clean(docs)
    assert out.columns == docs.columns and rows(out, "doc_id", "text") == rows(docs, "doc_id", "text")
    many = spark.createDataFrame([(i, "License\nown " + str(i), "en", "s", 99) for i in range(10)]
                                 + [(None, None, None, None, None)], DOCS)
    got = rows(line_dedup.clean(many), "doc_id", "text", "n_chars")
    assert (3, "own 3", 5) in got and (None, None, None) in got and len(got) == 11
    assert line_dedup.drop_shared_lines(empty(spark)).count() == 0
