import random
import zlib
from itertools import product

from credit_spark.llm import chat, quality, shards
from pyspark.sql import functions as F

from .helpers import DOCS, awkward, empty, rows


def python_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [w for w in ("Python", "Arrow", "Pandas") if w in plan]


# -- shards ----------------------------------------------------------------------

def test_curve_visits_neighbouring_cells(spark):
    for dims, bits in ((2, 3), (3, 2)):
        cells = spark.createDataFrame(list(product(range(1 << bits), repeat=dims)), [f"c{k}" for k in range(dims)])
        out = shards.with_curve_index(cells, cells.columns, bits, "h").orderBy("h").collect()
        assert [r.h for r in out] == list(range(1 << bits * dims))
        for a, b in zip(out, out[1:]):
            assert sum(abs(a[c] - b[c]) for c in cells.columns) == 1


def test_shards_by_rows(spark):
    docs = awkward(spark)
    out = shards.assign_shards(docs, 4).collect()
    sizes = sorted(sum(r.shard == s for r in out) for s in range(4))
    assert sizes == [2, 2, 2, 3] and len(out) == 9
    for s in range(4):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    by_id = {r.doc_id: r for r in out}
    for r in docs.collect():
        data = (r.text or "").encode()
        assert (by_id[r.doc_id].size, by_id[r.doc_id].text_crc32) == (len(data) + 1, zlib.crc32(data))
    order = [r.curve_index for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    assert shards.assign_shards(empty(spark), 4).count() == 0
    few = shards.assign_shards(docs.limit(2), 16).collect()
    assert len({r.shard for r in few}) == 2 and all(r.slot == 0 for r in few)


def test_equal_rows_spread_over_shards(spark):
    docs = spark.range(1000).selectExpr("cast(null as long) doc_id", "'same' text", "'en' lang", "'s' source",
                                        "4L n_chars")
    out = shards.assign_shards(docs, 16).groupBy("shard").agg({"slot": "max"}).collect()
    assert sorted(r[1] + 1 for r in out) == [62] * 8 + [63] * 8


def test_string_steps_equal_brute_force(spark):
    rng = random.Random(5)
    hot = [rng.choice(["https://a.example/x"] * 300 + [f"https://a.example/{i:03d}" for i in range(90)] + [None, ""])
           for _ in range(3000)]
    few = [rng.choice(["en"] * 30 + ["es", "fr", "de", None]) for _ in hot]
    df = spark.createDataFrame(list(zip(hot, few)), "a string, b string").repartition(7)
    got = df.select("a", "b", *[
        shards.string_step(F.col(c), shards.string_steps(df, ["a", "b"], 4)[c]).alias(f"s_{c}") for c in "ab"]).distinct()
    for name, values in (("a", hot), ("b", few)):
        order = sorted(set(values), key=lambda v: (v is not None, (v or "").encode()))
        want = {}
        for k, v in enumerate(order):
            rank = k * 16 // len(order) if len(order) <= 16 else sum(
                values.count(o) for o in order[:k]) * 16 // len(values)
            want[v] = rank
        assert {r[name]: r[f"s_{name}"] for r in got.collect()} == want
    assert len({r.s_b for r in got.collect()}) == 5
    assert shards.string_steps(df.limit(0), ["a"], 4) == {"a": []} and shards.string_steps(df, [], 4) == {}


def test_shards_hold_few_languages_and_sources(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    steps = shards.string_steps(docs, ["lang", "source"], shards.BITS)
    for c in ("lang", "source"):
        values = docs.select(c).distinct().where(F.col(c).isNotNull()).count()
        assert len(steps[c]) == values        # a step for each
    placed = shards.assign_shards(docs, 16).join(docs.dropDuplicates(["doc_id"]), "doc_id")
    spread = placed.groupBy("shard").agg(F.countDistinct("lang").alias("langs")).agg(F.avg("langs")).first()[0]
    assert spread < docs.select("lang").distinct().count()


def brute_curve(n, bits):
    """Cells of the n-dimensional grid in curve order, by the published coordinate transform."""
    out = []
    for h in range(1 << (n * bits)):
        x = [0] * n
        for k in range(n * bits):
            if h >> (n * bits - 1 - k) & 1:
                x[k % n] |= 1 << (bits - 1 - k // n)
        t = x[n - 1] >> 1
        for i in range(n - 1, 0, -1):
            x[i] ^= x[i - 1]
        x[0] ^= t
        q = 2
        while q != 1 << bits:
            for i in range(n - 1, -1, -1):
                if x[i] & q:
                    x[0] ^= q - 1
                else:
                    t = (x[0] ^ x[i]) & (q - 1)
                    x[0] ^= t
                    x[i] ^= t
            q <<= 1
        out.append(tuple(x))
    return out


def test_curve_has_the_shape_of_another_construction(spark):
    # In two dimensions, constructions differ by the order and direction of the axes only.
    bits = 3
    cells = spark.range(64).select((F.col("id") % 8).cast("int").alias("x"), F.floor(F.col("id") / 8).cast("int").alias("y"))
    got = [(r.x, r.y) for r in shards.with_curve_index(cells, ["x", "y"], bits, "h").orderBy("h").collect()]
    want = brute_curve(2, bits)
    forms = []
    for swap, fx, fy in product((0, 1), repeat=3):
        form = [((7 - a) if fx else a, (7 - b) if fy else b) for a, b in want]
        form = [(b, a) for a, b in form] if swap else form
        forms += [form, form[::-1]]
    assert got in forms


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    shards.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back, "doc_id", "text") == rows(docs, "doc_id", "text")
    placed = {r.doc_id: r.shard for r in shards.assign_shards(docs, 4).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == placed


def test_written_shards_of_awkward_rows(spark, tmp_path):
    docs = awkward(spark)       # null and repeated ids, and a column ``shard`` of its own
    shards.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back, *docs.columns) == rows(docs, *docs.columns)
    sizes = [r["count"] for r in back.groupBy("shard_").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1
    shards.write_shards(empty(spark), str(tmp_path / "none"), 4)
    assert not list((tmp_path / "none").glob("**/*.parquet"))


# -- chat -------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, part string, rank string"


def brute_chat(data, part_turns):
    out = []
    for conv in {r[0] for r in data}:
        said = sorted(((r[1] is None, r[1] or 0, (r[2] or "").strip(" ") or "unknown", r[3] or "")
                       for r in data if r[0] == conv))
        people = sorted({s[2] for s in said} - {"system"}) or [None]
        for me, lo in product(people, range(0, len(said), part_turns)):
            text, masks = "", []
            for *_, who, what in said[lo:lo + part_turns]:
                role = "assistant" if who == me else "system" if who == "system" else f"user name={who}"
                text += f"<|im_start|>{role}\n"
                start = len(text)
                text += f"{what}<|im_end|>\n"
                if who == me:
                    masks.append((start, len(text)))
            out.append((conv, me, lo // part_turns, min(part_turns, len(said) - lo), text, masks))
    return sorted(out, key=repr)


def test_rotation_equals_brute_force(spark):
    data = [(1, 0, "system", "Be kind.", "x", "y"), (1, 1, "ann", "Hi 🙂", "x", "y"), (1, 2, "bob", "Hey", "x", "y"),
            (1, 3, "ann", None, "x", "y"), (1, 3, "ann", "tie", "x", "y"), (1, None, "cy", "late", "x", "y"),
            (2, 0, "system", "alone", "x", "y"), (None, 0, None, "who?", "x", "y"), (None, 0, "  ", "me", "x", "y"),
            (3, 0, "ann", "same", "x", "y"), (3, 0, "ann", "same", "x", "y"), (4, 0, "eve", "w " * 40_000, "x", "y")]
    data += [(9, i, f"p{i % 3}", f"message {i}", "x", "y") for i in range(50)]
    df = spark.createDataFrame(data, TURNS)
    for part_turns in (64, 4):
        out = chat.rotate(df, part_turns=part_turns)
        got = [(r.conv_id, r.perspective, r.part, r.n_turns, r.text, [tuple(m) for m in r.masks]) for r in out.collect()]
        assert sorted(got, key=repr) == brute_chat(data, part_turns)
        assert python_nodes(out) == []
    assert chat.rotate(df.limit(0)).count() == 0


# -- quality ------------------------------------------------------------------------

def brute_signals(text):
    import re
    text = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = {}
    for x in win:
        count[x] = count.get(x, 0) + 1
    covered = {p for i, x in enumerate(win) if count[x] > 1 for p in range(i, i + 3)}
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_signals_equal_brute_force(spark):
    import random
    rng = random.Random(17)
    texts = ["".join(rng.choice(["a ", "b ", "a b c ", "x\n", "\n", "#", "|\t", "é ", " ", "Z! "])
                     for _ in range(rng.randint(0, 60))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS).unionByName(
        awkward(spark, clash=False).selectExpr("1000 + coalesce(doc_id, 99) doc_id", "text", "lang", "source", "n_chars"))
    out = quality.judge(docs, ["doc_id", "text"])
    assert python_nodes(out) == []
    got = out.collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_signals(r.row.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_verdicts_follow_the_labels(spark):
    """Held-out labels, which the estimate never sees."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    judged = [r for r in quality.judge(docs, ["doc_id"]).collect() if not r.base_failed and r.row.doc_id in labels]
    right = sum(r.kept == bool(labels[r.row.doc_id]) for r in judged)
    assert right >= 0.97 * len(judged)
    assert all(r.kept for r in judged if labels[r.row.doc_id] == 1)


def test_quality_on_awkward_rows(spark):
    docs = awkward(spark)
    assert quality.clean(docs).columns == docs.columns
    assert quality.clean(docs).count() == 0     # short, or one word again and again
    assert quality.judge(empty(spark), ["doc_id"]).count() == 0


def test_estimate_without_votes():
    assert quality.estimate({}) == {}
    only = 1 * sum(3 ** k for k in range(len(quality.RULES)))
    assert 0.5 < quality.estimate({only: 10})[only] <= 1


def test_verdicts_hold_for_any_mix_of_junk():
    """No kind of junk is kept because another kind is common, and a bad vote never speaks for good."""
    def code(**votes):
        return sum(votes.get(name, 2) * 3 ** k for k, (name, _, _) in enumerate(quality.RULES))
    clean = code()
    symbols = code(symbols=0, symbol_share=0, symbol_runs=0)
    shouting = code(capitals=0, exclamations=0)
    shouting_twice = code(capitals=0, exclamations=0, repetition=0, vocabulary=1)
    repeats = code(repetition=0, vocabulary=0)
    for mix in product((0, 100, 680, 1500, 5000), (0, 10, 110, 329, 2000), (0, 20, 133, 1000)):
        n_symbols, n_shouting, n_repeats = mix
        counts = {clean: 8385, symbols: n_symbols, shouting: n_shouting, shouting_twice: n_shouting, repeats: n_repeats}
        found = quality.estimate({p: n for p, n in counts.items() if n})
        assert {p: q >= quality.MIN_POSTERIOR for p, q in found.items()} == {p: p == clean for p in found}, mix
        assert all(q <= found[clean] for q in found.values()), mix


def test_a_pattern_has_one_verdict_in_every_mix():
    """One, two or three bad votes, alone and beside much or other junk, at several sizes."""
    names = [name for name, _, _ in quality.RULES]

    def code(bad=(), none=()):
        return sum((0 if n in bad else 1 if n in none else 2) * 3 ** k for k, n in enumerate(names))

    clean = code()
    for bad in [names[k:k + 1] for k in range(len(names))] + [names[:2], names[2:4], names[3:6]]:
        for n, beside, size, unsure in product((1, 50, 300, 2000), (0, 2000), (800, 8385, 838_500), (0, 500)):
            counts = {clean: size, code(bad): n}
            counts[code(("symbols",))] = counts.get(code(("symbols",)), 0) + beside
            counts |= {code(none=(x,)): unsure for x in names}
            found = quality.estimate({p: c for p, c in counts.items() if c})
            assert {p for p, q in found.items() if q < quality.MIN_POSTERIOR} == {
                p for p in found if p in (code(bad), code(("symbols",)))}, (bad, n, beside, size, unsure)


def test_the_estimate_follows_the_documents():
    """Shares and rates are those of the documents, not of the start; before, the share of good stayed near 0.6."""
    names = [name for name, _, _ in quality.RULES]

    def code(*bad):
        return sum((0 if n in bad else 2) * 3 ** k for k, n in enumerate(names))

    for times in (1, 100):
        counts = {code(): 900, code("symbols"): 60, code("capitals", "exclamations"): 30, code("repetition"): 10}
        q, share, rate = quality.fit({p: n * times for p, n in counts.items()})
        kind = {name: 1 + k for k, name in enumerate(names)}
        assert abs(share[0] - 0.9) < 0.01
        assert abs(share[kind["symbols"]] - 0.06) < 0.01 and abs(share[kind["repetition"]] - 0.01) < 0.01
        assert abs(share[kind["capitals"]] + share[kind["exclamations"]] - 0.03) < 0.01
        assert rate[kind["capitals"], names.index("exclamations")] > 0.95
        assert rate[kind["symbols"], names.index("capitals")] < 0.01
        assert (rate >= rate[0]).all()
        assert [x >= quality.MIN_POSTERIOR for x in q[:, 0]] == [True, False, False, False]
