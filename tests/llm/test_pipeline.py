import os

import numpy as np
import pytest

from credit_spark.llm import sql
from credit_spark.llm.queries import ORACLE, QUERIES, tokenizer_path

from .helpers import awkward, empty
from .test_dedup import brute_fingerprint, brute_groups, brute_lines
from .test_plans_and_layout import brute_signals
from .test_scans import brute_leaks

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    cols = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_sql_is_named_for_queries():
    assert set(ORACLE) <= set(QUERIES) and sql.LINE_DEDUP


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline as P
    from tokenizers import Tokenizer

    from credit_spark.llm import quality
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    verdict = {r.row.doc_id: r.kept for r in
               quality.judge(spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id"]).collect()}
    for r in docs:
        n, *_, repeats = brute_signals(r.text)
        assert not (verdict[r.doc_id] and (n < 50 or 2 * repeats > n))
    left = [(r.doc_id, r.text) for r in docs if verdict[r.doc_id]]
    left = [(i, kept) for (i, _), (_, _, kept) in zip(left, brute_lines([t for _, t in left], 10))]
    group = brute_groups([brute_fingerprint(t) for _, t in left])
    left = [x for k, x in enumerate(left) if group[k] == k]
    left = [x for x in left if not brute_leaks(x[1], bench)[1]]
    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {}
    for i, t in left:
        ids = lib.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), ids, lib.decode(ids, skip_special_tokens=False))
    got = {r.doc_id: (r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in P.run(spark, SF).collect()}
    assert got == want


def test_stages_on_awkward_tables(spark):
    import corpus_pipeline as P
    for docs in (awkward(spark), empty(spark)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            if name != P.STAGES[-1][0]:
                assert out.columns == docs.columns, name
            assert out.count() <= docs.count()


def test_rest_imports_without_this_folder(tmp_path):
    """The entry point works where the text operators were removed."""
    import shutil
    import subprocess
    import sys
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in ("__spark_entry__.py", "credit_spark"):
        src = os.path.join(top, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'risk_summary' in q and not any(k[:2] == 'op' for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
