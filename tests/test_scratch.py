"""Scratch tables of a scope are deleted when it is left; everything else stays."""
import os

import pytest

from credit_spark.plans import stages as S
from credit_spark.plans.registry import QUERIES
from credit_spark.session import scratch_path, scratch_scope
from tests.conftest import SF_SMALL


def here(path):
    return os.path.exists(path.removeprefix("file:"))


def test_a_query_s_tables_go_and_its_result_stays(spark, tmp_path):
    out = str(tmp_path / "result")
    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    S._STAGES.clear()
    with scratch_scope(spark) as made:
        QUERIES["export_cleaned"](spark, SF_SMALL).write.parquet(out)
        assert len(made) >= 2 and all(map(here, made))
    assert not any(map(here, made)) and here(kept)
    assert spark.read.parquet(out).count() == 1500
    # The shared stage was made inside, so it is made again.
    assert S.cleaned(spark, SF_SMALL).count() == 1500


def test_errors_and_nested_scopes(spark):
    with pytest.raises(RuntimeError), scratch_scope(spark) as outer:
        a = scratch_path(spark, "outer")
        spark.range(2).write.parquet(a)
        with scratch_scope(spark) as inner:
            b = scratch_path(spark, "inner")
            spark.range(2).write.parquet(b)
        assert (outer, inner) == ([a], [b]) and here(a) and not here(b)
        raise RuntimeError
    assert not here(a)
    with scratch_scope(spark) as made:
        pass
    assert made == [] and scratch_path(spark, "after") not in made
