"""Benchmark: the pipeline steps and headline queries at one scale.

usage: BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each timing forces the full computation (a Parquet write, a ``noop``
write or a collect of the small result).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# registered queries always fit the full ones.
FULL = os.environ.get("BENCH_MODELS") == "full"


def main():
    from credit_spark.plans import pipeline as PL
    from credit_spark.plans import train as TR
    from credit_spark.plans.registry import QUERIES
    from credit_spark.session import local_session
    from credit_spark.streaming.score_stream import start_scoring
    from credit_spark.session import scratch_path
    from credit_spark.plans import score as SC
    from credit_spark.plans import stages as S

    settings = TR.TrainSettings() if FULL else TR.TrainSettings.quick()

    spark = local_session(cores=CPUS, shuffle_partitions=int(CPUS) * 2)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def run_all(sf_dir, times):
        """Every timed step on one data folder; returns the paths used."""
        def timed(name, fn):
            t = time.time()
            out = fn()
            times[name] = round(time.time() - t, 3)
            return out

        timed("risk_summary", lambda: QUERIES["risk_summary"](spark, sf_dir).collect())
        p = PL.paths(spark)
        stats = timed("clean", lambda: PL.step_clean(spark, sf_dir, p))
        fz = timed("featurize", lambda: PL.step_featurize(spark, p))
        timed("correlation_matrix", lambda: PL.step_correlate(spark, p).collect())
        sel = timed("select_features", lambda: PL.step_select(spark, p))
        model = timed("fit_models", lambda: PL.step_fit(spark, p, fz, sel, settings))
        timed("score", lambda: PL.step_score(spark, sf_dir, model, p, stats))

        def stream():
            inp = SC.score_input(S.filled(spark, sf_dir))
            src, out, ck = (scratch_path(spark, n) for n in ("b-in", "b-out", "b-ck"))
            inp.write.parquet(src)
            t = time.time()
            start_scoring(spark, model, src, out, ck, inp.schema).awaitTermination()
            return time.time() - t
        times["stream_score"] = round(stream(), 3)

        for q in ("describe_numeric", "null_counts", "histograms", "ratio_histograms",
                  "density_curve", "validate_applicants", "recommendations",
                  "classification_metrics", "dedupe_report", "category_values"):
            timed(q, lambda q=q: noop(QUERIES[q](spark, sf_dir)))
        return p

    # Warm-up: one full pass over the smallest data folder next to the
    # measured one, so the timings below are of a warm JVM (JIT-compiled
    # operators, loaded classes), as on a long-running cluster. Its
    # timings are reported separately and not counted.
    warm_dir = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    warm = {}
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(SF_DIR):
        run_all(warm_dir, warm)
    else:
        QUERIES["row_count"](spark, SF_DIR).collect()

    times = {}
    p = run_all(SF_DIR, times)

    # The same tabular queries as SQL in DuckDB on the same files: a
    # single-node reference point (no models).
    duck = {}
    try:
        import duckdb
        from credit_spark.plans.registry import ORACLE
        con = duckdb.connect()
        con.execute(f"CREATE VIEW orders AS SELECT * FROM '{SF_DIR}/orders.parquet'")
        for q in ("risk_summary", "clean_applicants", "featurize", "correlation_matrix",
                  "describe_numeric", "null_counts", "histograms", "ratio_histograms",
                  "density_curve", "validate_applicants", "recommendations",
                  "classification_metrics", "dedupe_report", "category_values"):
            t = time.time()
            con.execute(ORACLE[q]).fetchall()
            duck[q] = round(time.time() - t, 3)
    except Exception as e:  # noqa: BLE001
        duck["error"] = str(e)[:200]

    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    rows = spark.read.parquet(p.cleaned).count()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "pipeline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf.group(1)) if sf else SF_DIR, "cpus": int(CPUS),
                      "applicants": rows, "model_settings": "full" if FULL else "quick", "duckdb_sql": duck,
                      "warmup_sec": round(sum(warm.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
