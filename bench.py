"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
import uuid

from holdfast.operators import drift, kpi, leakage, metrics, model, priority, quality, retrieval, snapshot
from holdfast.session import ensure_checkpoint_dir, local_session
from holdfast.sources import sinks
from holdfast.sources.sample_tables import SAMPLE_DATES
from proof.base import THRESHOLD, Tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, FOLDER)
    # The sample file is one row group, hence one task; spread the texts before they are split into terms.
    documents = t.raw("documents").select("doc_id", "text").repartition(int(CPUS) if CPUS.isdigit() else 8)
    queries = t.raw("benchmark").selectExpr("item_id AS query_id", "text")

    stored = {}

    def build_index() -> None:
        stored["index"] = retrieval.build_index(documents, "doc_id")

    def upsert() -> None:
        rows = model.prediction_rows(t.scores, THRESHOLD, "bench", "run")
        root = f"{ensure_checkpoint_dir(spark)}/bench-{uuid.uuid4().hex}"
        sinks.upsert_predictions(spark, rows, root)
        sinks.upsert_predictions(spark, rows.filter("split_name = 'test'"), root)

    spark.range(1_000_000).selectExpr("sum(id)", "count(DISTINCT id % 1000)").collect()  # warm-up, not timed

    steps = {
        # The snapshot is computed afresh, never cached.
        "table_volumes": lambda: _run(quality.table_volumes({"policy": t.fact_policy, "payment": t.fact_payment, "interaction": t.fact_interaction})),
        "customer_snapshot": lambda: _run(snapshot.build_snapshot(t.dim_customer, SAMPLE_DATES, **t.facts())),
        "store_snapshot": lambda: t.wide,
        "retention_queue": lambda: _run(priority.ordered_queue(priority.score(t.candidates))),
        "store_queue": lambda: t.queue,
        "store_engineered_panel": lambda: t.engineered,
        "drift_report": lambda: _run(drift.analyze(t.engineered)),
        "model_metrics": lambda: _run(metrics.evaluate(t.scores, THRESHOLD)),
        "threshold_grid": lambda: _run(metrics.threshold_grid(t.scores, keys=["split_name"])),
        "kpi_by_agency": lambda: _run(kpi.priority_clients(t.queue, ["agency_name", "region"])),
        "integrity_report": lambda: _run(quality.integrity_report({
            "dim_customer": t.dim_customer, "dim_agency": t.dim_agency, "fact_policy": t.fact_policy, "fact_payment": t.fact_payment,
        })),
        "leakage_audit": lambda: _run(leakage.audit(t.engineered)),
        "upsert_predictions": upsert,
        "document_index": build_index,
        "document_search": lambda: _run(retrieval.search(queries, stored["index"])),
    }
    timings = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        timings[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": os.path.basename(FOLDER.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
