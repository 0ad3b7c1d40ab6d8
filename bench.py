"""Benchmark: build the warehouse from the five sources and run the headline
queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``build`` is the end-to-end ETL (sources -> equivalence -> staging ->
dimensions -> fact, written once); every other entry is one registered
query timed on its own, run to completion through Spark's ``noop`` sink:
the whole plan executes on the executors, but the result is not shipped to
the driver (what a cluster job that writes its output does; collecting a
million rows into Python would mostly time row conversion).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["vw_ventas_mensuales", "fact_ventas", "load_diagnostics", "baskets", "frequent_itemsets_sku",
            "association_rules_category", "recommend_top5", "kpi_growth_yoy", "kpi_top_clients",
            "ventas_vs_metas", "incremental_load", "equivalence_map"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from salesmart.session import local_session
    from salesmart.plans import etl
    from salesmart.plans.queries import QUERIES

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}
    t0 = time.time()
    etl.warehouse_tables(spark, sf_dir)
    times["build"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
