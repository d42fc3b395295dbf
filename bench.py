"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; print one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fareledger.catalog import model, profiles, quality, registry, trips
from fareledger.plans import rollup, star
from fareledger.plans.build import fact_builder
from fareledger.session import local_session, shared_dir
from fareledger.sources.tables import Warehouse

WARM_RUNS = 3
# Served queries run on the stored star, so they are timed warm like the published medians.
SERVED = {
    "summary": model.summary,
    "summary_filtered": model.summary_filtered,
    "monthly": model.monthly,
    "top_zones": model.top_zones,
    "top_zones_filtered": model.top_zones_filtered,
}
BATCH = {
    "dim_date": model.dim_date,
    "loaded_only": model.loaded_only,
    "lineage_counts": model.lineage_counts,
    "nearest_rank": model.nearest_rank,
    "q_scalar": quality.q_scalar,
    "q_domain": quality.q_domain,
    "q_reference": quality.q_reference,
    "q_duplicates": quality.q_duplicates,
    "q_duplicates_wide": quality.q_duplicates_wide,
    "q_results": quality.q_results,
    "p_numeric": profiles.p_numeric,
    "p_reference": profiles.p_reference,
    "register_files": registry.register_files,
    "run_log": registry.run_log,
    "integrity_audit": registry.integrity_audit,
}


def seconds(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, max(int(cpus), 1) if cpus.isdigit() else 8)
    rows = trips.table(spark, sf_dir, "lineitem").count()
    orders = trips.table(spark, sf_dir, "orders").count()
    times: dict[str, float] = {}

    from fareledger.catalog import files
    times["raw_load_twice"] = seconds(lambda: drain(files.append_raw(spark, sf_dir)))
    times["file_manifest"] = seconds(lambda: drain(files.file_manifest(spark, sf_dir)))

    built = star.enrich(trips.trips(spark, sf_dir))
    warehouse = Warehouse(spark, f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}")
    build = None

    def dimensions():
        nonlocal build
        build = fact_builder(*trips.dimensions(spark, sf_dir))

    def fact(known):
        rows = star.arriving(raw, known, warehouse)
        if rows is not None:
            star.incremental_fact(star.enrich(rows), warehouse, build, only_new=True)

    times["dimensions"] = seconds(dimensions)
    times["fact_full_refresh"] = seconds(lambda: star.incremental_fact(
        built, warehouse, build, full_refresh=True, rebalance=True))
    warehouse = Warehouse(spark, f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}")
    raw, registry_rows = trips.raw_trips(spark, sf_dir, warehouse)
    fact(registry_rows.where("source_file_id < 199800"))
    times["fact_incremental"] = seconds(lambda: fact(registry_rows))
    times["fact_noop"] = seconds(lambda: fact(registry_rows))
    times["rollup_refresh"] = seconds(lambda: rollup.refresh(warehouse))

    trips.stored_star(spark, sf_dir)
    for name, run in SERVED.items():
        runs = [seconds(lambda: run(spark, sf_dir).collect()) for _ in range(WARM_RUNS + 1)]
        times[name] = round(statistics.median(runs[1:]), 3)
    for name, run in BATCH.items():
        times[name] = seconds(lambda: drain(run(spark, sf_dir)))

    scale = re.search(r"sf([\d.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else sf_dir,
        "lineitem_rows": rows,
        "raw_load_rows_per_sec": round(2 * rows / times["raw_load_twice"]),
        "fact_rows": rows + orders,
        "fact_rows_per_sec": round((rows + orders) / times["fact_full_refresh"]),
    }))


if __name__ == "__main__":
    main()
