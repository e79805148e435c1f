"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is materialised with the ``noop`` sink (a ``.count()`` lets
Catalyst prune the distance away, so it would time a join, not the work).
Each query runs once untimed (JIT, codegen, file listing), then
$BENCH_RUNS timed runs; the mean is reported.

Queries:
- centroid_{native,udf,pandas_udf}_x51: the reference's benchmark protocol,
  customer points replicated 51 times (765,000 rows at sf0.1 vs the
  reference's 770,200), repartitioned and cached once (S6 + S7), then the
  distance to the group centroid with the three implementations, utm
  metric, written to the noop sink.
- centroid_pick_lineitem: nearest-to-centroid pick over all line items.
- centroid_pick_orders_haversine: pick per priority over all orders.
- medoid_orders_haversine: exact medoid per priority (5 groups x 30,000 at sf0.1).
- report_metric_agreement: three metrics' picks in one plan.
- clean_records: raw records -> cleaned, reprojected table.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from omphalos.operators.centroid import distance_to_centroid, nearest_to_centroid  # noqa: E402
from omphalos.operators.medoid import medoid  # noqa: E402
from omphalos.plans import reports  # noqa: E402
from omphalos.session import local_session  # noqa: E402
from omphalos.sources import clean, io  # noqa: E402
from omphalos.sources import points as pts  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _sf_label(path: str) -> str:
    name = Path(path.rstrip("/")).name
    return name[2:] if name.startswith("sf") else name


def main() -> None:
    spark = local_session(cores=CPUS, shuffle_partitions=max(8, 2 * CPUS), app="omphalos-bench")

    cached = io.prepare_for_reuse(io.replicate(pts.customer_centers(spark, SF_DIR), 51))
    cached.count()

    def replicated():
        return cached

    qs = {
        "centroid_native_x51": lambda: distance_to_centroid(replicated(), "ownership", "utm_x", "utm_y", "utm", "native"),
        "centroid_pandas_udf_x51": lambda: distance_to_centroid(replicated(), "ownership", "utm_x", "utm_y", "utm",
                                                                "pandas_udf"),
        "centroid_udf_x51": lambda: distance_to_centroid(replicated(), "ownership", "utm_x", "utm_y", "utm", "udf"),
        "centroid_pick_lineitem": lambda: nearest_to_centroid(pts.lineitem_points(spark, SF_DIR), "ownership",
                                                              "utm_x", "utm_y", "utm"),
        "centroid_pick_orders_haversine": lambda: nearest_to_centroid(pts.orders_centers(spark, SF_DIR), "ownership",
                                                                      "longitude", "latitude", "haversine"),
        "medoid_orders_haversine": lambda: medoid(pts.orders_centers(spark, SF_DIR), "ownership", "center_id",
                                                  "longitude", "latitude", "haversine"),
        "report_metric_agreement": lambda: reports.metric_agreement(pts.customer_centers(spark, SF_DIR)),
        "clean_records": lambda: clean.clean_records(pts.customer_raw_records(spark, SF_DIR)),
    }
    times = {}
    for name, build in qs.items():
        build().write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(max(1, RUNS)):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.mean(runs), 3)
    cached.unpersist()
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf_label(SF_DIR),
        "cpus": CPUS,
        "runs": max(1, RUNS),
    }))


if __name__ == "__main__":
    main()
