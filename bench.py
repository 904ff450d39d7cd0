"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import re
import time

from millrace import build_session
from millrace.plans import QUERIES

HEADLINE = [
    # grouping and combining
    "window_sum_per_key", "sum_per_key", "count_per_element", "salted_two_phase_sum", "group_by_key", "group_into_batches",
    "udaf_combinefn", "top_n", "distinct_values",
    # joins
    "join_inner_product", "cogroup_sum", "join_broadcast_sum", "semi_join_list", "join_tiered_match", "enrich_batched_lookup",
    # payloads and cells
    "xml_gunzip_sum", "xml_multi_sum", "xml_sum_per_key", "json_variant_filter", "flatmap_explode", "kv_latest_cell", "kv_condition_label",
    # windows, lateness, triggers, alerts
    "window_count_per_key", "late_pane_discarding", "late_pane_accumulating", "trigger_element_count", "trigger_after_first", "alert_low_volume",
    # files and streams
    "scan_nested", "scan_csv_gz", "sink_windowed", "stream_dedup", "stream_window_concat", "stream_xml_window_sum", "stream_group_into_batches",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{folder}/region.parquet").count()  # start-up is not part of the figures

    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale[1]) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
