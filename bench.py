"""Time the core queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line. Median of three warm runs each."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from driftline.plans.everything import QUERIES

HEADLINE = ("window_scan", "dedup_argmax", "dedup_ties", "slice_grid_counts", "publish_overwrite", "cells_to_rows", "cf_any_filter", "rowkey_pk_decode", "typed_value_decode", "confluent_frame", "journal_transitions", "sanitize_stale", "json_parse", "avro_parse", "rowkey_typed_decode", "stream_publish")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC"}
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    out = {}
    for name in HEADLINE:
        times = []
        for k in range(2 if name == "stream_publish" else 4):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if k:
                times.append(time.perf_counter() - began)
        out[name] = round(statistics.median(times), 3)
    print(json.dumps({"metric": "core queries, sum of medians", "value": round(sum(out.values()), 3), "unit": "sec", "queries": out, "sf": sf_dir.rpartition("sf")[2]}))


if __name__ == "__main__":
    main()
