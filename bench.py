"""Headline queries, timed: one line of JSON.

``BENCH_SF_DIR`` is the folder of tables, ``BENCH_CPUS`` the number of cores. Every query is run
once to warm up and then ``BENCH_RUNS`` times; its time is the median. Each run plans the query and
computes all of its rows (a ``noop`` write). The staged inputs are written before the clock starts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from linkindex.demo.adapters import Tables
from linkindex.demo.catalogue import QUERIES

HEADLINES = [
    "index_full", "explode_links", "link_paye", "latest_employees", "legal_entities_refs",
    "paye_refs", "match_by_company", "match_by_vat", "assign_ids_key", "assign_ids_full",
    "assign_ids_first_month", "dense_ids", "ingest_roundtrip", "write_links_roundtrip",
    "csv_extract", "profile", "index_deduped", "match_by_paye", "assign_ids_one_to_one",
    "legal_entities_direct",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("linkindex-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    tables = Tables.of(spark, folder)
    for name in ("tcn", "new_links", "prev_links", "edited_links", "links", "index"):
        tables[name]
    staging = time.perf_counter() - start

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINES:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
                "staging_sec": round(staging, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
