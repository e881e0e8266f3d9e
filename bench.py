"""Time the build of the layers and every dataset; prints one JSON line.

BENCH_SF_DIR   folder of the star tables   (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local master   (default 8)
BENCH_ROUNDS   timed runs per dataset after one warm-up; the median counts (default 3).
               The builds are timed once, after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import P5, lineitem_dedupe, lineitem_dedupe_report, props_json_parse  # noqa: E402
from checks.workbench import Workbench  # noqa: E402
from starsmelt.operators.filters import Params  # noqa: E402
from starsmelt.plans.datasets import DATASETS, run  # noqa: E402
from starsmelt.plans.medallion import (  # noqa: E402
    MedallionTables,
    load_bronze,
    refine_gold,
    refine_silver,
)
from starsmelt.session import settings_for  # noqa: E402
from starsmelt.sources import Stage  # noqa: E402


def local_session(cpus: str, folder: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="bench-")
    input_bytes = sum(path.stat().st_size for path in Path(folder).glob("*.parquet"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
    )
    for name, value in settings_for(input_bytes, int(cpus)).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = local_session(cpus, folder)
    bench = Workbench(spark, folder)
    times: dict[str, float] = {}

    pages = bench.pages  # making the input is not part of the work
    target = bench.new_target()
    rows = load_bronze(spark, pages, target)
    buckets = target.buckets_for(rows, spark.sparkContext.defaultParallelism)
    builds = {
        "load_bronze": lambda: load_bronze(spark, pages, target),
        "build_silver": lambda: refine_silver(spark, target, Stage(spark), buckets),
        "build_gold": lambda: refine_gold(spark, target, buckets),
    }
    for action in builds.values():  # warm-up, as for the queries below
        action()
    for name, action in builds.items():
        times[name] = seconds(action)

    tables = MedallionTables(spark, target)
    queries = {}
    for name, dataset in DATASETS.items():
        queries[name] = lambda name=name: run(name, tables, Params()).collect()
        if dataset.accepts:
            queries[f"{name}_filtered"] = lambda name=name: run(name, tables, P5).collect()
    for query in (lineitem_dedupe, lineitem_dedupe_report, props_json_parse):
        name = query.__name__
        queries[name] = (
            lambda query=query: query(spark, folder).write.format("noop").mode("overwrite").save())
    for name, action in queries.items():
        action()
        times[name] = statistics.median(seconds(action) for _ in range(rounds))

    print(json.dumps({
        "metric": "medallion_build_and_datasets",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in times.items()},
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
