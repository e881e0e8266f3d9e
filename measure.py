"""Compare design choices on the star tables; prints one line per variant.

BENCH_SF_DIR, BENCH_CPUS, BENCH_ROUNDS as in bench.py. One warm-up, then the median.
"""

from __future__ import annotations

import os
import statistics

from pyspark.sql import functions as F

from bench import local_session, seconds
from checks.queries import LINE_KEY, P5
from checks.workbench import Workbench
from starsmelt.fixtures import star_table
from starsmelt.operators import (
    dedupe,
    dedupe_by_key,
    explode_bridge,
    null_tokens_to_null,
    parse_json_columns,
)
from starsmelt.operators.filters import Params
from starsmelt.plans.datasets import DATASETS, run
from starsmelt.plans.medallion import MedallionTables, load_bronze, refine_gold, refine_silver
from starsmelt.plans.silver import SILVER_TABLES, silver_layout, silver_table
from starsmelt.schemas import DECODED_COLUMNS, OPAQUE_FIELDS
from starsmelt.sources import Stage


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = local_session(cpus, folder)
    bench = Workbench(spark, folder)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def report(what, action):
        action()
        print(f"{what}: {statistics.median(seconds(action) for _ in range(rounds)):.2f} s", flush=True)

    bucketed, plain = bench.new_target(buckets=int(cpus)), bench.new_target(buckets=0)
    load_bronze(spark, bench.pages, bucketed)
    bronze = spark.table(f"{bucketed.bronze}.items")
    clean = null_tokens_to_null(bronze.drop(*OPAQUE_FIELDS))

    def silver_parsed_in_each():
        parsed = parse_json_columns(dedupe_by_key(clean, ["id"]), DECODED_COLUMNS)
        plain.layer(spark, "silver").write(
            {name: silver_table(name, parsed) for name in SILVER_TABLES},
            {name: silver_layout(name, 0) for name in SILVER_TABLES})

    report("silver, decoded in each of 13 tables", silver_parsed_in_each)
    report("silver, decoded once, bucketed",
           lambda: refine_silver(spark, bucketed, Stage(spark), int(cpus)))
    load_bronze(spark, bench.pages, plain)
    report("silver, decoded once, plain", lambda: refine_silver(spark, plain, Stage(spark), 0))

    report("gold, bucketed", lambda: refine_gold(spark, bucketed, int(cpus)))
    report("gold, plain", lambda: refine_gold(spark, plain, 0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    report("gold, bucketed, no broadcast", lambda: refine_gold(spark, bucketed, int(cpus)))
    for label, target in (("bucketed", bucketed), ("plain", plain)):
        tables = MedallionTables(spark, target)
        for set_name, params in (("P0", Params()), ("P5", P5)):
            report(f"11 datasets {set_name}, {label}, no broadcast", lambda: [
                run(name, tables, params).collect() for name, ds in DATASETS.items() if ds.accepts])
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for label, target in (("bucketed", bucketed), ("plain", plain)):
        tables = MedallionTables(spark, target)
        for set_name, params in (("P0", Params()), ("P5", P5)):
            report(f"11 datasets {set_name}, {label}", lambda: [
                run(name, tables, params).collect() for name, ds in DATASETS.items() if ds.accepts])

    report("bronze unique, all rows ranked", lambda: noop(dedupe_by_key(clean, ["id"])))
    report("bronze unique, repeated keys ranked", lambda: noop(dedupe(clean, ["id"], Stage(spark))))

    lines = star_table(spark, folder, "lineitem")
    others = [name for name in lines.columns if name not in LINE_KEY]
    report("lineitem unique, row_number", lambda: noop(dedupe_by_key(lines, LINE_KEY)))
    report("lineitem unique, min(struct)", lambda: noop(
        lines.groupBy(*LINE_KEY).agg(F.min(F.struct(*others)).alias("s")).select(*LINE_KEY, "s.*")))

    parsed = bench.parsed
    report("platform bridge, member exploded", lambda: noop(explode_bridge(
        parsed, ("id", "item_id"), "_platforms", {"platform_id": "platform.id"}, "platform_id")))
    report("platform bridge, struct exploded", lambda: noop(
        parsed.select("id", F.explode("_platforms").alias("p"))
        .select("id", F.col("p.platform.id").alias("platform_id")).filter("platform_id IS NOT NULL")))
    spark.stop()


if __name__ == "__main__":
    main()
