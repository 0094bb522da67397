"""Time the registered queries and the generator; print one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores. Every query runs
twice and the second time counts: JVM warm-up is left out, and so are the input tables some
queries write once. Results go to a sink that reads every column.
"""

from __future__ import annotations

import json
import os
import time

from doselake import registry
from doselake.adapters import dose_events
from doselake.operators.profile import frequency_profile
from doselake.operators.sampling import Sampler
from doselake.plans import synth
from doselake.session import builder, work_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
GENERATED_ROWS = 800_000


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        builder("bench")
        .master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        # small data: let rebalanced writes use all local cores
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16MB")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}
    chosen = os.environ.get("BENCH_QUERIES", "").split() or list(registry.QUERIES)
    for name in chosen:
        query = registry.QUERIES[name]
        for _ in range(2):
            times[name] = seconds(lambda query=query: drain(query(spark, SF_DIR)))

    weights = frequency_profile(dose_events(spark, SF_DIR))
    sampler = Sampler.prepare(weights, work_dir(spark, "bench-weights"))
    records = synth.generate(sampler, [202501, 202502], GENERATED_ROWS // 2, 50_000)
    drain(records.limit(10))
    times["generate"] = seconds(lambda: drain(records))
    times["generate_parquet"] = seconds(
        lambda: synth.write_shards(records, work_dir(spark, "bench-shards"))
    )
    rows = dose_events(spark, SF_DIR).count()
    print(
        json.dumps(
            {
                "metric": "all_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "rows_per_sec": {
                    **{n: round(rows / times[n]) for n in ("rollup_a", "rollup_b") if n in times},
                    "generate": round(GENERATED_ROWS / times["generate"]),
                    "generate_parquet": round(GENERATED_ROWS / times["generate_parquet"]),
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
