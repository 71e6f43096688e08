"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

import json
import os
import statistics
import time

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: Runs of each query; the median counts.
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "flagship_material_wdl", "a1_material_balance", "g5_legal_moves", "f8_checks", "g15_perft", "k7_score_text", "a4_slot_statistics", "o5_root_ranking",
    "a11_thread_vote", "f11_repetition", "e8_dense_layers", "p22_time_allocation",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from plyframe import registry
    from plyframe.sources.corpus import PERFT

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = registry.queries(), {}
    queries[HEADLINE[0]](spark, SF).write.format("noop").mode("overwrite").save()  # starts the JVM's compilers
    spread = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            began = time.perf_counter()
            queries[name](spark, SF).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name] = round(statistics.median(runs), 3)
        spread[name] = [round(min(runs), 3), round(max(runs), 3)]
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("orders", "lineitem")}
    done = {  # what a query works through
        "flagship_material_wdl": ("positions", tables["orders"]), "a1_material_balance": ("positions", tables["orders"]), "g5_legal_moves": ("positions", tables["orders"]), "f8_checks": ("positions", tables["orders"]), "g15_perft": ("leaves", sum(row[3] for row in PERFT)),
        "o5_root_ranking": ("moves", tables["lineitem"]), "a4_slot_statistics": ("rows", tables["lineitem"]), "k7_score_text": ("values", tables["orders"]),
    }
    rates = {f"{name}, {what} a second": round(n / took[name]) for name, (what, n) in done.items()}
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(SF.rstrip("/")), "cpus": int(CPUS), "rates": rates, "least and most of the runs": spread}))


if __name__ == "__main__":
    main()
