"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the given tables (default /root/testdata/sf0.1); BENCH_CPUS: local threads (default 8).
Each query is planned and run to the end, without collecting its rows; the second of two runs counts, so
that JVM start-up is left out. A first-run total is reported beside it.
"""

from __future__ import annotations

import json
import os
import time

from tandem.session import session
from tandem.workload.queries import QUERIES

HEADLINE = [
    "claim_dataset", "training_rows", "payment_summary", "fused_payments", "split_B_payments", "unique_payments",
    "merged_clients", "prepared_payments", "prepared_contracts", "contracts_by_status_and_type", "compiled_scores",
    "stratified_folds", "quality_report", "messages_payments", "landed_payments", "slow_steps", "cross_validation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    first, second = {}, {}
    for seconds in (first, second):
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "first_run_value": round(sum(first.values()), 3),
            }
        )
    )


if __name__ == "__main__":
    main()
