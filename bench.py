"""Time the headline queries and print one line of JSON.

Before the clock starts, the records' texts are written to a shared folder, from
which the queries read them as the jobs read theirs, and each query runs once over
the smallest tables, so that no time goes to compiling classes. Then each runs
`BENCH_RUNS` times (1), of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from assayer.session import build_session
from catalog import QUERIES, views

HEADLINE = (
    "prepare_evidence_e2e",
    "prepare_tables_e2e",
    "prepare_scores_e2e",
    "calculate_scores_e2e",
    "json_validate_summary",
    "lookup_rewrite_counts",
    "score_dispatch",
    "source_scores",
    "association_scores",
    "evidence_scores",
    "topk_per_group",
    "field_diff",
    "presence_counts",
    "interval_coverage",
    "count_of_counts",
)


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds a query takes; the no-op sink computes every column of every row."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    views.write_texts(spark, sf_dir)
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in HEADLINE:
            run(spark, name, small)
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    seconds = {
        name: round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
        for name in HEADLINE
    }
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
