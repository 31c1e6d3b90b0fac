"""Wall time of every registered query; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores, and
BENCH_QUERIES, a comma-separated list, restricts the run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from snapmart.session import build_session  # noqa: E402


def timed(spark, name: str, sf_dir: str) -> float:
    """Seconds to build the query and compute every row, with nothing written or collected."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or list(QUERIES)
    spark = build_session(
        "snapmart-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the session, the code generator and the Python side is not what is measured.
    timed(spark, "default_rate_by_snapshot", sf_dir)
    seconds = {name: round(timed(spark, name, sf_dir), 3) for name in names}
    spark.stop()
    scale = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
