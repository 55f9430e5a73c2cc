"""Wall time of the headline queries; prints one JSON line.

``$BENCH_SF_DIR`` names the tables, ``$BENCH_CPUS`` the local cores. ``land_raw`` derives and
writes the raw tables, ``build_marts`` the marts and panels from them; the other queries read
what they stand on, as the transformations of a warehouse do.
Every query runs once to warm up, then three times; the median counts. With ``--duckdb`` the
statements of ``fixtures.oracle`` are timed instead, on the same stored tables and as many threads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from fixtures import adapter, oracle  # noqa: E402
from fixtures.compare import duck  # noqa: E402
from fixtures.queries import REGISTRY  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

HEADLINE = [
    "alias_resolution",
    "stage_facts",
    "balance_sheet",
    "income_statement",
    "financials",
    "asof_keyed",
    "asof_keyless",
    "valuation_daily",
    "monthly_changes",
    "quarterly_leverage_changes",
    "ols_valuation_by_ticker",
    "ols_leverage_pooled",
    "indexed_series",
    "trend_summary_text",
    "latest_snapshot",
    "latest_event_per_user",
    "status_pivot",
]
RUNS = 3


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median_time(action) -> float:
    action()
    return round(statistics.median(timed(action) for _ in range(RUNS)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    # The run's own shared folder, removed with everything in it at the end.
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        run(sf_dir, cpus, shared)


def run(sf_dir: str, cpus: str, shared: str) -> None:
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": shared,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [a for a in sys.argv[1:] if a != "--duckdb"] or ["land_raw", "build_marts", *HEADLINE]
    seconds = {}
    adapter.marts(spark, sf_dir)
    if "--duckdb" in sys.argv:
        con = duck(sf_dir)
        con.execute(f"SET threads = {cpus}")
        for name in [n for n in names if n in REGISTRY]:
            text = oracle.sql(name, adapter.stored_relations(spark, sf_dir, name))
            seconds[name] = median_time(lambda: con.execute(f"CREATE OR REPLACE TEMP TABLE result AS {text}"))
        spark.stop()
        print(json.dumps({"metric": "duckdb", "queries": seconds}), flush=True)
        return
    for name in names:
        if name == "land_raw":
            seconds[name] = median_time(lambda: adapter.land(spark, sf_dir))
        elif name == "build_marts":
            seconds[name] = median_time(lambda: adapter.build_marts(spark, sf_dir))
        else:
            seconds[name] = median_time(lambda: consume(REGISTRY[name](spark, sf_dir)))
    result = {
        "metric": "total_median_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "spark": spark.version,
        "cpus": int(cpus),
        "shuffle_partitions": int(cpus),
        "runs": RUNS,
    }
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
