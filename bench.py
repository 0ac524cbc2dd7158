"""Time the headline queries at one scale and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data folder, BENCH_CPUS (default 8) the local cores.
``stage_sources`` writes the source tables of the loan system once; every query then reads them.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from snapbook import configure
from workload.queries import QUERIES
from workload.standins import STAGED, StandIns

HEADLINE = {
    "q1": "E18_Q1_eligible_contracts",
    "q2": "J9_Q2_replanned_dates",
    "q3_q4": "Q3_Q4_loans",
    "q5": "Q5_guarantees",
    "q6": "Q6_portfolios",
    "q7": "G10_Q7_pivot",
    "q8": "Q8_account_entries_lookback",
    "q9": "Q9_register_list",
    "q10": "Q10_account_list",
    "q11": "P2_Q11_type_links",
    "q12": "J16_Q12_forward_match",
    "q13": "J18_Q13_backward_pass",
    "q14": "Q14_accounts",
    "q15": "Q15_disposal_accounts",
    "q16": "Q16_schedules",
    "q17": "Q17_clients_by_division",
    "q18": "Q18_pledges_waterfall",
    "q19": "Q19_table_dictionaries",
    "q20": "Q20_constant_dictionaries",
    "q21": "Q21_corrections",
    "q22": "G4_W3_Q22_last_runs",
    "q23": "Q23_step_audit",
    "q24": "Q24_presence_report",
    "q25": "Q25_clear_store",
    "opening_balance": "J10_E17_opening_balance",
    "replace_slice": "S4_replace_slice",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.sql.files.openCostInBytes", "262144")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-")).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    start = time.time()
    frames = StandIns(spark, sf_dir)
    for name in STAGED:
        frames.raw(name)
    staged = round(time.time() - start, 3)
    for label, name in HEADLINE.items():
        if only and label not in only:
            continue
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[label] = round(time.time() - start, 3)
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "stage_sources": staged, "sf": float(scale.group(1)) if scale else None, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
