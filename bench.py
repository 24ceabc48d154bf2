"""Run the headline queries once each and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the tables
and the cores. Each query runs to completion into the no-op sink twice; the second run, building
the plan included, is reported, so that class loading and compilation are left out.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import all_checks, runner  # noqa: E402
from rosterlake.session import local_session  # noqa: E402

HEADLINE = (
    "ag01_salary_budget",
    "ag02_rollup_total",
    "ag03_cube_gender",
    "ag04_department_ranks",
    "ag07_running_totals",
    "ag08_payroll_expense",
    "ag09_leave_rollup",
    "hr11_more_than_manager",
    "hr17_region_summary",
    "co01_project_hours",
    "co03_projects_with_workers",
    "jn04_staff_and_leave",
    "jn05_staff_pay_totals",
    "jn06_department_payroll",
    "sq01_pay_against_department",
    "sq04_existence_flags",
    "sq06_ranks_with_department",
    "sq07_payroll_report",
    "sq08_approval_chain",
    "vw04_employee_profile",
    "vw05_payroll_analysis",
    "vw09_monthly_payroll",
    "mo01_missing_payroll",
    "w01_row_number",
    "w02_rank",
    "w06_running_total",
    "d02_guard_audit",
    "d04_payroll_audit",
    "n01_explode_multivalue",
)


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    checks = all_checks()
    seconds = {}
    for name in HEADLINE:
        query = runner(checks[name])
        run(query, spark, folder)
        seconds[name] = run(query, spark, folder)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
