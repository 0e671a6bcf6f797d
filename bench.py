"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from registria.session import local_session
from workloads import registered

HEADLINE = """uf_stock legal_nature_share city_ranking city_ranking_no_dim openings_by_year openings_last_12mo
status_share cnae_profile enterprise_profile data_quality last_available_month active_rate top5_concentration
city_row_number region_active_rate region_mei_density winsorized_capital region_capital region_gap
join_left_company join_left_simples join_inner_dim_trim state_summary city_drilldown nature_or_status
harden_dates parse_date_prefix8 page_links one_per_family ordered_dedup""".split()


def run(spark, name: str, sf_dir: str) -> float:
    begun = time.perf_counter()
    registered.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    for name in names:  # compiles the generated code; times below are of the queries themselves
        run(spark, name, sf_dir)
    times = {name: round(run(spark, name, sf_dir), 3) for name in names}
    print(json.dumps({
        "metric": "headline queries, total wall time after one warm-up pass", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
