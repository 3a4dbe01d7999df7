"""Land the driver's testdata in the landing layout and time a full build.

Usage: python tools/land_testdata.py [sf_dir]
Writes a landing folder and a warehouse under the shared checkpoint folder
(``scratch_path``), runs ``build_all`` over all of it, from the first price day
to the last FX day, and prints one JSON line with the landing and build times
and per-table counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.plans.build import build_all  # noqa: E402
from daybook.session import get_session, scratch_path  # noqa: E402
from daybook.sources import testdata as td  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16, extra_conf={"spark.driver.memory": "16g"})
    root, out = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    t0 = time.perf_counter()
    td.land_files(spark, sf_dir, root)
    t1 = time.perf_counter()
    report = build_all(spark, root, out, td.PRICE_START, td.FX_END, facts_json_lines=True, concepts=td.LANDED_CONCEPTS)
    t2 = time.perf_counter()
    spark.stop()
    print(json.dumps({"landing_sec": round(t1 - t0, 2), "build_sec": round(t2 - t1, 2),
                      "tables": report, "sf_dir": sf_dir}))


if __name__ == "__main__":
    main()
