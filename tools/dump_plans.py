"""Write PLANS.md: the final (adaptive) physical plan of key queries,
after running them at sf0.01.

usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEY = ["report_long", "top_push_repos", "repo_type_matrix_top15", "run_counters", "all_users", "schema_profile",
       "leader_headline", "first_n_lines", "required_fields", "discovery_document", "repo_type_matrix_wide", "dataset_summary"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from eventlens.plans.catalog import QUERIES
    from eventlens.session import get_session

    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans", "",
           f"Final adaptive plans after running each query on `{sf}` with `local[8]` "
           "(generated by `tools/dump_plans.py`; node details omitted).", "",
           "The `Exchange` directly above `Scan parquet` is `spread()`: the test tables are one row group "
           "(one split) and JSON work is spread over the cores; on a large input the scan has more splits "
           "than cores and that exchange is not planned.  `ReusedExchange` marks a shuffle computed once and "
           "read by two branches; `WindowGroupLimit` below an `Exchange` is the per-task top-k applied "
           "before shuffling.", ""]
    for name in KEY:
        df = QUERIES[name](spark, sf)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        tree = buf.getvalue().split("== Initial Plan ==")[0].split("\n\n")[0]
        doc = (QUERIES[name].__doc__ or "").strip().split("\n")[0]
        out += [f"## {name}", "", doc, "", "```", tree.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
