"""Write docs/PLANS.md: the physical plan tree of the headline queries.

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from mentionscope.plans.catalog import REGISTRY  # noqa: E402
from mentionscope.session import build_session  # noqa: E402

NOTES = {
    "t1_daily_top_names": "Partial count on (day, name) before the first exchange; a partial "
                          "`WindowGroupLimit` (k per day per task) before the day exchange.",
    "e4_rolling_changelog": "One scan, `Generate` for the +1/-1 pair, one exchange on (name, span): the changes that "
                            "expire within a span give the count it starts with, so there is no join.",
    "e1_event_time_spread": "Row index per segment by blocks of positions; the blocks' offsets read the same exchange "
                            "(`ReusedExchange` once the plan runs), so the table is read once.",
    "t6_hourly_boards": "Latest value per (hour, name) by a partial/final `max_by`; top-100 per hour with "
                        "`WindowGroupLimit`.",
    "k5_conflated_feed": "Conflation is a grouped aggregate; positions within a second by a bucketed row number, both sides of "
                         "its join on one exchange.",
    "st4_sliding_hour_counts": "`Expand` into the four windows of each row, then a partial/final count.",
}


def tree(spark, df) -> str:
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return text.split("\n\n\n")[0].strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=8)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `scripts/show_plans.py` on `{os.path.basename(sf_dir)}` (initial adaptive plan; "
           "AQE may still turn a sort-merge join into a broadcast when it measures a side as small).", ""]
    for name, note in NOTES.items():
        df = REGISTRY[name].run(spark, sf_dir)
        out += [f"## {name}", "", note, "", "```", tree(spark, df), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
