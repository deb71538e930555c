"""Print the physical plans of the main queries.

Usage: python scripts/show_plans.py [sf_dir] > PLANS.md
Each query is built (and run once into the noop sink); its physical plan as
planned (AQE's initial plan — at run time AQE may still coalesce partitions or
change a join strategy) is printed with the scan details.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from runlens.plans import catalog  # noqa: E402
from runlens.session import local_session  # noqa: E402

QUERIES = ["session_features", "event_features", "document_features", "training_export",
           "order_training_export", "date_range_filter"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    qs = catalog.queries()
    print(f"# Physical plans ({sf_dir}, local[8])\n")
    print("Generated by `scripts/show_plans.py`: the physical plan of each query as planned (AQE's initial")
    print("plan; at run time AQE may coalesce partitions or change a join strategy). Scan lines show their")
    print("filters and read schema; long lines are cut.\n")
    for name in QUERIES:
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan()
        text = plan.toString()
        lines = []
        for line in text.splitlines():
            line = re.sub(r"#\d+L?", "", line)
            if "FileScan" in line:
                head = line[: line.index("Batched")] if "Batched" in line else line[:140]
                lines.append(head.rstrip())
                pad = " " * (len(head) - len(head.lstrip()) + 6)
                for field in ("PartitionFilters", "PushedFilters", "ReadSchema"):
                    m = re.search(field + r": (\[[^\]]*\]|struct<.*)", line)
                    if m:
                        lines.append(f"{pad}{field}: {m.group(1)[:160]}")
            else:
                lines.append(line[:140])
        print(f"## {name}\n\n```\n" + "\n".join(lines) + "\n```\n")


if __name__ == "__main__":
    main()
