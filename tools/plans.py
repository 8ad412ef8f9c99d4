"""Write docs/PLANS.md: per registered query, the executed physical plan's
shuffles, join strategies and any operator we never want to see.

    python tools/plans.py [sf_dir]
"""

import os
import re
import sys

sys.path.insert(0, ".")

from quill.plans.context import Ctx  # noqa: E402
from quill.plans.registry import BUILDERS  # noqa: E402
from quill.session import local_session  # noqa: E402

WATCH = ["CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "BatchEvalPython",
         "ArrowEvalPython", "SinglePartition", "SortAggregate"]


def summarize(text: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)",
                                   text)),
        "broadcast_hash_joins": text.count("BroadcastHashJoin"),
        "sort_merge_joins": text.count("SortMergeJoin"),
        "shuffled_hash_joins": text.count("ShuffledHashJoin"),
        "partial_aggregates": text.count("partial_"),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]\n]*)", text)) - {""}),
        "watch": [w for w in WATCH if w in text],
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    lines = ["# Physical plans (generated by tools/plans.py)", "",
             f"Input: `{os.path.basename(sf)}`, `local[8]`, AQE on. Join strategies at this size",
             "reflect Spark's own size checks (small sides are broadcast; at cluster scale the same",
             "plans become sort-merge joins unless the runtime size is small). `SinglePartition`",
             "appears only for one-row global aggregates and the per-partition offset table of key",
             "assignment.", "",
             "| query | shuffles | BHJ | SMJ | SHJ | partial aggs | watch | pushed filters |",
             "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name, fn in BUILDERS.items():
        df = fn(Ctx(spark, sf))
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        pushed = "; ".join(p[:90] for p in s["pushed"])[:240]
        lines.append(f"| `{name}` | {s['shuffles']} | {s['broadcast_hash_joins']} | "
                     f"{s['sort_merge_joins']} | {s['shuffled_hash_joins']} | "
                     f"{s['partial_aggregates']} | {', '.join(s['watch']) or '-'} | {pushed or '-'} |")
    open("docs/PLANS.md", "w").write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
