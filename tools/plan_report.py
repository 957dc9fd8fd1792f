"""Summarise the physical plans of the headline queries into PLANS.md.

Usage: python tools/plan_report.py [sf_dir]
For each query: scans with their pushed filters and read schema, and the
number of exchanges, join strategies, window operators and Python stages in
the executed plan (AQE final plan after one run).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from tracewise.registry import load_all  # noqa: E402
from tracewise.session import get_session  # noqa: E402

NODES = {
    "shuffle exchanges": r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|\bExchange RoundRobin",
    "broadcast exchanges": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast hash joins": r"BroadcastHashJoin",
    "windows": r"\bWindow ",
    "python stages": r"ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas|FlatMapCoGroupsInPandas",
}


def final_only(text: str) -> str:
    """Drop the '== Initial Plan ==' sections that executed AQE plans print
    next to their final plan (lines indented below the marker)."""
    out, skip_at = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip_at is not None:
            if indent > skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = indent
            continue
        out.append(line)
    return "\n".join(out)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", app="tracewise-plans", shuffle_partitions=16)
    qs = load_all()
    out = ["# Physical plans of the headline queries", "",
           f"Data: `{sf_dir}`; AQE final plans after one run (`tools/plan_report.py`), scalar",
           "subqueries included. Inputs materialised by `cut_lineage` (counters, edge series,",
           "aggregated series) are read from the checkpoint, so their own scan is not listed.", ""]
    for name in HEADLINE:
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan()
        text = plan.toString()
        text = final_only(text)
        counts = {k: len(re.findall(v, text)) for k, v in NODES.items()}
        scans = re.findall(r"FileScan parquet [^\n]*", text)
        out.append(f"## {name}")
        out.append("")
        out.append(", ".join(f"{k}: {v}" for k, v in counts.items()))
        out.append("")
        for sc in scans:
            pf = re.search(r"PushedFilters: \[[^\]]*\]", sc)
            rs = re.search(r"ReadSchema: struct<[^>]*>", sc)
            loc = re.search(r"Location: [^\[]*\[[^\]]*/([\w.-]+)\]", sc)
            out.append(f"- scan {loc.group(1) if loc else '?'}: {pf.group(0) if pf else ''}; "
                       f"{rs.group(0) if rs else ''}")
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
