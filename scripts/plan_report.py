"""Summarise the physical plan of every registered query.

    python scripts/plan_report.py [--sf-dir DIR] > docs/PLANS.md

Runs each query once so the adaptive plan is final, then
counts shuffles, broadcast and sort-merge joins, windows, aggregates,
interpreted higher-order functions and Python nodes, and lists what each
scan reads.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _count(plan: str, token: str) -> int:
    return len(re.findall(token, plan))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--full", default="sales_lines,catalog,transactions,daily_revenue,"
                    "artist_productivity,artist_revenue,visit_frequency",
                    help="queries whose whole final plan is appended")
    args = ap.parse_args()

    from martwright import registry
    from martwright.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of the registered queries\n")
    print(f"Final adaptive plans at `{os.path.basename(args.sf_dir)}`, `local[8]`, "
          "`spark.sql.shuffle.partitions=8`, broadcast threshold 32 MB.  "
          "Columns: shuffles (`Exchange hashpartitioning/rangepartitioning/SinglePartition`), "
          "broadcast hash joins, sort-merge joins, window operators, hash aggregates "
          "and sort aggregates (partial + final), Python evaluation nodes, and per scan the columns read "
          "and the filters pushed to parquet.\n")
    print("| query | shuffles | BHJ | SMJ | windows | hash aggs | sort aggs | python | scans (columns / pushed filters) |")
    print("|---|---|---|---|---|---|---|---|---|")
    full_plans: dict[str, str] = {}
    for name, build in registry.queries().items():
        df = build(spark, args.sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # execute this plan (JVM side) so its adaptive plan is final
        plan = qe.executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        shuffles = _count(final, r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)")
        bhj = _count(final, r"BroadcastHashJoin")
        smj = _count(final, r"SortMergeJoin")
        win = _count(final, r"\bWindow \[")
        agg = _count(final, r"HashAggregate\(")
        sagg = _count(final, r"SortAggregate\(")
        py = _count(final, r"(BatchEvalPython|ArrowEvalPython|PythonUDF|InPandas)")
        scans = []
        for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: \S+ ?\S*\[file:[^\]]*/(\w+)\.parquet\].*?"
                             r"PushedFilters: \[([^\]]*)\]", final):
            cols = m.group(1).replace(" ", "")
            cols = re.sub(r"#\d+L?", "", cols)
            scans.append(f"{m.group(2)}({cols}; {m.group(3) or '-'})")
        print(f"| {name} | {shuffles} | {bhj} | {smj} | {win} | {agg} | {sagg} | {py} | "
              f"{'<br>'.join(sorted(set(scans)))} |")
        if name in args.full.split(","):
            full_plans[name] = re.sub(r"#\d+L?", "", final).rstrip().removesuffix("+-").rstrip()
    for name, plan in full_plans.items():
        print(f"\n## `{name}` (final adaptive plan)\n\n```\n{plan.rstrip()}\n```")
    spark.stop()


if __name__ == "__main__":
    main()
