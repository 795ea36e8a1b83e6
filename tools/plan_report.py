"""Summarise the executed (final AQE) plan of every registered batch query.

usage: python tools/plan_report.py [sf_dir]   -> markdown table on stdout

Per query: full-row vs. other exchanges, join strategies (with skew
splits), partial/final WindowGroupLimit, TakeOrderedAndProject, number of
file scans, and whether every scan reads a pruned schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickscope.session import build_session  # noqa: E402


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # AdaptiveSparkPlan prints the final plan first, then the initial one.
    return text.split("+- == Initial Plan ==")[0]


def _operators(plan: str) -> list[str]:
    """One entry per plan node: the line without the tree drawing and codegen ids."""
    return [re.sub(r"^[\s:+\-|]*(\*\(\d+\)\s*)?", "", line) for line in plan.split("\n")]


def summarise(plan: str) -> dict[str, str]:
    ops = _operators(plan)
    c = lambda pat: sum(1 for o in ops if re.match(pat, o))
    joins = []
    for kind in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin"):
        for m in re.finditer(kind + r"(\(skew=true\))? \[[^\]]*\], \[[^\]]*\], (\w+)", plan):
            joins.append(f"{kind.replace('Join', '')} {m.group(2)}" + (" (skew split)" if m.group(1) else ""))
    return {
        "scans": str(c(r"FileScan parquet|Scan parquet")),
        "hash exchanges": str(c(r"Exchange hashpartitioning")),
        "other exchanges": str(c(r"Exchange (?:RoundRobin|rangepartitioning|SinglePartition)")),
        "reused": str(c(r"ReusedExchange")),
        "broadcasts": str(c(r"BroadcastExchange")),
        "joins": ", ".join(joins) or "-",
        "top-k": ", ".join(
            ([f"WindowGroupLimit partial x{c('WindowGroupLimit.*Partial')}"] if c("WindowGroupLimit.*Partial") else [])
            + (["TakeOrderedAndProject"] if c("TakeOrderedAndProject") else [])) or "-",
        "partial aggs": str(c(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_")),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from clickscope.plans.catalogue import batch_queries
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    cols = ["scans", "hash exchanges", "other exchanges", "reused", "broadcasts", "partial aggs", "joins", "top-k"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in batch_queries().items():
        s = summarise(final_plan(fn(spark, sf_dir)))
        print(f"| {name} | " + " | ".join(s[c] for c in cols) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
