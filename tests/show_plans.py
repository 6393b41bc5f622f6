"""Print condensed executed plans (after AQE) of the headline queries.

Usage: python tests/show_plans.py [sf_dir] [name ...]
Only operators that matter for scale are kept: scans (with ReadSchema/filters),
exchanges, joins, aggregates, windows, generators and subqueries.
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"(Exchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoop|CartesianProduct|"
                  r"HashAggregate|ObjectHashAggregate|SortAggregate|Window|Generate|FileScan|Scan |Subquery|"
                  r"ArrowEvalPython|BatchEvalPython|AQEShuffleRead|TakeOrderedAndProject)")


def condensed(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for ln in plan.splitlines():
        if KEEP.search(ln):
            ln = re.sub(r"#\d+L?", "", ln)
            ln = re.sub(r"\[plan_id=\d+\]", "", ln)
            ln = re.sub(r"Location: [^,]+, ", "", ln)
            out.append(ln[:150])
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["h1_inference", "h2_recommendation", "f10_budget", "c04_profile_numeric"]
    import __spark_entry__ as entry
    from rateweave.session import local_session

    spark = local_session()
    for n in names:
        df = entry.queries()[n](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        print(f"### {n}\n```\n{condensed(df)}\n```\n")


if __name__ == "__main__":
    main()
