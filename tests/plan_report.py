"""Physical-plan summary of every registered query with an oracle.

    python -m tests.plan_report > PLANS.md

Counts of the last step come from the executed (adaptive, final) plan at
sf0.01 after the query ran once, so they show the strategies Spark actually
picked.  Steps that a query writes to the checkpoint folder while it is built
are counted too, from their plans as made before execution."""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")


def recorded(steps: list):
    """``DataFrameWriter.parquet`` that also notes the plan of what it writes."""
    from pyspark.sql import DataFrameWriter
    write = DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        steps.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)
    DataFrameWriter.parquet = parquet


def summarize(make, steps: list) -> dict:
    steps.clear()
    df = make()
    df.write.format("noop").mode("overwrite").save()
    p = "\n".join([*steps, df._jdf.queryExecution().executedPlan().toString()])
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", p)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", p)
    return {
        "steps": len(steps),
        "shuffles": len(re.findall(r"(?<!Reused)Exchange (?:hashpartitioning|rangepartitioning|SinglePartition)", p))
        - len(re.findall(r"ReusedExchange", p)),
        "round_robin": p.count("RoundRobinPartitioning"),
        "bhj": p.count("BroadcastHashJoin"),
        "smj": p.count("SortMergeJoin"),
        "window": len(re.findall(r"\bWindow \[", p)),
        "wgl": p.count("WindowGroupLimit"),
        "top_k": p.count("TakeOrderedAndProject"),
        "scans": len(scans),
        "cols": max((len([c for c in s.split(",") if c.strip()]) for s in scans), default=0),
        "pushed": sum(1 for x in pushed if x.strip()),
        "python": any(n in p for n in ("PythonUDF", "EvalPython", "MapInArrow", "InArrow")),
    }


def main() -> None:
    import __spark_entry__ as E
    from horavento.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8, extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    qs, steps = E.queries(), []
    recorded(steps)
    names = sorted(E.oracle_sql())
    print("# Physical plans of the registered queries (sf0.01, final adaptive plans)\n")
    print("Generated by `python -m tests.plan_report`. Columns: steps written to the checkpoint folder,")
    print("then over all steps and the result: hash/range shuffles, round-robin exchanges, broadcast hash joins, sort-merge joins, window operators, partial window-group")
    print("limits, top-k nodes, parquet scans (incl. reused subtrees), widest scan column list, scans with")
    print("pushed filters, and whether any Python UDF node appears.\n")
    print("| query | steps | shuffles | rr | bhj | smj | window | wgl | top-k | scans | max cols | pushed | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for n in names:
        try:
            s = summarize(lambda n=n: qs[n](spark, "/root/testdata/sf0.01"), steps)
        except Exception as e:  # report and continue
            print(f"| {n} | error: {type(e).__name__} |")
            continue
        print(f"| {n} | {s['steps']} | {s['shuffles']} | {s['round_robin']} | {s['bhj']} | {s['smj']} | {s['window']} | "
              f"{s['wgl']} | {s['top_k']} | {s['scans']} | {s['cols']} | {s['pushed']} | "
              f"{'yes' if s['python'] else 'no'} |", flush=True)


if __name__ == "__main__":
    main()
