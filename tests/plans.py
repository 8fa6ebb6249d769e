"""Reading executed plans in tests."""

import re
from collections import Counter

HIDDEN = ("WholeStageCodegenExec", "InputAdapter")


def _below(node, kind):
    if kind == "AdaptiveSparkPlanExec":
        return [node.executedPlan()]
    if kind.endswith("QueryStageExec"):
        return [node.plan()]
    if kind.startswith("Reused"):
        return []
    both = (node.subqueries(), node.children())
    return [nodes.apply(i) for nodes in both for i in range(nodes.size())]


def _walk(node):
    kind = node.getClass().getSimpleName()
    if kind not in HIDDEN:
        yield node.simpleString(100)
    for child in _below(node, kind):
        yield from _walk(child)


def executed_plan(df):
    """One line per node of the final plan of a query that has run, parents first; reused parts appear once."""
    df.collect()
    return "\n".join(_walk(df._jdf.queryExecution().executedPlan()))


def full_plan(df):
    """Everything Spark prints about an executed query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return Counter(re.findall(r"FileScan parquet .*?/(\w+)\.parquet", plan))
