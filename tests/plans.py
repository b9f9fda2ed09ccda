"""Reads a physical plan."""

import re


def physical(df) -> list[str]:
    sql = df.sparkSession._jvm.PythonSQLUtils
    return sql.explainString(df._jdf.queryExecution(), "simple").splitlines()


def main_path(df) -> list[str]:
    """Operators from the result down to the scan, taking the left side of each join."""
    path, lefts, skipped = [], set(), None
    for line in physical(df):
        found = re.match(r"^([\s:]*)([:+])- (.*)$", line)
        if not found:
            continue
        depth, side, operator = len(found[1]), found[2], found[3]
        if skipped is not None and depth > skipped:
            continue
        skipped = None
        lefts = {d for d in lefts if d <= depth}
        if side == "+" and depth in lefts:
            skipped = depth
            continue
        if side == ":":
            lefts.add(depth)
        path.append(operator)
    return path
