"""Reading executed plans in tests."""


def executed(df):
    """Run ``df`` and return (node name, description) of every operator that ran: reused stages are not entered, subqueries are left out."""
    df.collect()
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        found.append((kind, node.simpleString(1000)))
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec", "TableCacheQueryStageExec"):
            return walk(node.plan())
        if kind == "ReusedExchangeExec":
            return None
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def scans(df, table=""):
    return [text for kind, text in executed(df) if kind == "FileSourceScanExec" and table in text]
