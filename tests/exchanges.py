"""What a query has moved between tasks."""


def shuffled_bytes(df):
    """What the exchanges of a query that has run have written."""
    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().apply("dataSize").value() if kind == "ShuffleExchangeExec" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())
