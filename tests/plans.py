"""Looking at physical plans."""


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan that adaptive execution ended with."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def shuffles(text: str) -> int:
    return text.count("Exchange hashpartitioning") + text.count("Exchange SinglePartition")


def uses_python(text: str) -> bool:
    return any(name in text for name in ("ArrowEval", "BatchEval", "MapInArrow", "MapInPandas"))
