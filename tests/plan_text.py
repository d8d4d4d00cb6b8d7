"""The physical plan of a frame that has run."""


def executed_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
