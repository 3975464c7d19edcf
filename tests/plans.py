"""Reading physical plans in tests."""


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
