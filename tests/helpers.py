from __future__ import annotations


def rows(df, *order):
    found = [tuple(r) for r in df.select(*order).collect()] if order else [tuple(r) for r in df.collect()]
    return sorted(found, key=repr)


def one(df) -> dict:
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan after adaptive execution of the whole result."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
