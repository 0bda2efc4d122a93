"""Small things that tests share."""

from collections import Counter


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def values(df, column=None):
    column = column or df.columns[0]
    return [row[column] for row in df.select(f"`{column}`").collect()]


def bag(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())
