from collections import Counter


def bag(df):
    """Rows of a frame as a multiset, columns in name order."""
    names = sorted(df.columns)
    return Counter(tuple(row) for row in df.select(*names).collect())


def rows(df):
    return [tuple(row) for row in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
