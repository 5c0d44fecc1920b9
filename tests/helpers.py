"""Small helpers shared by the tests."""


def rows(df):
    """The rows as sorted tuples; nulls first."""

    def key(row):
        return [(value is not None, str(value)) for value in row]

    return sorted((tuple(row) for row in df.collect()), key=key)


def plan(df):
    """The physical plan before execution, as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The physical plan after execution, as text."""
    df.collect()
    return plan(df)
