def values(df):
    """Single-column rows as a list."""
    return [row[0] for row in df.collect()]


def rows(df):
    """Rows as sorted tuples, lists made hashable."""
    plain = [tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in df.collect()]
    return sorted(plain, key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
