"""Helpers of the tests for data frames."""


def rows(df, *columns):
    """Rows as sorted tuples, for comparison."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
